"""Streams of state machines against the same machines run over all events at once."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quarrymill.streaming import machines as M

SCHEMA = "k string, at timestamp, id long, kind string, value double, extra int"
ZERO = datetime.datetime(2024, 1, 1)


def some(seed, kinds, n=400, keys=6, hours=400):
    rng = random.Random(seed)
    at = sorted(rng.randrange(hours * 3600) for _ in range(n))
    return [(rng.choice("abcdef"[:keys]), ZERO + datetime.timedelta(seconds=s, microseconds=rng.randrange(10**6)), i, rng.choice(kinds), rng.choice([None, 0.0, 100.0, 101.0, float(rng.randrange(1, 150))]), rng.choice([None, 0, 1])) for i, s in enumerate(at)]


def micros(at):
    return (at - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1)


def at_once(machine, events, late_ms=3_600_000):
    mark = max(micros(e[1]) for e in events) // 1000 - late_ms
    come = lambda us: us // 1000 + 1 < mark
    out = []
    for key in {e[0] for e in events}:
        said = M.run(machine, None, [(micros(at), i, kind, v, x) for k, at, i, kind, v, x in events if k == key and come(micros(at))], come)[1]
        out += [(key, *s) for s in said]
    return sorted(out, key=repr)


def streamed(spark, machine, folder, parts, stops):
    """Each part is a file; the stream ends and starts again from its checkpoint after each of `stops` parts."""
    source, done = f"{folder}/in", 0
    for upto in stops:
        for k, part in enumerate(parts[done:upto]):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        done = upto
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        said = M.watched(stream, machine, "k", "at", "id", F.col("kind"), F.col("value"), F.col("extra"))
        M.keep(said, f"{folder}/out", f"{folder}/checkpoint")
    return sorted(map(tuple, spark.read.schema(said.schema).parquet(f"{folder}/out").collect()), key=repr)


@pytest.mark.parametrize(
    ("machine", "kinds"),
    [(M.Listings(stale=20 * M.HOUR), ["seen", "seen", "seen", "seen", "sold", "other"]), (M.Auctions(), ["open", "bid", "open"]), (M.Breakers(), ["failed", "failed", "failed", "fine"])],
    ids=["listings", "auctions", "breakers"],
)
def test_any_split_and_a_restart_give_the_same(spark, tmp_path, machine, kinds):
    events = [e for s in range(5) for e in some(s, kinds, n=40, hours=300)] if isinstance(machine, M.Listings) else some(7, kinds)
    events = [(k, at, 1000 * n + i, *rest) for n, (k, at, i, *rest) in enumerate(sorted(events, key=lambda e: e[1]))]
    want = at_once(machine, events)
    assert len({w[2] for w in want}) > 1
    # out of order within the watermark's delay, in parts of any size
    rng = random.Random(3)
    mixed = sorted(events, key=lambda e: e[1] + datetime.timedelta(seconds=rng.randrange(3000)))
    cuts = [0, *sorted(rng.sample(range(1, len(mixed)), 4)), len(mixed)]
    parts = [mixed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    assert streamed(spark, machine, str(tmp_path / "split"), parts, [2, 5]) == want
    assert streamed(spark, machine, str(tmp_path / "whole"), [events], [1]) == want


def test_what_was_sold_does_not_come_back():
    h = M.HOUR
    said = M.run(M.Listings(stale=5 * h), None, [(0, 0, "seen", 10.0, None), (1 * h, 1, "seen", 10.1, None), (2 * h, 2, "seen", 20.0, None), (9 * h, 3, "seen", None, None), (10 * h, 4, "sold", None, None), (11 * h, 5, "seen", 1.0, None)], lambda at: True)[1]
    assert said == [(0, "listed", 10.0, 1), (2 * h, "price", 20.0, 3), (7 * h, "expired", 20.0, 3), (9 * h, "relisted", 20.0, 4), (10 * h, "sold", 20.0, 4)]


def test_an_auction_has_three_kinds_of_reserve():
    h = M.HOUR
    for extra, bid, withdrawn in ((None, False, None), (0, False, True), (0, True, False), (1, False, False)):
        events = [(0, 0, "open", 80.0, extra)] + [(5, 1, "bid", None, None)] * bid + [(6, 2, "open", 1.0, 1)]
        said = M.run(M.Auctions(), None, events, lambda at: True)[1]
        assert said == [(0, "upcoming", None), (8 * h, "live", None), (80 * h, "sold", withdrawn)]
    # 72 hours are not over 72
    assert M.run(M.Auctions(), None, [(0, 0, "open", 72.0, 1)], lambda at: at < h)[1] == [(0, "live", None)]


def test_a_breaker_opens_once():
    said = M.run(M.Breakers(), None, [(k, k, kind, None, None) for k, kind in enumerate(["failed"] * 5 + ["fine", "failed", "failed", "fine"])], lambda at: True)[1]
    assert said == [(2, "opened", 3, 3, 0), (5, "closed", 5, 6, 1)]
