"""Scans against windows, percentiles, as-of joins and interval joins against plain versions."""

import bisect
import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrymill.operators import intervals as I
from quarrymill.operators import scans as S


def hot(spark, n=4000):
    """A key with half of all rows, keys with few, one without a name."""
    rng = random.Random(1)
    rows = [("hot" if k % 2 else rng.choice(["a", "b", "c", None, "z"]), k, rng.choice([None, 1.5, 2.5, float(k)])) for k in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, i long, v double")


def test_scan_is_like_windows(spark):
    df = hot(spark)
    got = S.scan(df, ["k"], ["i"], {"run": ("sum", F.col("v")), "known": ("last", F.col("v")), "old": ("lag", F.col("v")), "total": ("total", F.col("v")), "n": ("sum", F.lit(1).cast("long"))})
    w = Window.partitionBy("k").orderBy("i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"run": F.sum("v").over(upto), "known": F.last("v", True).over(upto), "old": F.lag("v").over(w), "total": F.sum("v").over(Window.partitionBy("k")), "n": F.count("*").over(upto)})
    near = lambda rows: sorted(([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows]), key=repr)
    assert near(got.collect()) == near(want.collect())


def test_a_hot_key_lies_in_several_ranges(spark):
    df = hot(spark)
    sizes = [r["count"] for r in S.ranged(df, ["k", "i"]).filter("k = 'hot'").groupBy("_range").count().collect()]
    assert len(sizes) >= 2 and max(sizes) < 0.4 * df.count()


def test_scan_without_keys_and_of_no_rows(spark):
    df = spark.range(0, 1000).withColumn("x", F.lit(1).cast("long"))
    got = S.scan(df, [], ["id"], {"n": ("sum", F.col("x")), "old": ("lag", F.col("id"))})
    assert got.filter("n <> id + 1 or (id > 0 and old <> id - 1) or (id = 0 and old is not null)").count() == 0
    assert S.scan(df.limit(0), [], ["id"], {"n": ("sum", F.col("x"))}).collect() == []
    assert S.percentiles(df.limit(0), ["x"], "id", [0.5]).collect() == []


def test_percentiles_of_keys(spark):
    df = hot(spark)
    shares = [0.0, 0.25, 0.5, 0.95, 1.0]
    want = {r.k: tuple(r)[1:] for r in df.filter("v is not null").groupBy("k").agg(F.count("*"), *[F.percentile("v", s) for s in shares]).collect()}
    got = {r.k: tuple(r)[1:] for r in S.percentiles(df, ["k"], "v", shares).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_as_of_of_any_age(spark):
    rng = random.Random(5)
    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(days=n)
    rates = [(rng.choice("ab"), day(rng.randrange(900)), float(rng.randrange(50))) for _ in range(60)] + [("c", day(5), 1.0), (None, day(3), 1.0), ("a", None, 1.0), ("a", day(4), None)]
    rows = [(k, "a" if k % 2 else rng.choice(["b", "c", "d", None]), rng.choice([None, *map(day, range(-20, 1200))])) for k in range(1500)]
    table = {}
    for key, d, x in sorted(r for r in rates if None not in r):
        table.setdefault(key, []).append((d, x))
    got = S.as_of(spark.createDataFrame(rows, "id long, cur string, sold date"), spark.createDataFrame(rates, "cur string, on date, x double"), "cur", "sold", "on", "x").collect()
    assert len(got) == len(rows)
    for r in got:
        have = table.get(r.cur, []) if r.sold else []
        at = bisect.bisect_right(have, (r.sold, math.inf)) - 1 if have else -1
        assert (r.rate_day, r.rate) == (have[at] if at >= 0 else (None, None))


def test_cells_make_up_an_interval(spark):
    rng = random.Random(2)
    ends = [(a, a + rng.randrange(0, 10 ** rng.randrange(6))) for a in (rng.randrange(-(10**6), 10**6) for _ in range(400))] + [(0, 0), (5, 4), (-1, 0), (-8, -1), (0, 2**40), (-(2**60), 2**60)]
    got = spark.createDataFrame(ends, "a long, b long").select("a", "b", I.cells(F.col("a"), F.col("b")).alias("c")).collect()
    for a, b, c in got:
        parts = sorted((x.cell << x.level, (x.cell + 1) << x.level) for x in c)
        if b < a:
            assert not parts
            continue
        assert parts[0][0] == a and parts[-1][1] == b + 1 and all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))
        assert len(parts) <= 2 * max(1, (b - a + 1).bit_length())


def test_a_million_intervals(spark):
    """Against sorted ends: of each point, intervals that have begun less those that have ended. Rows grow by 2 log n."""
    n = 1_000_000
    spans = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(4_000_000_000))).alias("low"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(17)).alias("e"), "id")
    spans = spans.select("id", "low", (F.col("low") + F.pmod(F.xxhash64("id", F.lit(2)), F.pow(F.lit(2), F.col("e")).cast("long"))).alias("high"))
    points = spark.range(2000).select(F.col("id").alias("p"), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(4_000_000_000)).alias("x"))
    got = {r.p: r["count"] for r in I.stab(points, spans, [], "x", "low", "high").groupBy("p").count().collect()}
    ends = spans.select("low", "high").toPandas()
    low, high = np.sort(ends["low"].to_numpy()), np.sort(ends["high"].to_numpy())
    for p, x in points.collect():
        assert got.get(p, 0) == np.searchsorted(low, x, "right") - np.searchsorted(high, x, "left")
    assert sum(got.values()) > 1000


def test_stab_by_keys(spark):
    rng = random.Random(8)
    points = [(k, rng.choice([1, 2]), rng.choice([None, *range(-50, 50)])) for k in range(300)]
    spans = [(k, rng.choice([1, 2, 3]), rng.choice([None, *range(-60, 60)]), rng.choice([None, *range(-60, 60)])) for k in range(100)]
    got = I.stab(spark.createDataFrame(points, "p int, k int, x int"), spark.createDataFrame(spans, "s int, k int, a int, b int"), ["k"], "x", "a", "b")
    want = sorted((p, s) for p, k, x in points for s, j, a, b in spans if k == j and None not in (x, a, b) and a <= x <= b)
    assert sorted((r.p, r.s) for r in got.collect()) == want
    assert I.stab(spark.createDataFrame(points, "p int, k int, x int"), spark.createDataFrame([], "s int, k int, a int, b int"), ["k"], "x", "a", "b").count() == 0
