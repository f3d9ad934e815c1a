"""Tables in parts, and quartiles that are kept up to date."""

import os
import random

from pyspark.sql import functions as F

from quarrymill.operators import aggregates as A
from quarrymill.operators.lifecycle import upsert
from quarrymill.operators.quantile_store import QuantileStore
from quarrymill.sources.parted import Parted
from quarrymill.streaming import jobs


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{folder}/rows") for f in names if f.endswith(".parquet")}


def test_only_touched_parts_are_rewritten_and_a_replay_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "t")
    table = Parted(spark, folder, "k long, v string, at long", ["k"], 16)
    put = lambda rows, n: table.write(spark.createDataFrame(rows, "k long, v string, at long"), n, lambda old, new: upsert(old, new, ["k"], "at"))
    put([(k, "a", k) for k in range(200)], 0)
    first = files(folder)
    put([(7, "b", 1000), (1000, "b", 1001)], 1)
    after = files(folder)
    assert first.items() <= after.items() and len({f.split("_part=")[1].split("/")[0] for f in after.keys() - first.keys()}) <= 2
    want = {**{k: "a" for k in range(200)}, 7: "b", 1000: "b"}
    assert {r.k: r.v for r in table.current().collect()} == want
    put([(7, "b", 1000), (1000, "b", 1001)], 1)
    assert {r.k: r.v for r in table.current().collect()} == want and table.current().count() == 201
    for n in range(2, 6):
        put([(7, f"c{n}", 2000 + n)], n)
    assert {r.k: r.v for r in table.current().collect()} == want | {7: "c5"}
    assert table.commits() == [4, 5] and len({f.split("batch=")[1].split("/")[0] for f in files(folder)}) <= 4


def test_a_failed_batch_is_not_seen_and_parts_may_end_empty(spark, tmp_path):
    table = Parted(spark, str(tmp_path / "t"), "k long", ["k"], 4)
    rows = spark.range(50).withColumnRenamed("id", "k")
    table.write(rows, 3, lambda old, new: new)

    def fails(old, new):
        raise RuntimeError

    try:
        table.write(rows, 4, fails)
    except RuntimeError:
        assert table.current().count() == 50
    table.write(rows.filter("k < 10"), 4, lambda old, new: old.join(new, "k", "left_anti"))
    assert sorted(r.k for r in table.current().collect()) == list(range(10, 50))
    table.write(rows, 5, lambda old, new: old.limit(0))
    assert table.current().collect() == []
    table.write(rows.limit(0), 6, lambda old, new: new)
    assert table.current().columns == rows.columns


def test_kept_table_of_a_stream_in_several_batches(spark, tmp_path):
    rng, schema = random.Random(3), "k long, v long"
    rows = [(rng.randrange(40), n) for n in range(300)]
    for n in range(0, 300, 75):
        spark.createDataFrame(rows[n : n + 75], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    table = jobs.keep_table(stream(), str(tmp_path / "t"), ["k"], "v", 8)
    want = {}
    for k, v in rows:
        want[k] = max(v, want.get(k, -1))
    assert {r.k: r.v for r in table.current().collect()} == want
    spark.createDataFrame([(0, 999), (77, 1000)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = jobs.keep_table(stream(), str(tmp_path / "t"), ["k"], "v", 8)
    assert {r.k: r.v for r in table.current().collect()} == want | {0: 999, 77: 1000}


def test_quantiles_after_each_batch_are_those_from_scratch(spark, tmp_path):
    rng = random.Random(9)
    store = QuantileStore(spark, str(tmp_path / "q"), ["mk", "mo"], 8)
    there = []
    for n in range(4):
        came = [(rng.choice(["hot", "hot", "hot", "x", "y"]), rng.choice(["m", None]), float(rng.choice([5, 10, rng.randrange(10**5)]))) for _ in range(300)] + [("x", "m", None)] * 3
        went = rng.sample(there, 120 if n else 0)
        for r in went:
            there.remove(r)
        there += [r for r in came if r[2] is not None]
        changes = spark.createDataFrame([(*r, 1) for r in came] + [(*r, -1) for r in went], "mk string, mo string, price double, n int")
        store.change(changes, n)
        want = A.quantiles(spark.createDataFrame(there, "mk string, mo string, price double"), ["mk", "mo"], "price", 2)
        assert sorted(map(tuple, store.quantiles(2).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    store.change(changes, 3)
    assert sorted(map(tuple, store.quantiles(2).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    # the segment with most rows is in many parts
    hot = store.table.current().filter("mk = 'hot' and mo = 'm'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot >= 4


def test_going_before_coming(spark, tmp_path):
    store = QuantileStore(spark, str(tmp_path / "q"), ["mk"], 4)
    row = lambda n: spark.createDataFrame([("a", 5.0, n), ("a", 7.0, 2)], "mk string, price double, n int")
    store.change(row(-1), 0)
    assert [(r.n, r.median_px) for r in store.quantiles().collect()] == [(2, 7)]
    store.change(row(2), 1)
    assert [(r.n, r.min_px, r.max_px) for r in store.quantiles().collect()] == [(5, 5, 7)]
