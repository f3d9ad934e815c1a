"""Scans in order within keys, for keys of any size: running sums, last values, values before.

A window by key puts all rows of a key into one task. Here rows are dealt out by ranges of key and order, each range is
scanned by itself, and what a key brings along from the ranges before is added. Only keys that lie in several ranges bring
anything along, and of those there are fewer than ranges: their few sums are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.sources.shared import shared_folder

#: What a column of a scan is: the sum up to a row, the last value that is not null up to it, the value of the row before,
#: the sum over the whole key.
KINDS = ("sum", "last", "lag", "total")


def ranged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df, written in ranges of the columns and read again, with the number of the range as _range."""
    spark = df.sparkSession
    ranges = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *columns).withColumn("_range", F.spark_partition_id())
    path = shared_folder(spark, "ranges")
    ranges.write.parquet(path)
    return spark.read.schema(ranges.schema).parquet(path)


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, tuple[str, Column]]) -> DataFrame:
    """df with further columns, each of a kind (see KINDS) and an expression over df.

    order must leave no ties that matter; rows are in ascending order, nulls first. Null keys are a key of their own. A row
    alone in its key has sums of itself and nothing before. Rows that agree in key and order stay in one range.
    """
    kept = ranged(df.withColumns({f"_{name}": expr if kind != "lag" else F.struct(expr.alias("v")) for name, (kind, expr) in columns.items()}), [*keys, *order])
    key, place = F.struct(F.lit(0).alias("_0"), *[F.col(k) for k in keys]), F.struct(*order)
    part = Window.partitionBy(*keys, "_range")
    upto, before = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0), part.orderBy(*order)
    own = {"sum": lambda c: F.sum(c).over(upto), "last": lambda c: F.last(c, True).over(upto), "lag": lambda c: F.lag(c).over(before), "total": lambda c: F.sum(c).over(part)}
    # a key that lies in several ranges is the last of one and the first of another
    ends = kept.groupBy("_range").agg(F.min(key).alias("a"), F.max(key).alias("b")).select("_range", F.explode(F.array("a", "b")).alias("_key")).distinct()
    long = ends.groupBy("_key").count().filter("count > 1").select("_key")
    keyed = kept.withColumn("_key", key)
    few = keyed.join(F.broadcast(long), keyed["_key"].eqNullSafe(long["_key"]), "left_semi")
    of = {"sum": F.sum, "total": F.sum, "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), place)), "lag": lambda c: F.max_by(c, place)}
    sums = few.groupBy("_key", "_range").agg(F.count("*").alias("_rows"), *[of[kind](f"_{name}").alias(f"_{name}") for name, (kind, _) in columns.items()])
    every = Window.partitionBy("_key")
    ahead = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    brought = {"sum": lambda c: F.sum(c).over(ahead), "last": lambda c: F.last(c, True).over(ahead), "lag": lambda c: F.last(c, True).over(ahead), "total": lambda c: F.sum(c).over(every)}
    carry = sums.select(F.col("_key").alias("_long"), F.col("_range").alias("_in"), *[brought[kind](f"_{name}").alias(f"_carry_{name}") for name, (kind, _) in columns.items()])
    local = keyed.withColumns({f"_own_{name}": own[kind](f"_{name}") for name, (kind, _) in columns.items()})
    both = local.join(F.broadcast(carry), local["_key"].eqNullSafe(carry["_long"]) & (local["_range"] == carry["_in"]), "left")

    def joined(name: str, kind: str) -> Column:
        mine, theirs = F.col(f"_own_{name}"), F.col(f"_carry_{name}")
        if kind == "sum":
            return F.coalesce(mine + theirs, mine, theirs)
        if kind == "total":
            return F.coalesce(theirs, mine)
        return F.coalesce(mine, theirs)["v"] if kind == "lag" else F.coalesce(mine, theirs)

    return both.select(*df.columns, *[joined(name, kind).alias(name) for name, (kind, _) in columns.items()])


def ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with the place of each row in its key, from 1, as _place and the key's number of rows as _rows."""
    one = F.lit(1).cast("long")
    return scan(df, keys, order, {"_place": ("sum", one), "_rows": ("total", one)})


def weighted_percentiles(counts: DataFrame, keys: Sequence[str], value: str, n: str, shares: Sequence[float]) -> DataFrame:
    """Of each key its number of rows (n) and the percentiles p0, p1, ... of its values, continuous between neighbours.

    counts has each value of a key once, with its number: so a key's percentiles are read off cumulated numbers. Values
    that are null and numbers that are not positive do not count.
    """
    rows = counts.filter(F.col(value).isNotNull() & (F.col(n) > 0)).select(*keys, F.col(value).cast("double").alias("_v"), F.col(n).cast("long").alias("_n"))
    placed = scan(rows, keys, ["_v"], {"_upto": ("sum", F.col("_n")), "_all": ("total", F.col("_n"))})
    picks = []
    for k, share in enumerate(shares):
        at = F.lit(float(share)) * (F.col("_all") - 1)
        holds = lambda place: (F.col("_upto") - F.col("_n") <= place) & (place < F.col("_upto"))
        picks += [F.max(F.when(holds(F.floor(at)), F.col("_v"))).alias(f"_low{k}"), F.max(F.when(holds(F.ceil(at)), F.col("_v"))).alias(f"_high{k}")]
    out = placed.groupBy(*keys).agg(F.max("_all").alias("n"), *picks)
    between = lambda k, s: F.col(f"_low{k}") + (F.col(f"_high{k}") - F.col(f"_low{k}")) * (s * (F.col("n") - 1) - F.floor(s * (F.col("n") - 1)))
    return out.select(*keys, "n", *[between(k, F.lit(float(s))).alias(f"p{k}") for k, s in enumerate(shares)])


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """weighted_percentiles() of rows: each value of a key is counted first, by partial sums."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_value")).agg(F.count("*").alias("_count"))
    return weighted_percentiles(counts, keys, "_value", "_count", shares)


def as_of(rows: DataFrame, rates: DataFrame, key: str, day: str, rate_day: str, rate: str) -> DataFrame:
    """rows with the last rate of the key on or before the day, however old, as rate and rate_day; of rates of one day the
    greatest. Both sides are put into one order, in which the last rate is carried along: as many rows as both have. Rows
    without key or day, or from before the first rate, have none; rates without key, day or rate are none."""
    kind = dict(rows.dtypes)[day]
    named = rows.withColumn("_row", F.struct(*rows.columns))
    left = named.select(F.col(key).alias("_k"), F.col(day).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(dict(rates.dtypes)[rate]).alias("_rate"), "_row")
    right = rates.filter(F.col(key).isNotNull() & F.col(rate_day).isNotNull() & F.col(rate).isNotNull())
    right = right.select(F.col(key).alias("_k"), F.col(rate_day).cast(kind).alias("_at"), F.lit(0).alias("_side"), F.col(rate).alias("_rate"), F.lit(None).cast(named.schema["_row"].dataType).alias("_row"))
    known = F.when(F.col("_side") == 0, F.struct(F.col("_rate").alias("rate"), F.col("_at").alias("rate_day")))
    found = scan(left.union(right), ["_k"], ["_at", "_side", "_rate"], {"_last": ("last", known)}).filter("_side = 1")
    last = F.when(F.col("_k").isNotNull() & F.col("_at").isNotNull(), F.col("_last"))
    return found.select("_row.*", last["rate"].alias("rate"), last["rate_day"].alias("rate_day"))
