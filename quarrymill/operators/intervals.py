"""Joins of points with the intervals that hold them, by dyadic cells: what would be a range join is a join by equality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of cells: an interval may have up to 2^LEVELS whole numbers.
LEVELS = 62


def cells(low: Column, high: Column) -> Column:
    """array<struct<level, cell>>: the fewest cells (of 2^level numbers, the cell-th) that make up low..high, both included:
    at most two of each level. No cells if high < low."""
    one = F.lit(1).cast("long")
    start = F.struct(low.cast("long").alias("a"), (high.cast("long") + 1).alias("b"), F.array().cast("array<struct<level:int,cell:bigint>>").alias("found"))

    def step(s: Column, level: Column) -> Column:
        cell = lambda at: F.struct(level.cast("int").alias("level"), at.cast("long").alias("cell"))
        on = s["a"] < s["b"]
        left, right = on & (s["a"].bitwiseAND(one) == 1), on & (s["b"].bitwiseAND(one) == 1)
        # an odd number at either end is no half of a cell of the next level
        a, b = F.when(left, s["a"] + 1).otherwise(s["a"]), F.when(right, s["b"] - 1).otherwise(s["b"])
        new = F.array_compact(F.array(F.when(left, cell(s["a"])), F.when(right & (b >= a), cell(s["b"] - 1))))
        return F.struct(F.shiftright(a, 1).alias("a"), F.shiftright(b, 1).alias("b"), F.concat(s["found"], new).alias("found"))

    # no more levels than the width has bits
    width = F.greatest(high.cast("long") - low.cast("long") + 1, F.lit(0).cast("long"))
    top = F.length(F.bin(width)).cast("int")
    return F.aggregate(F.sequence(F.lit(0), F.least(top, F.lit(LEVELS))), start, step, lambda s: s["found"])


def stab(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, low: str, high: str) -> DataFrame:
    """All pairs of a point and an interval of the same keys with low <= at <= high, whole numbers; the columns of both.

    An interval has a row for each of its cells, at most two for each bit of its width; a point has one for each level that
    cells are of, and lies in at most one cell of an interval: so each pair comes once. Points without a number, intervals
    without an end or with high < low have no pair.
    """
    cut = _cut(intervals, low, high)
    # at most as many numbers as there are levels
    levels = sorted(r[0] for r in cut.select("_level").distinct().collect())
    return _at_levels(points, at, levels).join(cut, [*keys, "_level", "_at"]).drop("_level", "_at")


def _cut(intervals: DataFrame, low: str, high: str) -> DataFrame:
    cut = intervals.withColumn("_cell", F.explode(cells(F.col(low), F.col(high))))
    return cut.select(*intervals.columns, F.col("_cell.level").alias("_level"), F.col("_cell.cell").alias("_at"))


def _at_levels(points: DataFrame, at: str, levels: Sequence[int]) -> DataFrame:
    at_level = points.filter(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    return at_level.withColumn("_at", F.expr(f"shiftright(cast(`{at}` as bigint), _level)"))


def least(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, low: str, high: str, order: Column) -> DataFrame:
    """The points that an interval of their keys holds, each once (keys and at), with `least`: the least order, a column of
    intervals, among those that hold it.

    Equal intervals and those of a cell leave only their least one, so a point meets a row for each level at most, however
    many intervals hold it.
    """
    once = intervals.groupBy(*keys, low, high).agg(F.min(order).alias("_least"))
    first = _cut(once, low, high).groupBy(*keys, "_level", "_at").agg(F.min("_least").alias("_least"))
    # at most as many numbers as there are levels
    levels = sorted(r[0] for r in first.select("_level").distinct().collect())
    met = _at_levels(points.select(*keys, at).distinct(), at, levels).join(first, [*keys, "_level", "_at"])
    return met.groupBy(*keys, at).agg(F.min("_least").alias("least"))
