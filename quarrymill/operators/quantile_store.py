"""Quartiles of segments that are kept up to date: stored counts of prices, to which insertions and deletions are added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators.scans import weighted_percentiles
from quarrymill.sources.parted import PARTS, Parted

#: Ranges of prices in each doubling, by which the rows of a segment are dealt over parts.
STEPS = 8


class QuantileStore:
    """Counts of each price of each segment, in parts by segment and range of prices: a segment with most rows lies in many
    parts, and a batch rewrites those ranges in which prices came or went. keys are strings.

    A change is a row with the segment's keys, a price and n: rows that came (positive) or went (negative). Changes add up
    in any order; where more rows went than came, the count is below zero until they come, and counts for none.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], parts: int = PARTS):
        self.keys = list(keys)
        cell = F.floor(F.log2(F.abs("price") + 1) * STEPS) * F.signum("price")
        self.table = Parted(spark, folder, ", ".join(f"`{k}` string" for k in keys) + ", price double, n long", [*keys, cell], parts)

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys, "price").agg(F.sum("n").alias("n")).filter("n <> 0")

    def change(self, changes: DataFrame, number: int) -> None:
        """Adds a batch of changes. A batch that is run again under its number counts once. Prices that are null, and counts
        of zero, are left out."""
        rows = changes.select(*[F.col(k).cast("string").alias(k) for k in self.keys], F.col("price").cast("double").alias("price"), F.col("n").cast("long").alias("n"))
        rows = self._summed(rows.filter("price is not null and not isnan(price)").withColumn("price", F.col("price") + 0.0))
        self.table.write(rows, number, lambda old, new: self._summed(old.union(new)))

    def quantiles(self, least: int = 1) -> DataFrame:
        """As aggregates.quantiles() of all rows that are there: keys, n, p25, median_px, p75, min_px, max_px."""
        out = weighted_percentiles(self.table.current(), self.keys, "price", "n", [0.0, 0.25, 0.5, 0.75, 1.0]).filter(F.col("n") >= least)
        names = ["p25", "median_px", "p75", "min_px", "max_px"]
        return out.select(*self.keys, "n", *[F.rint(f"p{k}").cast("long").alias(name) for k, name in zip((1, 2, 3, 0, 4), names, strict=True)])
