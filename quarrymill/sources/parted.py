"""A table in parts by a hash of its keys, of which a batch rewrites only those that it touches.

A batch is written beside what is there, in a folder of its own with a folder for each part, and a commit tells which batch
each part is to be read from. So the files of other parts stay as they are, readers see a batch as a whole or not at all,
and a batch that is run again after a failure starts from the same commit and gives the same table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Parts of a table. A batch of new keys everywhere rewrites all; one of a few keys as many parts.
PARTS = 64


class Parted:
    """A table below a folder that driver and executors share. keys: columns or expressions whose hash gives the part."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType | str, keys: Sequence[str | Column], parts: int = PARTS):
        self.spark, self.folder, self.parts = spark, folder.rstrip("/"), parts
        self.schema = spark.createDataFrame([], schema).schema
        self.part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        self.fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, below: str) -> list[str]:
        at = self.fs_path(f"{self.folder}/{below}")
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def commits(self) -> list[int]:
        return sorted(int(n) for n in self._names("commits") if n.isdigit() and self.fs.exists(self.fs_path(f"{self.folder}/commits/{n}/_SUCCESS")))

    def _state(self, number: int | None) -> dict[int, int]:
        """The batch of each part that has rows, at most as many numbers as there are parts."""
        if number is None:
            return {}
        line = self.spark.read.schema("value string").text(f"{self.folder}/commits/{number}").first()
        return {int(k): v for k, v in json.loads(line[0]).items()}

    def _read(self, state: dict[int, int], parts: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{self.folder}/rows/batch={b}/_part={p}" for p, b in sorted(state.items()) if parts is None or p in parts]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def current(self) -> DataFrame:
        """The table after the last commit."""
        done = self.commits()
        return self._read(self._state(done[-1] if done else None))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows by part, so that few tasks write to one; Spark splits parts that turn out large."""
        return rows.withColumn("_part", self.part).hint("rebalance", F.col("_part"))

    def write(self, new: DataFrame, number: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Puts merge(old, new) in the place of old: the rows of the parts in which new has keys, before this batch.

        Batches have rising numbers. merge must leave keys in their part. What it drops is gone; a part without rows has no
        files. Data of batches that the last two commits do not read are deleted.
        """
        before = [n for n in self.commits() if n < number]
        state = self._state(before[-1] if before else None)
        path = f"{self.folder}/new"
        self._dealt(new).write.mode("overwrite").partitionBy("_part").parquet(f"{path}/{number}")
        touched = {int(n.split("=")[1]) for n in self._names(f"new/{number}") if n.startswith("_part=")}
        batch = self.spark.read.schema(new.schema).parquet(*[f"{path}/{number}/_part={p}" for p in sorted(touched)]) if touched else new.limit(0)
        out = merge(self._read(state, touched), batch).select(*self.schema.names)
        target = f"{self.folder}/rows/batch={number}"
        self._dealt(out).write.mode("overwrite").partitionBy("_part").parquet(target)
        have = {int(n.split("=")[1]) for n in self._names(f"rows/batch={number}") if n.startswith("_part=")}
        if not have <= touched:
            raise ValueError("merge gave rows of parts that the batch does not touch")
        state = {p: b for p, b in state.items() if p not in touched} | {p: number for p in have}
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/commits/{number}")
        self._tidy(number)

    def _tidy(self, number: int) -> None:
        done = [n for n in self.commits() if n <= number]
        read = {b for n in done[-2:] for b in self._state(n).values()} | {number}
        for n in done[:-2]:
            self.fs.delete(self.fs_path(f"{self.folder}/commits/{n}"), True)
        for name in self._names("rows"):
            if int(name.split("=")[1]) not in read and int(name.split("=")[1]) < number:
                self.fs.delete(self.fs_path(f"{self.folder}/rows/{name}"), True)
        self.fs.delete(self.fs_path(f"{self.folder}/new"), True)
