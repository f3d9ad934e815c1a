"""Helpers that several corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a new local one if the driver
    is the only executor, as in tests; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarrymill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_WRITTEN: list[str] = []


def clear_stored(spark: SparkSession) -> None:
    """Deletes what this driver has stored so far. For when all results are written: those that are not read from it."""
    for path in _WRITTEN:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _WRITTEN.clear()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarrymill/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, column: str, values: tuple[str, ...]) -> dict[str, DataFrame]:
    """As stored(), for rows with each of the values of a column, by value. Each can be deleted when it is used up."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarrymill/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").partitionBy(column).parquet(path)
    rest = df.drop(column)
    # an empty folder is there for values without rows, so that it can be read
    for value in values:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return {v: spark.read.schema(rest.schema).parquet(f"{path}/{column}={v}") for v in values}


def used_up(df: DataFrame) -> None:
    """Deletes the files that a stored table is read from, once what is made of it is stored as well."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


#: Ids that are broadcast at most; as hashed longs they take about 24 bytes each.
MOST_IDS = 2_000_000


def counted(ids: DataFrame, label: str, most: int = MOST_IDS) -> DataFrame:
    """Writes and counts ids that are to be joined with a table: marked for broadcast if there are no more than `most`,
    else left for a shuffle."""
    at = stored(ids, label)
    return F.broadcast(at) if at.limit(most + 1).count() <= most else at


def tasks_for(spark: SparkSession, least: int = 1) -> int:
    """Number of partitions for a shuffle that deals by a computed key."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def let(value, body):
    """An expression over a value that is computed once: body is a function of it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(doc_id: str, of: int):
    """crc32 of the id as text, modulo `of`; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of


#: Bytes of text that are worked on at once in Python.
CHUNK_BYTES = 2_000_000
#: Words whose hashes a task keeps.
KEPT_WORDS = 300_000


class WordHashes(dict):
    """XXH64 of words, kept for those met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Deals a batch's texts (null: empty) out in lists of about CHUNK_BYTES; with the place of each list's first."""
    got: list[bytes] = []
    begin = size = 0
    for k, text in enumerate(texts):
        got.append(text.as_py() or b"")
        size += len(got[-1])
        if size >= CHUNK_BYTES:
            yield begin, got
            got, begin, size = [], k + 1, 0
    if got:
        yield begin, got


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long, as doc_id) and the text as UTF-8 bytes."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
