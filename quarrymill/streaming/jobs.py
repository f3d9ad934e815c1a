"""Streams of sightings: duplicates within a watermark, counts in windows, and a table of listings kept by upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrymill.operators.lifecycle import upsert
from quarrymill.sources.parted import PARTS, Parted
from quarrymill.sources.shared import shared_folder


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stream of the Parquet files of a folder, or of one file by its pattern."""
    return spark.readStream.schema(schema).option("pathGlobFilter", path.rsplit("/", 1)[1]).parquet(path.rsplit("/", 1)[0])


def with_event_time(stream: DataFrame, at: str, late: str) -> DataFrame:
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def first_seen(stream: DataFrame, keys: list[str], at: str = "ts", late: str = "1 day") -> DataFrame:
    """Each key once within the watermark's delay; state older than that is dropped."""
    return with_event_time(stream, at, late).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, at: str, length: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Counts in tumbling windows, given once a window can't change any more."""
    return with_event_time(stream, at, late).groupBy(F.window(at, length), *keys).agg(F.count("*").alias("n"))


def finish(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all that is there, into Parquet files."""
    stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def keep_table(stream: DataFrame, folder: str, keys: list[str], order: str, parts: int = PARTS) -> Parted:
    """Keeps a table of the last row of each key, in parts by the keys' hash, of which a batch rewrites those it touches. A
    batch that is run again after a failure gives the same table."""
    table = Parted(stream.sparkSession, folder, stream.schema, keys, parts)

    def put(batch: DataFrame, number: int) -> None:
        table.write(batch, number, lambda old, new: upsert(old, new, keys, order))

    stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return table


def dedup_once(spark: SparkSession, sf_dir: str, schema: StructType) -> DataFrame:
    """First sightings of each user and kind of event."""
    folder = shared_folder(spark, "dedup")
    stream = first_seen(read(spark, f"{sf_dir}/events.parquet", schema), ["user_id", "event_type"], late="40 days")
    finish(stream.select("event_id", "user_id", "event_type"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema("event_id long, user_id long, event_type string").parquet(f"{folder}/out").select("user_id", "event_type")


def lifecycle_once(spark: SparkSession, sf_dir: str, schema: StructType) -> DataFrame:
    """The last event of each user."""
    folder = shared_folder(spark, "lifecycle")
    stream = read(spark, f"{sf_dir}/events.parquet", schema)
    return keep_table(stream.withColumn("at", F.struct("ts", "event_id")), folder, ["user_id"], "at").current().drop("at")
