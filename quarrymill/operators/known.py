"""Keys against a large set of known ones: a stored filter of bits tells most new keys apart, and only the rest are joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one bitmap, as Spark's bitmap functions have them; bits for each key, and how many of them it sets.
BITS, PER_KEY, SET = 32_768, 16, 3


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _places(h: Column, buckets: int) -> tuple[Column, Column]:
    """The bucket of a hash and its bits there."""
    bits = F.array(*[F.pmod(F.xxhash64(h, F.lit(k)), F.lit(BITS)) for k in range(1, SET + 1)])
    return F.pmod(h, F.lit(buckets)), bits


def build(known: DataFrame, keys: Sequence[str], folder: str) -> None:
    """Writes the filter of the known keys: bitmaps by parts of the keys' hash, with PER_KEY bits for each row."""
    n = known.count()
    buckets = max(1, -(-n * PER_KEY // BITS))
    bucket, bits = _places(_hash(keys), buckets)
    rows = known.select(bucket.alias("bucket"), F.explode(bits).alias("bit"))
    rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{folder}/bits")


def maybe_known(spark: SparkSession, new: DataFrame, keys: Sequence[str], folder: str) -> DataFrame:
    """new with `maybe`: false where the key is surely none of the known. Rows meet the one bitmap of their bucket."""
    stored = spark.read.schema("bucket long, bits binary, buckets int").parquet(f"{folder}/bits")
    first = stored.select("buckets").first()
    if first is None:
        return new.withColumn("maybe", F.lit(False))
    bucket, bits = _places(_hash(keys), first["buckets"])
    held = F.col("_bits")
    byte = lambda p: F.conv(F.hex(F.substring(held, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.forall(bits, lambda p: F.get(F.array(F.lit(1), F.lit(2), F.lit(4), F.lit(8), F.lit(16), F.lit(32), F.lit(64), F.lit(128)), (p % 8).cast("int")).bitwiseAND(byte(p)) != 0)
    named = stored.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    return new.withColumn("_bucket", bucket).join(named, "_bucket", "left").withColumn("maybe", F.coalesce(there, F.lit(False))).drop("_bucket", "_bits")


def split(new: DataFrame, known: DataFrame, keys: Sequence[str], folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows of new whose key is not known, and those whose key is. The filter holds all of known, and perhaps more; keys
    that it takes for known are joined. Rows with a null in their key are new."""
    marked = maybe_known(new.sparkSession, new, keys, folder)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    suspect = marked.filter(F.col("maybe") & whole).drop("maybe")
    names = known.select(*keys)
    fresh = marked.filter(~(F.col("maybe") & whole)).drop("maybe").unionByName(suspect.join(names, list(keys), "left_anti"))
    return fresh, suspect.join(names, list(keys), "left_semi")


def refreshed(known: DataFrame, seen: DataFrame, keys: Sequence[str], at: str, times: str | None = None) -> DataFrame:
    """known with the time of the last sighting, where there is a later one, and one more time for each."""
    last = seen.groupBy(*keys).agg(F.max(at).alias("_at"), F.count("*").alias("_n"))
    out = known.join(last, list(keys), "left").withColumn(at, F.greatest(F.col(at), F.coalesce(F.col("_at"), F.col(at))))
    if times:
        out = out.withColumn(times, F.col(times) + F.coalesce(F.col("_n"), F.lit(0)))
    return out.drop("_at", "_n").select(*known.columns)
