"""Listings over time and writes to a table: upserts, moves, sweeps, price logs, circuit breakers, cursors, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.functions.numbers import price_moved
from quarrymill.operators.scans import scan


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """old with the rows of new in the place of those with the same keys; of new rows with equal keys the last by `order`
    counts. Columns of old that new lacks are null in new rows."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    latest = new.withColumn("_r", rank).filter("_r = 1").drop("_r")
    return old.join(latest.select(*keys), list(keys), "left_anti").unionByName(latest, allowMissingColumns=True)


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with those rows of new whose keys it lacks, one for each key."""
    return old.unionByName(new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def update_from(old: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """old with columns set from changes (one row for each key) where they are not null there."""
    named = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = old.join(named, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns}).drop(*[f"_new_{c}" for c in columns]).select(*old.columns)


def sighted(old: DataFrame, seen: DataFrame, key: str, order: str, now: Column) -> DataFrame:
    """The table of listings after a batch of sightings: old has key, price, status, exit_reason, times_seen, last_seen_at
    and photos, seen has key, price, photos and what orders the sightings of a key, of which the last counts.

    A sighting of a listing sets last_seen_at and status and counts; the price follows only where it has moved, the photos
    where there are some. What was sold does not come back. A sighting of no listing is a new one.
    """
    last = seen.groupBy(key).agg(F.max_by(F.struct("price", "photos"), F.col(order)).alias("_s"), F.lit(True).alias("_seen"))
    out = old.withColumn("_old", F.lit(True)).join(last, key, "full")
    sold = F.coalesce((F.col("status") == "expired") & (F.col("exit_reason") == "sold"), F.lit(False))
    again = F.coalesce(F.col("_seen"), F.lit(False)) & ~sold
    new = F.col("_old").isNull()
    moved = again & F.col("_s.price").isNotNull() & (new | price_moved(F.col("price"), F.col("_s.price")))
    changes = {
        "price": F.when(moved, F.col("_s.price")).otherwise(F.col("price")),
        "photos": F.when(again & (F.size(F.coalesce("_s.photos", F.array())) > 0), F.col("_s.photos")).otherwise(F.col("photos")),
        "times_seen": F.when(again, F.coalesce("times_seen", F.lit(0)) + 1).otherwise(F.col("times_seen")),
        "last_seen_at": F.when(again, now).otherwise(F.col("last_seen_at")),
        "status": F.when(again, "active").otherwise(F.col("status")),
    }
    return out.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in old.columns])


def move(df: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    """Rows to archive and rows to keep; a condition that is unknown keeps."""
    sure = F.coalesce(gone, F.lit(False))
    return df.filter(sure), df.filter(~sure)


def stale(df: DataFrame, status: str, seen: str, as_of: Column, days: int) -> DataFrame:
    """Active rows that were not seen for over `days` days become expired."""
    old = (F.col(status) == "active") & (F.col(seen) < as_of - F.expr(f"INTERVAL {int(days)} DAYS"))
    return df.withColumn(status, F.when(old, "expired").otherwise(F.col(status)))


def price_log(df: DataFrame, key: str, at: str, price: str, tolerance: float = 0.0) -> DataFrame:
    """The prices of each key that differ from the one before, by more than the tolerance if there is one."""
    out = scan(df, [key], [at, price], {"_before": ("lag", F.col(price)), "_place": ("sum", F.lit(1).cast("long"))})
    moved = F.abs(F.col(price) - F.col("_before")) / F.nullif(F.abs("_before"), F.lit(0)) >= tolerance if tolerance else ~F.col(price).eqNullSafe(F.col("_before"))
    return out.filter((F.col("_place") == 1) | moved).drop("_before", "_place")


def failures(df: DataFrame, key: str, order: Sequence[str], failed: Column, limit: int = 3) -> DataFrame:
    """Failures of each key since its last success; at `limit` the breaker is open. Only aggregates: the last success is
    found, then what came after it is counted."""
    at = F.struct(*order)
    last = df.groupBy(key).agg(F.max(F.when(~failed, at)).alias("_ok"))
    out = df.join(last, key).groupBy(key).agg(F.count_if(failed & (F.col("_ok").isNull() | (at > F.col("_ok")))).alias("failures"))
    return out.withColumn("open", F.col("failures") >= limit)


def lifespan(df: DataFrame, key: str, at: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("times_seen"))


def cursor(df: DataFrame, at: str, tie: str, n: int) -> DataFrame:
    """The n rows that were checked longest ago, those never checked first."""
    return df.orderBy(F.col(at).asc_nulls_first(), tie).limit(n)


def soonest(df: DataFrame, closes: str, as_of: Column, hours: int, tie: str, n: int) -> DataFrame:
    """Rows that close within so many hours first, then the rest, by time; n in all."""
    urgent = F.col(closes) < as_of + F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.orderBy(F.desc(F.coalesce(urgent, F.lit(False))), F.col(closes).asc_nulls_last(), tie).limit(n)


def cap_per_group(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_r", rank).filter(F.col("_r") <= n).drop("_r")


def stratified(df: DataFrame, stratum: Column, id_col: str, n: int, seed: int) -> DataFrame:
    """n rows of each stratum, the first by a hash of id and seed."""
    marked = df.withColumn("stratum", stratum)
    return cap_per_group(marked.withColumn("_h", F.xxhash64(id_col, F.lit(seed))), "stratum", ["_h", id_col], n).drop("_h")


def shard(df: DataFrame, key: str, of: int, which: int) -> DataFrame:
    return df.filter(F.crc32(F.col(key).cast("string").cast("binary")) % of == which)


def reconcile(wanted: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """What a table says of the keys wanted of it (columns status, active, listings_url): manual_inspect, inactive,
    active_carpage, active_root or absent."""
    from quarrymill.functions.text import url_shape

    out = wanted.join(table.withColumn("_there", F.lit(True)), key, "left")
    category = (
        F.when(F.col("_there").isNull(), "absent")
        .when(F.col("status") == "manual_inspect", "manual_inspect")
        .when(~F.coalesce("active", F.lit(False)), "inactive")
        .when(url_shape(F.coalesce("listings_url", F.lit(""))) == "car_page", "active_carpage")
        .otherwise("active_root")
    )
    return out.withColumn("category", category).drop("_there")
