"""Set-based market figures: quantiles, cohorts, coverage, health. Each takes DataFrames and returns one."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.numbers import decade, price_band
from quarrymill.operators import scans
from quarrymill.sources.shared import stored


def quantiles(df: DataFrame, keys: Sequence[str], price: str, least: int = 1) -> DataFrame:
    """n, continuous quartiles rounded half to even, min and max of each group of at least `least` rows.

    percentile() is exact; its partial sums are counts of different prices, so a large group with few prices stays small.
    """
    q = F.percentile(price, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = df.filter(F.col(price).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), q.alias("q"), F.min(price).alias("min_px"), F.max(price).alias("max_px"))
    rounded = [F.rint(F.col("q")[k]).cast("long").alias(name) for k, name in enumerate(("p25", "median_px", "p75"))]
    return out.filter(F.col("n") >= least).select(*keys, "n", *rounded, F.rint("min_px").cast("long").alias("min_px"), F.rint("max_px").cast("long").alias("max_px"))


def nearest_rank(df: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """Quartiles by rank, xs[n // 4] and xs[3 * n // 4] of the sorted prices: ranked by ranges, so no group is one task's."""
    ranked = scans.ranks(df.filter(F.col(price).isNotNull()).select(*keys, F.col(price).alias("px")), keys, ["px"])
    pick = lambda at: F.max(F.when(F.col("_place") - 1 == at, F.col("px")))
    n = F.col("_rows")
    out = ranked.groupBy(*keys).agg(F.max(n).alias("n"), pick(F.floor(n / 4)).alias("q25"), pick(F.floor(3 * n / 4)).alias("q75"))
    return out.select(*keys, "n", "q25", "q75")


def cascade(df: DataFrame, price: str, tiers: Sequence[tuple[Sequence[str], Column]], eligible: Column, least: int = 5) -> DataFrame:
    """Fair price of each row from the first tier whose cohort is large enough: tier, cote_low, cote_mid, cote_high, deal_pct.

    tiers: key columns and a condition, finest first. Cohorts are those of all eligible rows, whatever other tiers give.
    All figures of a row come from one tier. df is read once and kept; one aggregation gives the cohorts of all tiers, which
    are then joined by key, and Spark broadcasts those that turn out small.
    """
    fits = [F.when(F.col("_ok") & condition, F.array(*[F.col(k).cast("string") for k in keys])) for keys, condition in tiers]
    kept = stored(df.withColumn("_ok", F.coalesce(eligible & F.col(price).isNotNull(), F.lit(False))).withColumn("_keys", F.array(*fits)), "cascade")
    each = kept.filter("_ok").select(F.col(price).alias("_px"), F.posexplode("_keys").alias("tier", "key")).filter("key is not null").withColumn("tier", F.col("tier") + 1)
    q = F.percentile("_px", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    cohorts = stored(each.groupBy("tier", "key").agg(F.count("*").alias("n"), q.alias("q")).filter((F.col("n") >= least) & (F.col("q")[1] > 0)).select("tier", "key", "q"), "cohorts")
    out = kept
    for k in range(1, len(tiers) + 1):
        own = cohorts.filter(F.col("tier") == k).select(F.col("key").alias(f"_key{k}"), F.col("q").alias(f"_q{k}"))
        out = out.join(own, F.element_at("_keys", k) == F.col(f"_key{k}"), "left").drop(f"_key{k}")
    found = [F.when(F.col(f"_q{k}").isNotNull(), F.struct(F.lit(k).alias("tier"), F.col(f"_q{k}").alias("q"))) for k in range(1, len(tiers) + 1)]
    out = out.withColumn("_best", F.coalesce(*found))
    q = F.col("_best.q")
    out = out.withColumns({"tier": F.col("_best.tier"), "cote_low": F.rint(q[0]).cast("long"), "cote_mid": F.rint(q[1]).cast("long"), "cote_high": F.rint(q[2]).cast("long"), "deal_pct": F.rint((F.col(price) - q[1]) * 100.0 / q[1]).cast("long")})
    return out.drop("_ok", "_keys", "_best", *[f"_q{k}" for k in range(1, len(tiers) + 1)])


#: Keys of the fair price's cohorts, finest first: model and decade, model, by how the model is known.
FAIR_PRICE_TIERS = [["canonical_id", "_dec"], ["canonical_id"], ["ref_model_id", "_dec"], ["ref_model_id"], ["_mk", "gen_family", "_dec"], ["_mk", "gen_family"], ["_mk", "_mo", "_dec"], ["_mk", "_mo"]]


def fair_price(cars: DataFrame, least: int = 5) -> DataFrame:
    """cascade() over active cars that are no auctions and have a price, by FAIR_PRICE_TIERS.

    cars: canonical_id, ref_model_id, gen_family, mk, mo, mo_canon, yr, px, status, is_auction. Empty makes, families and
    models are none; a cohort needs all its keys.
    """
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = cars.withColumns({"_mk": F.lower(given("mk")), "_mo": F.lower(F.coalesce(given("mo_canon"), "mo")), "_dec": decade(F.col("yr")), "gen_family": given("gen_family")})
    every = lambda keys: F.expr(" and ".join(f"{k} is not null" for k in keys))
    eligible = (F.col("status") == "active") & ~F.col("is_auction") & (F.col("px") > 0)
    return cascade(rows, "px", [(keys, every(keys)) for keys in FAIR_PRICE_TIERS], eligible, least).drop("_mk", "_mo", "_dec")


def source_share(df: DataFrame, source: str, price: str) -> DataFrame:
    """Of each source its rows, quartiles by rank of its prices and share of all rows, and the median of all prices."""
    priced = df.filter(F.col(price) > 0)
    (median,) = exact_percentiles(priced, price, [0.5])
    counts = df.groupBy(source).agg(F.count("*").alias("rows"))
    return counts.withColumn("share_pct", F.round(100.0 * F.col("rows") / max(df.count(), 1), 4)).join(nearest_rank(priced, [source], price), source, "left").withColumn("median_all", F.lit(median).cast("double"))


def exact_percentiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Exact percentiles, continuous between neighbours, of a whole column, however many different values it has."""
    found = scans.percentiles(df, [], column, shares).first()
    return [found[f"p{k}"] if found and found["n"] else None for k in range(len(shares))]


def snapshot(df: DataFrame, price: str, fresh: Column, source: str, country: str, deal: Column) -> DataFrame:
    """One row of market figures. What they need of df is made once; percentiles are exact; different sources and countries
    are counted by partial sums."""
    df = stored(df.select(price, F.col(source).alias("_source"), F.col(country).alias("_country"), fresh.alias("_fresh"), deal.alias("_deal")), "snapshot")
    p25, median, p75 = exact_percentiles(df, price, [0.25, 0.5, 0.75])
    one = df.agg(F.min(price).alias("lo"), F.max(price).alias("hi"), F.count("*").alias("n_total"), F.count_if("_fresh").alias("n_fresh"), F.countDistinct("_source").alias("n_sources"), F.countDistinct("_country").alias("n_countries"), F.count_if("_deal").alias("n_deals"))
    at = lambda c: F.rint(c).cast("long")
    told = lambda x: at(F.lit(x).cast("double"))
    return one.select(told(median).alias("median_px"), told(p25).alias("p25"), told(p75).alias("p75"), at(F.col("lo")).alias("min_px"), at(F.col("hi")).alias("max_px"), "n_total", "n_fresh", "n_sources", "n_countries", "n_deals")


def longest_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], bad: Column) -> DataFrame:
    """Of each key the longest run of rows in a row for which `bad` holds; keys without any are left out. Rows of a run have
    as many good rows of their key before them."""
    marked = df.select(*keys, *order, F.coalesce(bad, F.lit(False)).alias("_bad"))
    placed = scans.scan(marked, keys, order, {"_good": ("sum", F.when(F.col("_bad"), 0).otherwise(1).cast("long"))})
    runs = placed.filter("_bad").groupBy(*keys, "_good").agg(F.count("*").alias("_n"))
    return runs.groupBy(*keys).agg(F.max("_n").alias("longest"))


def price_bands(df: DataFrame, price: str) -> DataFrame:
    return df.groupBy(price_band(F.col(price)).alias("band")).agg(F.count("*").alias("n"))


def supply(df: DataFrame, key: Column, least: int = 3) -> DataFrame:
    return df.groupBy(key.alias("segment")).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def mode_of(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each group (of equal ones the least), its count, the group's rows: counts first, so no
    group's rows come together in one task."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("k"))
    best = F.min_by(F.col(value), F.struct(-F.col("k"), F.col(value)))
    return counts.groupBy(*keys).agg(best.alias(value), F.max("k").alias("top"), F.sum("k").alias("n"))


def dominant_ratio(df: DataFrame, keys: Sequence[str], price: str, least: int = 5, broken: float = 0.7, watch: float = 0.5) -> DataFrame:
    """How far one price dominates a source: share of the modal price, and a class."""
    out = mode_of(df, keys, price).filter(F.col("n") >= least).withColumn("ratio", F.col("top") / F.col("n"))
    return out.withColumn("class", F.when(F.col("ratio") >= broken, "BROKEN").when(F.col("ratio") >= watch, "watch").otherwise("ok"))


def source_health(sources: DataFrame, rows: DataFrame, key: str, active: Column) -> DataFrame:
    """Active and all rows of every source, and whether it is ok, mute (rows, none active) or empty."""
    counts = rows.groupBy(key).agg(F.count_if(active).alias("active"), F.count("*").alias("total"))
    out = sources.join(counts, key, "left").fillna(0, ["active", "total"])
    return out.withColumn("state", F.when(F.col("total") == 0, "empty").when(F.col("active") == 0, "mute").otherwise("ok"))


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each column the share of rows with a value that is not blank, in percent."""
    filled = [F.round(100.0 * F.avg(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1.0).otherwise(0.0)), 2).alias(c) for c in columns]
    return df.agg(*filled).unpivot([], list(columns), "column", "pct")


def dominant_value(df: DataFrame, key: str, value: str, least: int = 5, share: float = 0.8) -> DataFrame:
    """The value to fill in where a group's is missing: one that holds for `share` of at least `least` known rows."""
    missing = df.groupBy(key).agg(F.count_if(F.col(value).isNull()).alias("missing"))
    top = mode_of(df, [key], value)
    return top.join(missing, key).filter((F.col("n") >= least) & (F.col("top") / F.col("n") >= share) & (F.col("missing") > 0)).select(key, value, "n", "missing")


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    twice = df.groupBy(*keys).count().filter("count > 1").select(*keys)
    return df.join(twice, list(keys), "left_semi")


def cross_source(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """Keys that at least two sources have."""
    return df.groupBy(*keys).agg(F.countDistinct(source).alias("n_sources"), F.count("*").alias("n")).filter("n_sources >= 2")


def feature_gain(df: DataFrame, before: Sequence[str], after: Sequence[str]) -> DataFrame:
    """For each flag the rows that have it before and after, and those that gained it."""
    sums = [s for b, a in zip(before, after, strict=True) for s in (F.count_if(F.col(b)).alias(f"{b}_0"), F.count_if(~F.col(b) & F.col(a)).alias(f"{b}_1"), F.count_if(F.col(a)).alias(f"{b}_2"))]
    one = df.agg(*sums)
    rows = F.array(*[F.struct(F.lit(b).alias("flag"), F.col(f"{b}_0").alias("before"), F.col(f"{b}_1").alias("gain"), F.col(f"{b}_2").alias("after")) for b in before])
    return one.select(F.inline(rows))


def keyword_recall(df: DataFrame, text: str, flags: dict[str, Sequence[str]]) -> DataFrame:
    """For each flag and keyword: texts that have the keyword, and those among them without the flag. One pass, no join."""
    sums, rows = [], []
    for k, (flag, word) in enumerate((f, w) for f, words in flags.items() for w in words):
        has = F.coalesce(F.col(text).ilike(f"%{word}%"), F.lit(False))
        sums += [F.count_if(has).alias(f"t{k}"), F.count_if(has & ~F.coalesce(F.col(flag), F.lit(False))).alias(f"m{k}")]
        rows.append(F.struct(F.lit(flag).alias("flag"), F.lit(word).alias("keyword"), F.col(f"t{k}").alias("n_text"), F.col(f"m{k}").alias("n_missed")))
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def trend(df: DataFrame, keys: Sequence[str], order: str, value: str, step: float = 5.0) -> DataFrame:
    """Mean of the later half against the rest, which for an odd number is longer; under three values there is no telling."""
    ranked = scans.ranks(df.select(*keys, order, value), keys, [order])
    late = F.col("_place") > F.col("_rows") - F.floor(F.col("_rows") / 2)
    out = ranked.groupBy(*keys).agg(F.count("*").alias("n"), (F.avg(F.when(late, F.col(value))) - F.avg(F.when(~late, F.col(value)))).alias("delta"))
    return out.withColumn("trend", F.when(F.col("n") < 3, "insufficient_data").when(F.col("delta") > step, "improving").when(F.col("delta") < -step, "degrading").otherwise("stable"))


def touched(old: DataFrame, new: DataFrame, key: str, watched: Sequence[str], at: str, now: Column) -> DataFrame:
    """Rows of new with the time of their last change: `now` where one of the watched columns differs from old's or the
    key is new, else old's."""
    before = old.select(key, F.col(at).alias("_at"), *[F.col(c).alias(f"_{c}") for c in watched])
    same = F.lit(True)
    for c in watched:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = new.join(before, key, "left").withColumn(at, F.when(same & F.col("_at").isNotNull(), F.col("_at")).otherwise(now))
    return out.drop("_at", *[f"_{c}" for c in watched])


def call(spark, functions: dict, name: str, arguments: str) -> DataFrame:
    """A registered function by name, with its arguments as a JSON object; an unknown name or argument is an error."""
    if name not in functions:
        raise ValueError(f"no function {name}; there are {', '.join(sorted(functions))}")
    return functions[name](**json.loads(arguments))
