"""Market queries over the order tables, which play the listings: a line is a listing, its part the model, its supplier
the source, its order's year the year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import numbers as N
from quarrymill.functions import text as T
from quarrymill.operators import aggregates as A
from quarrymill.operators import intervals as I
from quarrymill.operators import lifecycle as C
from quarrymill.operators import matching as M
from quarrymill.operators import scans as S

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def listing(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("p_brand").alias("mk"), F.col("p_name").alias("mo"), F.col("p_type").alias("typ"), F.col("p_size").alias("sz"),
        F.col("l_extendedprice").alias("px"), F.year("o_orderdate").alias("yr"), (F.col("l_quantity") * 1000).cast("long").alias("km"), F.col("l_suppkey").alias("src"),
        F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("flag"), F.col("l_shipdate").alias("seen"),
    )


LISTING = """with listing as (
  select l_orderkey * 10 + l_linenumber as id, p_brand as mk, p_name as mo, p_type as typ, p_size as sz, l_extendedprice as px, year(o_orderdate)::int as yr,
    (l_quantity * 1000)::bigint as km, l_suppkey as src, l_linestatus as status, l_returnflag as flag, l_shipdate as seen
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey) """
QUARTILES = "round_even(quantile_cont(px, 0.25), 0)::bigint as p25, round_even(quantile_cont(px, 0.5), 0)::bigint as median_px, round_even(quantile_cont(px, 0.75), 0)::bigint as p75"


@query(LISTING + f"select mk, typ, count(*) as n, {QUARTILES}, round_even(min(px), 0)::bigint as min_px, round_even(max(px), 0)::bigint as max_px from listing group by mk, typ")
def segment_quantiles(spark, d):
    return A.quantiles(listing(spark, d), ["mk", "typ"], "px")


@query(LISTING + f"select mk, typ, (floor(yr / 10.0) * 10)::int as decade, count(*) as n, {QUARTILES}, round_even(min(px), 0)::bigint as min_px, round_even(max(px), 0)::bigint as max_px from listing where flag <> 'A' group by all having count(*) >= 5")
def cohort_quantiles(spark, d):
    return A.quantiles(listing(spark, d).filter("flag <> 'A'").withColumn("decade", N.decade(F.col("yr"))), ["mk", "typ", "decade"], "px", 5)


@query(LISTING + ", r as (select src, px, row_number() over (partition by src order by px) - 1 as r, count(*) over (partition by src) as n from listing) select src, n, max(case when r = n // 4 then px end) as q25, max(case when r = 3 * n // 4 then px end) as q75 from r group by src, n")
def segment_quantiles_nearest_rank(spark, d):
    return A.nearest_rank(listing(spark, d), ["src"], "px")


_COTE = ", base as (select listing.id, mk, mo, px, yr, case when status = 'O' then 'active' else 'sold' end as status, flag = 'N' as is_auction, case when sz > 30 then typ || mk end as canonical_id, case when sz > 20 then typ end as ref_model_id, case when sz > 10 then split_part(typ, ' ', 1) end as gen_family, case when sz % 2 = 0 then upper(mo) end as mo_canon from listing), " \
    "b as (select *, lower(mk) as mkl, lower(coalesce(nullif(mo_canon, ''), mo)) as mol, (floor(yr / 10.0) * 10)::int as dec10, status = 'active' and not is_auction and px > 0 as ok from base)"
_TIERS = ["canonical_id, dec10", "canonical_id", "ref_model_id, dec10", "ref_model_id", "mkl, gen_family, dec10", "mkl, gen_family", "mkl, mol, dec10", "mkl, mol"]


def _cascade_sql() -> str:
    out = LISTING + _COTE
    for k, keys in enumerate(_TIERS, 1):
        out += f", c{k} as (select {keys}, quantile_cont(px, 0.25) as q1, quantile_cont(px, 0.5) as q2, quantile_cont(px, 0.75) as q3 from b where ok and " + " and ".join(f"{c} is not null" for c in keys.split(", ")) + " group by all having count(*) >= 5)"
    every = range(1, len(_TIERS) + 1)
    out += ", t as (select id, px, case " + " ".join(f"when ok and c{k}.q2 > 0 then {k}" for k in every) + " end as tier, " + ", ".join(f"c{k}.q{q} as v{k}_{q}" for k in every for q in (1, 2, 3)) + " from b"
    for k, keys in enumerate(_TIERS, 1):
        out += f" left join c{k} on " + " and ".join(f"b.{c} = c{k}.{c}" for c in keys.split(", "))
    pick = lambda q: "case tier " + " ".join(f"when {k} then v{k}_{q}" for k in every) + " end"
    return out + f") select id, tier::int as tier, round_even({pick(1)}, 0)::bigint as cote_low, round_even({pick(2)}, 0)::bigint as cote_mid, round_even({pick(3)}, 0)::bigint as cote_high, round_even((px - {pick(2)}) * 100.0 / {pick(2)}, 0)::bigint as deal_pct from t"


@query(_cascade_sql())
def cohort_cascade(spark, d):
    part = lambda c, least: F.when(F.col("sz") > least, c)
    cars = listing(spark, d).select(
        "id", "mk", "mo", "px", "yr", F.when(F.col("status") == "O", "active").otherwise("sold").alias("status"), (F.col("flag") == "N").alias("is_auction"),
        part(F.concat("typ", "mk"), 30).alias("canonical_id"), part(F.col("typ"), 20).alias("ref_model_id"), part(F.split_part("typ", F.lit(" "), F.lit(1)), 10).alias("gen_family"), F.when(F.col("sz") % 2 == 0, F.upper("mo")).alias("mo_canon"),
    )
    return A.fair_price(cars).select("id", "tier", "cote_low", "cote_mid", "cote_high", "deal_pct")


@query(LISTING + ", c as (select mk, typ, count(*) as n, quantile_cont(px, 0.25) as p25, quantile_cont(px, 0.75) as p75 from listing where sz > 48 group by all) select id, case when coalesce(n, 0) < 5 then 'insufficient' when px < p25 then 'under' when px > p75 then 'over' else 'at' end as deal from listing left join c using (mk, typ)")
def deal_class(spark, d):
    base = listing(spark, d)
    q = base.filter("sz > 48").groupBy("mk", "typ").agg(F.count("*").alias("n"), F.percentile("px", 0.25).alias("p25"), F.percentile("px", 0.75).alias("p75"))
    return base.join(q, ["mk", "typ"], "left").select("id", N.deal_class(F.col("px"), F.col("p25"), F.col("p75"), F.col("n")).alias("deal"))


@query("select round_even(quantile_cont(o_totalprice, 0.5), 0)::bigint as median_px, round_even(quantile_cont(o_totalprice, 0.25), 0)::bigint as p25, round_even(quantile_cont(o_totalprice, 0.75), 0)::bigint as p75, round_even(min(o_totalprice), 0)::bigint as min_px, round_even(max(o_totalprice), 0)::bigint as max_px, count(*) as n_total, count(*) filter (where o_orderdate >= timestamp '2001-07-01') as n_fresh, count(distinct o_custkey) as n_sources, count(distinct c_nationkey) as n_countries, count(*) filter (where o_orderstatus = 'F') as n_deals from orders join customer on o_custkey = c_custkey")
def market_snapshot(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.snapshot(rows, "o_totalprice", F.col("o_orderdate") >= F.expr("timestamp_ntz '2001-07-01'"), "o_custkey", "c_nationkey", F.col("o_orderstatus") == "F")


@query("select case when o_totalprice is null then 'none' when o_totalprice < 25000 then 'lt25k' when o_totalprice < 100000 then '25_100k' when o_totalprice < 500000 then '100_500k' else 'ge500k' end as band, count(*) as n from orders group by 1")
def price_bands(spark, d):
    return A.price_bands(table(spark, d, "orders"), "o_totalprice")


@query(LISTING + "select lower(mk) || '|' || lower(typ) as segment, count(*) as n from listing where status = 'O' group by 1 having count(*) >= 3")
def market_supply(spark, d):
    return A.supply(listing(spark, d).filter("status = 'O'"), F.concat_ws("|", F.lower("mk"), F.lower("typ")))


@query("select event_type, max(ts) as last_run, max(ts) filter (where value > 50) as last_ok, count(*) filter (where ts >= timestamp '2024-01-23') as runs_7d, coalesce(sum(user_id) filter (where ts >= timestamp '2024-01-23'), 0)::bigint as items_7d, round(avg(value), 2) as avg_value, case when max(ts) >= timestamp '2024-01-28' then 'ok' else 'late' end as health from events group by event_type")
def ops_dashboard(spark, d):
    week, late = F.expr("timestamp_ntz '2024-01-23'"), F.expr("timestamp_ntz '2024-01-28'")
    return table(spark, d, "events").groupBy("event_type").agg(
        F.max("ts").alias("last_run"), F.max(F.when(F.col("value") > 50, F.col("ts"))).alias("last_ok"), F.count_if(F.col("ts") >= week).alias("runs_7d"),
        F.coalesce(F.sum(F.when(F.col("ts") >= week, F.col("user_id"))), F.lit(0)).alias("items_7d"), F.round(F.avg("value"), 2).alias("avg_value"), F.when(F.max("ts") >= late, "ok").otherwise("late").alias("health"),
    )


@query("select case when s_acctbal < 0 then 'red' when s_acctbal < 5000 then 'amber' else 'green' end as cron, r_name as tier, count(*) as n, count(*) filter (where s_acctbal > 0) as n_active from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2")
def sources_by_cron(spark, d):
    rows = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    cron = F.when(F.col("s_acctbal") < 0, "red").when(F.col("s_acctbal") < 5000, "amber").otherwise("green")
    return rows.groupBy(cron.alias("cron"), F.col("r_name").alias("tier")).agg(F.count("*").alias("n"), F.count_if(F.col("s_acctbal") > 0).alias("n_active"))


@query(LISTING + ", ref as (select distinct p_brand as mk, p_name as mo from part where p_size > 25) select mk, count(*) as n, count(*) filter (where ref.mo is not null) as matched, round(100.0 * count(*) filter (where ref.mo is not null) / count(*), 1) as pct from listing left join ref using (mk, mo) group by mk")
def match_pct(spark, d):
    ref = table(spark, d, "part").filter("p_size > 25").select(F.col("p_brand").alias("mk"), F.col("p_name").alias("mo"), F.lit(1).alias("hit")).distinct()
    rows = listing(spark, d).join(ref, ["mk", "mo"], "left")
    return rows.groupBy("mk").agg(F.count("*").alias("n"), F.count("hit").alias("matched"), F.round(100.0 * F.count("hit") / F.count("*"), 1).alias("pct"))


@query(LISTING + "select mk, mo, count(*) as n from listing where not exists (select 1 from part where p_brand = mk and p_name = mo and p_size > 40) group by mk, mo order by n desc, mk, mo limit 20")
def fallback_top(spark, d):
    ref = table(spark, d, "part").filter("p_size > 40").select(F.col("p_brand").alias("mk"), F.col("p_name").alias("mo"))
    return listing(spark, d).join(ref, ["mk", "mo"], "left_anti").groupBy("mk", "mo").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "mk", "mo").limit(20)


@query("with s as (select p_brand, p_name, count(*) as n from part group by all) select count(*) as total, count(*) filter (where n >= 2) as eligible, round(avg(n), 1) as avg_n from s")
def segment_stats(spark, d):
    s = table(spark, d, "part").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    return s.agg(F.count("*").alias("total"), F.count_if(F.col("n") >= 2).alias("eligible"), F.round(F.avg("n"), 1).alias("avg_n"))


@query(LISTING + "select mk, mo, count(*) as n, round_even(round(sum(px), 2) / count(*), 0)::bigint as avg_px, min(px) as min_px, max(px) as max_px from listing where flag = 'R' group by mk, mo having count(*) >= 3")
def realised_proxy(spark, d):
    return listing(spark, d).filter("flag = 'R'").groupBy("mk", "mo").agg(F.count("*").alias("n"), F.rint(F.round(F.sum("px"), 2) / F.count("*")).cast("long").alias("avg_px"), F.min("px").alias("min_px"), F.max("px").alias("max_px")).filter("n >= 3")


@query("with c as (select l_suppkey, l_quantity as px, count(*) as k from lineitem group by all), t as (select l_suppkey, sum(k)::bigint as n, max(k) as top, arg_min(px, (-k, px)) as px from c group by l_suppkey) select l_suppkey, px, top, n, round(top / n, 6) as ratio, case when top / n >= 0.05 then 'BROKEN' when top / n >= 0.04 then 'watch' else 'ok' end as class from t where n >= 5".replace("arg_min(px, (-k, px))", "arg_min(px, {'a': -k, 'b': px})"))
def dominant_ratio(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").alias("px"))
    return A.dominant_ratio(rows, ["l_suppkey"], "px", 5, 0.05, 0.04).withColumn("ratio", F.round("ratio", 6)).select("l_suppkey", "px", "top", "n", "ratio", "class")


@query("with c as (select c_nationkey as n_nationkey, count(*) filter (where c_acctbal > 9900) as active, count(*) as total from customer group by 1) select n_nationkey, n_name, coalesce(active, 0) as active, coalesce(total, 0) as total, case when coalesce(total, 0) = 0 then 'empty' when coalesce(active, 0) = 0 then 'mute' else 'ok' end as state from nation left join c using (n_nationkey)")
def source_health(spark, d):
    rows = table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return A.source_health(table(spark, d, "nation").select("n_nationkey", "n_name"), rows, "n_nationkey", F.col("c_acctbal") > 9900)


@query("select n_name, count(*) as total, count(*) filter (where o_orderstatus = 'O') as active, min(date_diff('day', o_orderdate::date, date '2001-08-02'))::int as min_days from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name")
def corpus_matrix(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "O").alias("active"), F.min(F.datediff(F.lit("2001-08-02").cast("date"), F.col("o_orderdate").cast("date"))).alias("min_days"))


@query(LISTING + "select mk, left(lower(mo), 22) as mo, yr, count(distinct src) as n_sources, count(*) as n from listing group by 1, 2, 3 having count(distinct src) >= 2")
def cross_source_groups(spark, d):
    return A.cross_source(listing(spark, d).select("mk", F.left(F.lower("mo"), F.lit(22)).alias("mo"), "yr", "src"), ["mk", "mo", "yr"], "src")


@query("select p_partkey, p_brand, p_name from part where (p_brand, p_name, p_type) in (select (p_brand, p_name, p_type) from part group by p_brand, p_name, p_type having count(*) > 1)".replace("select (p_brand, p_name, p_type) from", "select p_brand, p_name, p_type from"))
def dup_keys(spark, d):
    return A.duplicated(table(spark, d, "part"), ["p_brand", "p_name", "p_type"]).select("p_partkey", "p_brand", "p_name")


@query("select 'lang' as column, round(100.0 * avg(case when coalesce(lang, '') <> '' then 1.0 else 0.0 end), 2) as pct from documents union all select 'text', round(100.0 * avg(case when coalesce(text, '') <> '' then 1.0 else 0.0 end), 2) from documents union all select 'half', round(100.0 * avg(case when n_chars > 500 then 1.0 else 0.0 end), 2) from documents")
def fill_rate(spark, d):
    docs = table(spark, d, "documents").withColumn("half", F.when(F.col("n_chars") > 500, "x"))
    return A.fill_rates(docs, ["lang", "text", "half"])


@query("with c as (select c_nationkey, nullif(c_mktsegment, 'MACHINERY') as city from customer), k as (select c_nationkey, city, count(*) as k from c where city is not null group by all), t as (select c_nationkey, arg_min(city, {'a': -k, 'b': city}) as city, max(k) as top, sum(k)::bigint as n from k group by 1), m as (select c_nationkey, count(*) filter (where city is null) as missing from c group by 1) select c_nationkey, city, n, missing from t join m using (c_nationkey) where n >= 5 and top / n >= 0.3 and missing > 0")
def dominant_city(spark, d):
    rows = table(spark, d, "customer").select("c_nationkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("city"))
    return A.dominant_value(rows, "c_nationkey", "city", 5, 0.3)


@query("with k as (select p_name, p_size, count(*) as k from part group by all), t as (select p_name, arg_min(p_size, {'a': -k, 'b': p_size}) as p_size, max(k) as top, sum(k)::bigint as n from k group by 1) select p_name, p_size, top, n from t where top >= 2 and not contains(p_name, p_size::varchar)")
def mode_guarded(spark, d):
    return A.mode_of(table(spark, d, "part"), ["p_name"], "p_size").filter((F.col("top") >= 2) & ~F.contains("p_name", F.col("p_size").cast("string")))


@query(LISTING + ", u as (select lower(mo) as key, mo, mk from listing where not exists (select 1 from part p where p.p_brand = mk and p.p_name = mo and p.p_size > 40)) select key, count(*) as n, min(mo) as label, (select arg_min(mk, {'a': -c, 'b': mk}) from (select mk, count(*) as c from u v where v.key = u.key group by mk)) as mk from u group by key having count(*) >= 3")
def observed_models(spark, d):
    ref = table(spark, d, "part").filter("p_size > 40").select(F.col("p_brand").alias("mk"), F.col("p_name").alias("mo")).distinct()
    rows = listing(spark, d).join(ref, ["mk", "mo"], "left_anti").select(F.lower("mo").alias("key"), "mo", "mk")
    found = rows.groupBy("key").agg(F.count("*").alias("n"), F.min_by("mo", F.struct(F.length("mo"), F.col("mo"))).alias("label")).filter("n >= 3")
    return found.join(A.mode_of(rows, ["key"], "mk").select("key", "mk"), "key")


@query(LISTING + ", ref as (select distinct p_brand as mk, p_name as mo from part where p_size > 30), r as (select mk, listing.mo, ref.mo as hit from listing left join ref using (mk, mo)), t as (select mk, mo, count(*) as k, row_number() over (partition by mk order by count(*) desc, mo) as rn from r where hit is null group by mk, mo) select mk, count(*) as n, count(hit) as covered, (select mo from t where t.mk = r.mk and rn = 1) as top_missing from r group by mk")
def gap_matrix(spark, d):
    ref = table(spark, d, "part").filter("p_size > 30").select(F.col("p_brand").alias("mk"), F.col("p_name").alias("mo"), F.lit(1).alias("hit")).distinct()
    rows = listing(spark, d).join(ref, ["mk", "mo"], "left")
    top = A.mode_of(rows.filter("hit is null"), ["mk"], "mo").select("mk", F.col("mo").alias("top_missing"))
    return rows.groupBy("mk").agg(F.count("*").alias("n"), F.count("hit").alias("covered")).join(top, "mk", "left")


@query("select l_suppkey, round(100.0 * avg(case when (l_quantity * 1000)::bigint % 10000 = 0 then 1.0 else 0.0 end), 2) as pct_10k, round(100.0 * avg(case when (l_quantity * 1000)::bigint % 5000 = 0 then 1.0 else 0.0 end), 2) as pct_5k from lineitem group by l_suppkey")
def round_numbers(spark, d):
    share = lambda step: F.round(100.0 * F.avg(F.when((F.col("l_quantity") * 1000).cast("long") % step == 0, 1.0).otherwise(0.0)), 2)
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(share(10_000).alias("pct_10k"), share(5_000).alias("pct_5k"))


@query("select flag, keyword, count(*) filter (where text ilike '%' || keyword || '%') as n_text, count(*) filter (where text ilike '%' || keyword || '%' and coalesce(case flag when 'toxic' then toxic else 1 - quality end, 0) = 0) as n_missed from documents left join labels using (doc_id), (values ('toxic', 'idiot'), ('toxic', 'trash'), ('poor', '!!')) as k(flag, keyword) group by flag, keyword")
def keyword_recall(spark, d):
    labels = table(spark, d, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic"), (F.col("quality") == 0).alias("poor"))
    return A.keyword_recall(table(spark, d, "documents").join(labels, "doc_id", "left"), "text", {"toxic": ["idiot", "trash"], "poor": ["!!"]})


@query("select round(s_acctbal / 1000, 0) as cell_y, s_nationkey % 5 as cell_x, count(*) as n from supplier group by 1, 2 having count(*) >= 2".replace("round(s_acctbal / 1000, 0)", "floor(s_acctbal / 1000)::bigint"))
def coord_clusters(spark, d):
    return table(spark, d, "supplier").groupBy(F.floor(F.col("s_acctbal") / 1000).cast("long").alias("cell_y"), (F.col("s_nationkey") % 5).alias("cell_x")).agg(F.count("*").alias("n")).filter("n >= 2")


_RATES = "select event_type as cur, ts::date as day, max(value) as rate from events where event_type in ('error', 'signup') and value between 20 and 35 group by all"


def _rates(spark, d):
    rows = table(spark, d, "events").filter("event_type in ('error', 'signup') and value between 20 and 35")
    return rows.groupBy(F.col("event_type").alias("cur"), F.col("ts").cast("date").alias("day")).agg(F.max("value").alias("rate"))


def _lots(spark, d):
    lots = table(spark, d, "events").filter("event_type = 'purchase'")
    return lots.select("event_id", F.when(F.col("user_id") % 2 == 0, "error").otherwise("signup").alias("cur"), F.col("ts").cast("date").alias("sold_on"), "value")


_LOTS = "select event_id, case when user_id % 2 = 0 then 'error' else 'signup' end as cur, ts::date as sold_on, value from events where event_type = 'purchase'"
_ASOF = f"with rates as ({_RATES}), lots as ({_LOTS}), f as (select lots.*, (select {{'a': day, 'b': rate}} from rates where rates.cur = lots.cur and day <= sold_on and day >= sold_on - 12 order by day desc limit 1) as x from lots) "


@query(_ASOF + "select event_id, cur, sold_on, x.a as rate_day, round(value * x.b, 4) as amount from f")
def fx_asof(spark, d):
    out = M.as_of(_lots(spark, d), _rates(spark, d), "cur", "sold_on", "day", "rate", 12)
    return out.select("event_id", "cur", "sold_on", "rate_day", F.round(F.col("value") * F.col("rate"), 4).alias("amount"))


@query(_ASOF + ", a as (select cur, value * x.b as amount, value from f) select cur, count(amount) as n, round(min(amount), 4) as min_px, round(quantile_cont(amount, 0.5), 6) as median_px, round(max(amount), 4) as max_px, round(quantile_cont(amount - value, 0.5), 6) as median_gap from a group by cur")
def hammer_comps(spark, d):
    out = M.as_of(_lots(spark, d), _rates(spark, d), "cur", "sold_on", "day", "rate", 12).select("cur", (F.col("value") * F.col("rate")).alias("amount"), "value")
    out = out.withColumn("gap", F.col("amount") - F.col("value"))
    ends = out.groupBy("cur").agg(F.count("amount").alias("n"), F.round(F.min("amount"), 4).alias("min_px"), F.round(F.max("amount"), 4).alias("max_px"))
    middle = lambda of, name: S.percentiles(out, ["cur"], of, [0.5]).select("cur", F.round("p0", 6).alias(name))
    return ends.join(middle("amount", "median_px"), "cur", "left").join(middle("gap", "median_gap"), "cur", "left")


_ANY = f"with rates as ({_RATES}), lots as ({_LOTS}), f as (select lots.*, (select {{'a': day, 'b': rate}} from rates where rates.cur = lots.cur and day <= sold_on order by day desc, rate desc limit 1) as x from lots) "


@query(_ANY + "select event_id, cur, sold_on, x.a as rate_day, round(value * x.b, 4) as amount from f")
def fx_asof_any(spark, d):
    """The last rate of any age."""
    out = S.as_of(_lots(spark, d), _rates(spark, d), "cur", "sold_on", "day", "rate")
    return out.select("event_id", "cur", "sold_on", "rate_day", F.round(F.col("value") * F.col("rate"), 4).alias("amount"))


@query("with p as (select p_partkey, p_brand, round(p_retailprice * 100)::bigint as low, round(p_retailprice * 100)::bigint + p_size * 3 as high from part), l as (select p_brand, round(l_extendedprice / l_quantity * 100)::bigint as px1 from lineitem join part on l_partkey = p_partkey) select p_partkey, count(*) as n from p join l on p.p_brand = l.p_brand and px1 between low and high group by p_partkey")
def price_windows(spark, d):
    """Lines whose price for one piece lies in the window of prices of a part of the same brand."""
    part = table(spark, d, "part")
    cents = lambda c: F.round(c * 100).cast("long")
    windows = part.select("p_partkey", "p_brand", cents(F.col("p_retailprice")).alias("low"), (cents(F.col("p_retailprice")) + F.col("p_size") * 3).alias("high"))
    lines = table(spark, d, "lineitem").select("l_partkey", cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("at"))
    points = lines.join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "at")
    # equal points meet the same windows, so they are counted first
    points = points.groupBy("p_brand", "at").agg(F.count("*").alias("k"))
    return I.stab(points, windows, ["p_brand"], "at", "low", "high").groupBy("p_partkey").agg(F.sum("k").alias("n"))


@query("with b as (select l_quantity > 40 as a0, l_quantity > 30 as a1, l_discount > 0.05 as b0, l_discount > 0.05 or l_tax > 0.04 as b1 from lineitem) select 'bulk0' as flag, count(*) filter (where a0) as before, count(*) filter (where not a0 and a1) as gain, count(*) filter (where a1) as after from b union all select 'cheap0', count(*) filter (where b0), count(*) filter (where not b0 and b1), count(*) filter (where b1) from b")
def feature_gain(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_quantity") > 40).alias("bulk0"), (F.col("l_quantity") > 30).alias("bulk1"), (F.col("l_discount") > 0.05).alias("cheap0"), ((F.col("l_discount") > 0.05) | (F.col("l_tax") > 0.04)).alias("cheap1"))
    return A.feature_gain(rows, ["bulk0", "cheap0"], ["bulk1", "cheap1"])


_RUNS = "select event_type as batch, ts::date as day, count(*) as found, round(100.0 * count(*) filter (where value > 50) / count(*), 1) as ok_pct from events group by all"


def _runs(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("batch"), F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("found"), F.round(100.0 * F.count_if(F.col("value") > 50) / F.count("*"), 1).alias("ok_pct"))


@query(f"with r as ({_RUNS}) select batch, count(*) as runs, min(ok_pct) as ok_min, max(ok_pct) as ok_max, round(avg(ok_pct), 1) as ok_avg, sum(found)::bigint as found, count(*) filter (where ok_pct < 50) as alerts from r group by batch")
def run_stats(spark, d):
    return _runs(spark, d).groupBy("batch").agg(F.count("*").alias("runs"), F.min("ok_pct").alias("ok_min"), F.max("ok_pct").alias("ok_max"), F.round(F.avg("ok_pct"), 1).alias("ok_avg"), F.sum("found").alias("found"), F.count_if(F.col("ok_pct") < 50).alias("alerts"))


@query(f"with r as ({_RUNS}), w as (select batch, ok_pct, row_number() over (partition by batch order by day) as r, count(*) over (partition by batch) as n from r), t as (select batch, max(n) as n, avg(ok_pct) filter (where r > n - n // 2) - avg(ok_pct) filter (where r <= n - n // 2) as delta from w group by batch) select batch, n, round(delta, 4) as delta, case when n < 3 then 'insufficient_data' when delta > 5 then 'improving' when delta < -5 then 'degrading' else 'stable' end as trend from t")
def trend_halves(spark, d):
    return A.trend(_runs(spark, d), ["batch"], "day", "ok_pct").withColumn("delta", F.round("delta", 4))


@query(f"with r as ({_RUNS}) select batch, day, found from (select *, row_number() over (partition by batch order by day desc) as rn from r) where rn <= 7")
def last_n(spark, d):
    return M.first_rows(_runs(spark, d), ["batch"], [F.desc("day")], 7).select("batch", "day", "found")


_REF = "select distinct p_brand as ref_mk, split_part(p_name, ' ', 1) as ref_mo from part union select distinct p_brand, p_name from part where p_size > 30"


def _ref(spark, d):
    part = table(spark, d, "part")
    return part.select(F.col("p_brand").alias("ref_mk"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("ref_mo")).union(part.filter("p_size > 30").select("p_brand", "p_name")).distinct()


@query(f"with ref as ({_REF}) select p_partkey, arg_min(ref_mo, {{'a': -length(ref_mo), 'b': ref_mo}}) as matched from part left join ref on p_brand = ref_mk and contains(' ' || p_name || ' ', ' ' || ref_mo || ' ') group by p_partkey")
def distinct_on_greedy(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_brand", "p_name")
    return M.greedy(rows, _ref(spark, d), "p_partkey", "p_brand", "p_name", "ref_mk", "ref_mo").select("p_partkey", "matched")


@query("with ref as (select distinct p_brand as ref_mk, p_name as ref_mo from part where p_size > 30) select p_partkey, arg_min(ref_mo, {'a': -length(ref_mo), 'b': ref_mo}) as matched from part left join ref on p_brand = ref_mk and split_part(p_name, ' ', 1) = split_part(ref_mo, ' ', 1) and p_name <> '' group by p_partkey")
def first_token_match(spark, d):
    part = table(spark, d, "part")
    ref = part.filter("p_size > 30").select(F.col("p_brand").alias("ref_mk"), F.col("p_name").alias("ref_mo")).distinct()
    return M.by_first_token(part.select("p_partkey", "p_brand", "p_name"), ref, "p_partkey", "p_brand", "p_name", "ref_mk", "ref_mo").select("p_partkey", "matched")


@query("""with s as (select lower(p_brand) as b, string_split(p_name, ' ') as m, count(*) as sales from part where p_size > 25 group by all),
q as (select p_partkey, lower(p_brand) as b, string_split(p_name, ' ') as m from part where p_size <= 25),
p as (select distinct q.p_partkey, s.b as seg_brand, array_to_string(s.m, ' ') as seg_model, s.sales, len(list_intersect(s.m, q.m))::int as inter, len(list_distinct(s.m))::int as n_seg, case when list_has_all(q.m, s.m) then 'SEG_IN_Q' else 'Q_IN_SEG' end as direction
  from q join s on q.b = s.b and (list_has_all(q.m, s.m) or list_has_all(s.m, q.m)))
select * from (select *, row_number() over (partition by p_partkey order by inter desc, sales desc, n_seg desc, seg_brand, seg_model)::int as rank from p) where rank <= 3""")
def token_subset_top3(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size", F.array(F.lower("p_brand")).alias("b"), F.split("p_name", " ").alias("m"))
    s = part.filter("p_size > 25").groupBy(F.col("b").alias("sb"), F.col("m").alias("sm")).agg(F.count("*").alias("sales"))
    return M.token_subset(part.filter("p_size <= 25"), s, "p_partkey", "b", "m", "sb", "sm", "sales")


@query(LISTING + ", dim as (select p_brand as b, list_distinct(string_split(p_type, ' ')) as words, 'g' || min(p_size)::varchar as code, 1995 + min(p_size) % 3 as y0, 1998 + max(p_size) % 4 as y1 from part group by all) select id, arg_min(code, {'a': -len(words), 'b': code}) as code from listing left join dim on mk = b and list_has_all(string_split(typ, ' '), words) and yr between y0 and y1 group by id".replace("group by all)", "group by p_brand, p_type)"))
def interval_generation(spark, d):
    dim = table(spark, d, "part").groupBy(F.col("p_brand").alias("b"), F.array_distinct(F.split("p_type", " ")).alias("words")).agg(F.concat(F.lit("g"), F.min("p_size")).alias("code"), (1995 + F.min("p_size") % 3).alias("y0"), (1998 + F.max("p_size") % 4).alias("y1"))
    rows = listing(spark, d).select("id", "mk", F.split("typ", " ").alias("w"), "yr")
    return M.interval(rows, dim, "id", "mk", "w", "yr", "b", "words", "code", "y0", "y1").select("id", "code").distinct()


@query("with k as (select key, min(s_suppkey) as s_suppkey from (select s_suppkey, s_name as key from supplier union all select s_suppkey, 'n' || s_nationkey::varchar from supplier) group by key) select c_custkey, s_suppkey from customer left join k on key = 'n' || c_nationkey::varchar")
def multi_key_join(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    keys = [F.col("s_name"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))]
    return M.multi_key(rows, table(spark, d, "supplier"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), keys, "s_suppkey").select("c_custkey", "s_suppkey")


@query("select s_suppkey, coalesce(n.n_name, r.n_name) as name from supplier left join nation n on s_nationkey = n.n_nationkey and s_acctbal > 0 left join nation r on s_nationkey % 5 = r.n_nationkey")
def slug_or_name_join(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    one, two = F.broadcast(n.select(F.col("n_nationkey").alias("k1"), F.col("n_name").alias("v1"))), F.broadcast(n.select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("v2")))
    return s.join(one, (F.col("s_nationkey") == F.col("k1")) & (F.col("s_acctbal") > 0), "left").join(two, F.col("s_nationkey") % 5 == F.col("k2"), "left").select("s_suppkey", F.coalesce("v1", "v2").alias("name"))


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti_orphans(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 5000)")
def semi_known(spark, d):
    known = table(spark, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(known, "o_custkey", "left_semi").select("o_orderkey")


@query("with w as (select page_id, 'p' || (page_id // 2)::varchar as slug from pages), t as (select 'p' || page_id::varchar as slug, case when page_id % 11 = 0 then 'manual_inspect' else 'ok' end as status, page_id % 3 <> 0 as active, url as listings_url from pages where page_id % 5 <> 0) select page_id, case when t.slug is null then 'absent' when status = 'manual_inspect' then 'manual_inspect' when not active then 'inactive' when regexp_matches(path, '\\.html?$') or regexp_matches(path, '(19|20)\\d\\d') or len(list_filter(string_split(path, '/'), lambda s: s <> '')) >= 2 then 'active_carpage' else 'active_root' end as category from w left join (select *, trim(regexp_extract(listings_url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') as path from t) t using (slug)")
def reconcile_categories(spark, d):
    pages = table(spark, d, "pages")
    key = lambda n: F.concat(F.lit("p"), n.cast("string"))
    wanted = pages.select("page_id", key(F.floor(F.col("page_id") / 2).cast("long")).alias("slug"))
    known = pages.filter("page_id % 5 <> 0").select(key(F.col("page_id")).alias("slug"), F.when(F.col("page_id") % 11 == 0, "manual_inspect").otherwise("ok").alias("status"), (F.col("page_id") % 3 != 0).alias("active"), F.col("url").alias("listings_url"))
    return C.reconcile(wanted, known, "slug").select("page_id", "category")


_POINTS = "select s_suppkey, s_nationkey % 3 as road, 45 + s_acctbal / 5000 as lat, 5 + (s_suppkey * 37 % 1000) / 400.0 as lng from supplier"


@query(f"with p as ({_POINTS}) select a.s_suppkey as id_a, b.s_suppkey as id_b, round(2 * 6371000 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))), 2) as metres from p a join p b on a.road = b.road and a.s_suppkey < b.s_suppkey where metres < 40000")
def haversine_self(spark, d):
    p = table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 3).alias("road"), (45 + F.col("s_acctbal") / 5000).alias("lat"), (5 + (F.col("s_suppkey") * 37 % 1000) / 400.0).alias("lng"))
    return M.near_pairs(p, "s_suppkey", ["road"], "lat", "lng", 40_000, 2)


@query("select 'status' as tag, o_orderstatus as value, count(*) as n from orders group by 2 union all select 'priority', o_orderpriority, count(*) from orders group by 2")
def union_tagged(spark, d):
    o = table(spark, d, "orders")
    part = lambda tag, c: o.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(tag).alias("tag"), "value", "n")
    return part("status", "o_orderstatus").unionByName(part("priority", "o_orderpriority"))


@query("select count(distinct (c_nationkey, c_mktsegment)) as n_pairs, count(distinct c_mktsegment) as n_segments from customer")
def distinct_tuples(spark, d):
    return table(spark, d, "customer").agg(F.countDistinct(F.struct("c_nationkey", "c_mktsegment")).alias("n_pairs"), F.countDistinct("c_mktsegment").alias("n_segments"))


@query("select p_type as value, count(*) as n from part group by 1 order by n desc, value limit 3")
def topk_count(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_type").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(3)


@query("select l_orderkey, l_linenumber from (select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) as r from lineitem) where r <= 5")
def cap_per_group(spark, d):
    return C.cap_per_group(table(spark, d, "lineitem"), "l_suppkey", ["l_orderkey", "l_linenumber"], 5).select("l_orderkey", "l_linenumber")


@query()
def sample_stratified(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return C.stratified(rows, F.when(F.col("o_totalprice") >= 100_000, "high").otherwise("low"), "o_orderkey", 50, 7)


@query()
def sample_shard(spark, d):
    return C.shard(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_name", 4, 1)


@query("select o_orderkey from orders order by (case when o_orderstatus = 'P' then null else o_orderdate end) asc nulls first, o_orderkey limit 100")
def scan_cursor(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("at"))
    return C.cursor(rows, "at", "o_orderkey", 100).select("o_orderkey")


@query("select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '2001-06-01' order by o_orderdate < timestamp '2001-06-03' desc, o_orderdate, o_orderkey limit 40")
def topk_priority(spark, d):
    rows = table(spark, d, "orders").filter("o_orderdate >= timestamp_ntz '2001-06-01'")
    return C.soonest(rows, "o_orderdate", F.expr("timestamp_ntz '2001-06-01'"), 48, "o_orderkey", 40).select("o_orderkey", "o_orderdate")


@query(LISTING + "select id, mk, mo, px from listing where (mk ilike '%#1%' or mo ilike 'b%') and not mo ilike '%red%' and flag in ('A', 'R') and px is not null and mk is distinct from 'Brand#12' and regexp_matches(' ' || mo || ' ', '[aeiou] ')")
def filters(spark, d):
    rows = listing(spark, d)
    keep = (F.col("mk").ilike("%#1%") | F.col("mo").ilike("b%")) & ~F.col("mo").ilike("%red%") & F.col("flag").isin("A", "R") & F.col("px").isNotNull() & ~F.col("mk").eqNullSafe("Brand#12")
    return rows.filter(keep & F.expr("concat(' ', mo, ' ') rlike concat('[aeiou]', ' ')")).select("id", "mk", "mo", "px")


# ---- numbers of listings ----


@query(LISTING + "select id, (round_even(km / 5000, 0) * 5000)::bigint as km_bucket, (round_even(px / 500, 0) * 500)::bigint as px_bucket, (floor(yr / 10.0) * 10)::int as decade from listing")
def buckets_half_even(spark, d):
    return listing(spark, d).select("id", N.bucket(F.col("km"), 5000).alias("km_bucket"), N.bucket(F.col("px"), 500).alias("px_bucket"), N.decade(F.col("yr")).alias("decade"))


_TIER = "case when 2024 - (yr - 5 * (id % 2)) >= 25 then 'collector' when px * 60 >= 2000000 then 'hypercar' when px * 60 >= 500000 then 'supercar' when px * 60 >= 100000 then 'luxury' else 'standard' end"


@query(LISTING + f", t as (select id, km, {_TIER} as tier from listing) select id, tier, case when tier in ('supercar', 'hypercar', 'collector') and km * 5 < 300 then 'zero_km' when tier in ('supercar', 'hypercar', 'collector') and km * 5 < 5000 then 'as_new' when km * 5 < 15000 then 'low_km' when km * 5 < 50000 then 'moderate' when km * 5 < 100000 then 'well_used' when km * 5 < 200000 then 'high_km' else 'very_high_km' end as km_tier from t")
def tiers(spark, d):
    rows = listing(spark, d).select("id", (F.col("km") * 5).alias("km"), N.listing_tier(F.col("yr") - 5 * (F.col("id") % 2), F.col("px") * 60, 2024).alias("tier"))
    return rows.select("id", "tier", N.km_tier(F.col("km"), F.col("tier")).alias("km_tier"))


@query(LISTING + ", v as (select id, mk, mo, case when sz = 7 then null else px - 1000 end as p, yr + sz % 8 as y, km - 3000 as k from listing) select id, case when p is null then 'price_invalid' when p < 500 then 'price_low' when y > 2003 then 'year_future' when p >= 100000 then 'price_luxury' when k < 0 then 'km_negative' when 2002 - y < 3 and p < 3000 then 'recent_cheap' end as reason from v")
def validate_reason(spark, d):
    rows = listing(spark, d).select("id", "mk", "mo", F.when(F.col("sz") != 7, F.col("px") - 1000).alias("p"), (F.col("yr") + F.col("sz") % 8).alias("y"), (F.col("km") - 3000).alias("k"))
    return rows.select("id", N.validate_reason(F.lit(None).cast("string"), F.col("mk"), F.col("mo"), F.col("p"), F.col("y"), F.col("k"), F.lit(""), None, 2002).alias("reason"))


@query(LISTING + """, m as (select mk, avg(px) as market from listing group by mk), s as (select id, 2010 - yr as age, px / market as ratio, km * 3 as km, (src % 5)::int as ow, sz % 9 as opts from listing join m using (mk)),
p as (select id, case when ratio < 0.85 then 25 when ratio < 0.95 then 22 when ratio < 1.05 then 18 when ratio < 1.15 then 12 else 6 end as s_px, greatest(10, 30 - floor(km / greatest(age, 1) / 3000)::int) as s_me, case ow when 1 then 20 when 2 then 15 when 3 then 8 else 4 end as s_hi, least(15, 8 + opts) as s_an, greatest(1, 10 - floor(km / 20000)::int) as s_km from s)
select id, s_px, s_me, s_hi, s_an, s_km, least(100, s_px + s_me + s_hi + s_an + s_km) as score, case when s_px + s_me + s_hi + s_an + s_km >= 85 then 'excellent' when s_px + s_me + s_hi + s_an + s_km >= 70 then 'good' when s_px + s_me + s_hi + s_an + s_km >= 55 then 'check' else 'risk' end as verdict from p""")
def score_additive(spark, d):
    rows = listing(spark, d)
    rows = rows.join(rows.groupBy("mk").agg(F.avg("px").alias("market")), "mk")
    parts = N.score_parts(F.col("px"), F.col("market"), F.col("yr"), F.col("km") * 3, F.col("src") % 5, F.col("sz") % 9, F.lit(None).cast("int"), 2010)
    del parts["s_rare"]
    return rows.select("id", *[c.alias(k) for k, c in parts.items()])


@query("select event_id, coalesce(case when old <= 0 then value > 0 else abs(value - old) / old >= 0.02 end, old is distinct from value) as moved from (select event_id, value, lag(value) over (partition by user_id order by ts, event_id) as old from events)")
def price_moved(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "events").withColumn("old", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return rows.select("event_id", N.price_moved(F.col("old"), F.col("value")).alias("moved"))


_BIDS = "select l_orderkey * 10 + l_linenumber as id, case when l_returnflag = 'R' then l_extendedprice::bigint end as sold, case when l_linenumber % 3 > 0 then l_quantity::bigint * 100 end as bid, case when l_tax > 0.03 then 2000::bigint end as lo, case when l_discount > 0.02 then 4001::bigint end as hi from lineitem"


@query(f"with b as ({_BIDS}) select id, case when coalesce(sold, 0) > 0 then sold when coalesce(bid, 0) > 0 and (lo is null or bid >= lo) then bid when lo is not null and hi is not null then (lo + hi) // 2 when lo is not null then lo when coalesce(bid, 0) > 0 then bid end as px from b".replace("l_extendedprice::bigint", "floor(l_extendedprice)::bigint"))
def px_proxy(spark, d):
    rows = table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.when(F.col("l_returnflag") == "R", F.floor("l_extendedprice").cast("long")).alias("sold"), F.when(F.col("l_linenumber") % 3 > 0, F.col("l_quantity").cast("long") * 100).alias("bid"),
        F.when(F.col("l_tax") > 0.03, F.lit(2000).cast("long")).alias("lo"), F.when(F.col("l_discount") > 0.02, F.lit(4001).cast("long")).alias("hi"),
    )
    return rows.select("id", N.price_proxy(F.col("bid"), F.col("lo"), F.col("hi"), F.col("sold")).alias("px"))


@query("select event_id, coalesce(round_even((epoch_us(ts) - epoch_us(timestamp '2024-01-15 12:00:00')) / 3.6e9, 2), 0) as h from events")
def h_offset(spark, d):
    return table(spark, d, "events").select("event_id", N.hours_to(F.col("ts"), F.lit("live"), F.expr("timestamp_ntz '2024-01-15 12:00:00'")).alias("h"))


@query("with e as (select event_id, ts, event_type as status, case user_id % 3 when 0 then true when 1 then false end as reserve from events) select event_id, case when ts <= timestamp '2024-01-15 12:00:00' then 'sold' when (epoch_us(ts) - epoch_us(timestamp '2024-01-15 12:00:00')) / 3.6e9 > 72 then 'upcoming' else 'live' end as new_status, case when ts <= timestamp '2024-01-15 12:00:00' then not reserve end as withdrawn from e")
def auction_machine(spark, d):
    rows = table(spark, d, "events").withColumn("reserve", F.when(F.col("user_id") % 3 == 0, True).when(F.col("user_id") % 3 == 1, False))
    state = N.auction_state(F.col("ts"), F.lit(None).cast("timestamp_ntz"), F.col("event_type"), F.col("reserve"), F.expr("timestamp_ntz '2024-01-15 12:00:00'"))
    return rows.select("event_id", *[c.alias(k) for k, c in state.items()])


@query(LISTING + "select id, left(md5(regexp_replace(lower(mk), '[^a-z0-9]', '', 'g') || regexp_replace(lower(left(mo, 12)), '[^a-z0-9]', '', 'g') || yr::varchar || (round_even(km / 5000, 0) * 5000)::bigint::varchar), 12) as fp from listing")
def fingerprint(spark, d):
    return listing(spark, d).select("id", T.fingerprint(F.col("mk"), F.col("mo"), F.col("yr"), F.col("km")).alias("fp"))


# ---- listings over time ----


@query("with e as (select user_id, event_id, ts, value, lag(value) over (partition by user_id order by ts, value) as old, row_number() over (partition by user_id order by ts, value) as r from events where event_type = 'view') select event_id, user_id, ts, value from e where r = 1 or value is distinct from old")
def price_log(spark, d):
    return C.price_log(table(spark, d, "events").filter("event_type = 'view'"), "user_id", "ts", "value").select("event_id", "user_id", "ts", "value")


@query("with l as (select user_id, max({'a': ts, 'b': event_id}) filter (where event_type <> 'error') as ok from events group by user_id), c as (select user_id, count(*) filter (where event_type = 'error' and (ok is null or {'a': ts, 'b': event_id} > ok)) as failures from events join l using (user_id) group by user_id) select user_id, failures, failures >= 3 as open from c")
def circuit_breaker(spark, d):
    return C.failures(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as times_seen, date_diff('day', min(ts)::date, max(ts)::date)::int as days from events group by user_id")
def lifespan(spark, d):
    return C.lifespan(table(spark, d, "events"), "user_id", "ts").withColumn("days", F.datediff(F.col("last_seen").cast("date"), F.col("first_seen").cast("date")))


@query("select o_orderkey, case when o_orderstatus = 'O' and o_orderdate < timestamp '2001-08-01' - interval 14 day then 'expired' when o_orderstatus = 'O' then 'active' else 'other' end as status from orders")
def stale_sweep(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") == "O", "active").otherwise("other").alias("status"))
    return C.stale(rows, "status", "o_orderdate", F.expr("timestamp_ntz '2001-08-01'"), 14).select("o_orderkey", "status")


@query("select case when o_orderstatus = 'F' and o_orderdate < timestamp '2001-01-01' then 'archive' else 'keep' end as part, count(*) as n from orders group by 1")
def archive_split(spark, d):
    gone, kept = C.move(table(spark, d, "orders"), (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.expr("timestamp_ntz '2001-01-01'")))
    return gone.select(F.lit("archive").alias("part")).union(kept.select(F.lit("keep"))).groupBy("part").agg(F.count("*").alias("n"))


_OLD, _NEW = "select c_custkey as k, c_acctbal as v, 0::bigint as stamp from customer where c_custkey % 3 <> 0", "select o_custkey as k, o_totalprice as v, o_orderkey as stamp from orders"


def _old_new(spark, d):
    old = table(spark, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.lit(0).cast("long").alias("stamp"))
    return old, table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("stamp"))


@query(f"with o as ({_OLD}), n as (select k, v, stamp from (select *, row_number() over (partition by k order by stamp desc) as r from ({_NEW})) where r = 1) select * from n union all select * from o where k not in (select k from n)")
def upsert_merge(spark, d):
    old, new = _old_new(spark, d)
    return C.upsert(old, new, ["k"], "stamp")


@query(f"with o as ({_OLD}), n as (select k, max(v) as v, max(stamp) as stamp from ({_NEW}) group by k) select o.k, o.v, o.stamp from o union all select k, v, stamp from n where k not in (select k from o)")
def upsert_ignore(spark, d):
    old, new = _old_new(spark, d)
    return C.insert_new(old, new.groupBy("k").agg(F.max("v").alias("v"), F.max("stamp").alias("stamp")), ["k"])


@query(f"with o as ({_OLD}), n as (select k, max(v) as v from ({_NEW}) group by k) select k, coalesce(n.v, o.v) as v, stamp from o left join n using (k)")
def update_from(spark, d):
    old, new = _old_new(spark, d)
    return C.update_from(old, new.groupBy("k").agg(F.max("v").alias("v")), ["k"], ["v"])
