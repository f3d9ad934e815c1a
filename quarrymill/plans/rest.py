"""Further joins, figures and expressions, each as a query of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import adverts as V
from quarrymill.functions import numbers as N
from quarrymill.functions import text as T
from quarrymill.operators import aggregates as A
from quarrymill.operators import lifecycle as C
from quarrymill.operators import matching as M
from quarrymill.plans.listings import table
from quarrymill.sources import files
from quarrymill.streaming import jobs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("select p_partkey, coalesce(a.k, b.k) as canon from part left join (select lower(p_name) as x, min(p_partkey) as k from part where p_size > 40 group by 1) a on lower(p_name) = a.x left join (select lower(p_type) as x, min(p_partkey) as k from part where p_size < 5 group by 1) b on lower(p_type) = b.x")
def join_canon_exact(spark, d):
    part = table(spark, d, "part")
    one = lambda c, keep, name: part.filter(keep).groupBy(F.lower(c).alias(name)).agg(F.min("p_partkey").alias(f"{name}k"))
    rows = part.join(one("p_name", "p_size > 40", "a"), F.lower("p_name") == F.col("a"), "left").join(one("p_type", "p_size < 5", "b"), F.lower("p_type") == F.col("b"), "left")
    return rows.select("p_partkey", F.coalesce("ak", "bk").alias("canon"))


@query("with ref as (select p_brand, split_part(p_name, ' ', 1) as m from part group by all having count(*) >= 2) select p_partkey, arg_min(m, {'a': -length(m), 'b': m}) as matched from part left join ref on part.p_brand = ref.p_brand and contains(' ' || p_name || ' ', ' ' || m || ' ') group by p_partkey")
def join_selfbootstrap(spark, d):
    part = table(spark, d, "part")
    ref = part.groupBy(F.col("p_brand").alias("b"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("m")).agg(F.count("*").alias("n")).filter("n >= 2")
    return M.greedy(part, ref, "p_partkey", "p_brand", "p_name", "b", "m").select("p_partkey", "matched")


@query("select o_orderkey, c_mktsegment as label, n_name as place from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey")
def join_lookup_cached(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", F.col("c_mktsegment").alias("label"), F.col("n_name").alias("place"))


@query("select c_custkey, case when o.o_custkey is not null then 'known' when c_acctbal < 0 then 'blocked' else 'new' end as reason from customer left join (select distinct o_custkey from orders where o_totalprice > 100000) o on c_custkey = o_custkey")
def join_anti_existing(spark, d):
    known = table(spark, d, "orders").filter("o_totalprice > 100000").select("o_custkey").distinct()
    rows = table(spark, d, "customer").join(known, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.when(F.col("o_custkey").isNotNull(), "known").when(F.col("c_acctbal") < 0, "blocked").otherwise("new").alias("reason"))


@query("select node, arg_min(vec_id, {'a': pos, 'b': vec_id}) as way from (select vec_id, unnest(range(3)) as pos, (vec_id + unnest(range(3))) % 100 as node from embeddings) group by node")
def join_nested_id(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: (F.col("vec_id") + i) % 100)).alias("pos", "node"))
    return rows.groupBy("node").agg(F.min_by("vec_id", F.struct("pos", "vec_id")).alias("way"))


@query("select s_suppkey, coalesce(case when s_acctbal > 5000 then s_nationkey end, r_regionkey) as ref from supplier left join region on s_suppkey % 10 = r_regionkey")
def join_priority_2src(spark, d):
    rows = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "region")), F.col("s_suppkey") % 10 == F.col("r_regionkey"), "left")
    return rows.select("s_suppkey", F.coalesce(F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey")), "r_regionkey").alias("ref"))


@query("select o_orderpriority as reason, count(*) as n from orders where o_orderstatus <> 'O' group by 1")
def exit_reason(spark, d):
    return table(spark, d, "orders").filter("o_orderstatus <> 'O'").groupBy(F.col("o_orderpriority").alias("reason")).agg(F.count("*").alias("n"))


@query("select l_suppkey, count(*) as n, quantile_cont(l_extendedprice, 0.5) as median_px from lineitem group by 1 having count(*) >= 3 and quantile_cont(l_extendedprice, 0.5) >= 38000")
def premium_sources(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.percentile("l_extendedprice", 0.5).alias("median_px")).filter("n >= 3 and median_px >= 38000")


@query("select count(*) filter (where o_orderstatus = 'O' and o_orderdate < timestamp '2001-07-02') as stale, count(*) as n, count(*) filter (where o_totalprice is null) as unpriced from orders")
def stale_count(spark, d):
    return table(spark, d, "orders").agg(F.count_if((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.expr("timestamp_ntz '2001-07-02'"))).alias("stale"), F.count("*").alias("n"), F.count_if(F.col("o_totalprice").isNull()).alias("unpriced"))


@query("select s_nationkey, count(*) filter (where k = 'city') as city, count(*) filter (where k = 'junk') as junk, count(*) filter (where k = 'empty') as empty from (select s_nationkey, case when s_acctbal < 0 then 'empty' when s_suppkey % 3 = 0 then 'junk' else 'city' end as k from supplier) group by 1")
def city_quality(spark, d):
    said = F.when(F.col("s_acctbal") < 0, "").when(F.col("s_suppkey") % 3 == 0, "n/a").otherwise(F.col("s_name"))
    kind = F.when(said == "", "empty").when(T.is_city(said), "city").otherwise("junk")
    return table(spark, d, "supplier").withColumn("kind", kind).groupBy("s_nationkey").pivot("kind", ["city", "junk", "empty"]).agg(F.count(F.lit(1))).fillna(0)


@query("select p_partkey, p_brand, p_size from part where list_has_any(string_split(p_type, ' '), ['ECONOMY', 'SMALL', 'economy', 'small']) is distinct from true")
def array_overlap(spark, d):
    bad = F.array(*[F.lit(x) for x in ("ECONOMY", "SMALL", "economy", "small")])
    words = F.split("p_type", " ")
    return table(spark, d, "part").filter(words.isNull() | ~F.arrays_overlap(words, bad)).select("p_partkey", "p_brand", "p_size")


@query("select k, count(*) as n from (select c_custkey as k from customer where c_acctbal > 0 union select o_custkey from orders where o_totalprice > 200000 except select o_custkey from orders where o_orderstatus = 'P') group by k")
def set_operations(spark, d):
    o = table(spark, d, "orders")
    keys = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")).union(o.filter("o_totalprice > 200000").select("o_custkey")).distinct()
    return keys.join(o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), "k", "left_anti").groupBy("k").agg(F.count("*").alias("n"))


@query("select c_custkey, exists(select 1 from orders where o_custkey = c_custkey) as there from customer")
def existence(spark, d):
    known = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit(True).alias("hit")).distinct()
    return table(spark, d, "customer").join(known, F.col("c_custkey") == F.col("k"), "left").select("c_custkey", F.coalesce("hit", F.lit(False)).alias("there"))


@query("select p_partkey, translate(p_name || ' éàüßñ', 'éàüñ', 'eaun') as plain, string_split(lower(p_name) || ' ' || p_size::varchar || ' d', ' ') as words from part".replace("string_split(lower(p_name) || ' ' || p_size::varchar || ' d', ' ') as words", "lower(p_name) || '|' || p_size::varchar || '|d' as words"))
def deaccent_and_tokens(spark, d):
    words = T.clean_tokens(F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"), F.lit("d manual 155 g/km")))
    n = F.size(words)
    joined = F.concat_ws("|", F.array_join(F.slice(words, F.lit(1), n - 2), " "), F.element_at(words, -2), F.element_at(words, -1))
    return table(spark, d, "part").select("p_partkey", T.deaccent(F.concat("p_name", F.lit(" éàüßñ"))).alias("plain"), joined.alias("words"))


@query("select page_id, page_id % 3 = 0 as away from pages")
def redirected_away(spark, d):
    number = (F.col("page_id") + 100_000).cast("string")
    asked = F.concat(F.lit("https://x.com/car/"), number, F.lit("/red"))
    final = F.when(F.col("page_id") % 3 == 0, "https://x.com/cars").when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://m.x.com/"), number)).otherwise(F.concat(asked, F.lit("/")))
    return table(spark, d, "pages").select("page_id", T.redirected_away(asked, final).alias("away"))


@query("select p_partkey, case p_size % 4 when 0 then p_size * 1000 when 1 then 10000 + p_size when 2 then 1000000 + p_size else 0 end::bigint as px from part where p_size between 10 and 50")
def extract_price(spark, d):
    n = F.col("p_size")
    s = n.cast("string")
    text = F.when(n % 4 == 0, F.concat(F.lit("now "), s, F.lit(".000 €"))).when(n % 4 == 1, F.concat(F.lit("CHF 10'0"), s)).when(n % 4 == 2, F.concat(F.lit("1,000,0"), s, F.lit(" EUR"))).otherwise(F.concat(s, F.lit(" EUR")))
    return table(spark, d, "part").filter("p_size between 10 and 50").select("p_partkey", V.extract_price(text).alias("px"))


@query("with t as (select page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<article>(.*?)</article>', 1), '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) as t from pages) select page_id, case when length(t) >= 50 then left(t, 8000) end as text from t")
def description(spark, d):
    return table(spark, d, "pages").select("page_id", V.description(F.col("html"), "(?is)<article>(.*?)</article>").alias("text"))


@query("select n_nationkey, n_nationkey % 2 = 0 as there from nation")
def city_in_text(spark, d):
    n = F.col("n_nationkey")
    said = F.when(n % 2 == 0, F.concat(F.lit("12 00199 - "), F.upper("n_name"), F.lit(", EU"))).otherwise(F.concat(F.lit("x"), "n_name", F.lit("y")))
    return table(spark, d, "nation").select("n_nationkey", V.city_in_text(F.col("n_name"), said).alias("there"))


@query("select p_partkey, p_name as mo from part")
def clean_model(spark, d):
    k = F.col("p_partkey") % 4
    said = F.when(k == 0, F.concat("p_name", F.lit(" - Autohaus Muster"))).when(k == 1, F.concat("p_name", F.lit(" | Best cars"))).when(k == 2, F.concat("p_name", F.lit(" - 2015 - low km"))).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", V.clean_model(said, F.array(F.lit("muster"), F.lit("ab"))).alias("mo"))


@query("select p_partkey, p_partkey % 3 <> 0 as shown from part")
def negated_occurrences(spark, d):
    k = F.col("p_partkey") % 3
    said = F.when(k == 0, "sans papers, no papers").when(k == 1, F.concat(F.lit("sans papers. "), F.lpad("p_name", 40, "x"), F.lit(" papers"))).otherwise("papers")
    return table(spark, d, "part").select("p_partkey", V.occurs_unnegated(said, "papers").alias("shown"))


@query("select event_id, ts::date as day, (2024 - year(ts)) * 12 + 3 - month(ts) as months, case when epoch_us(timestamp '2024-01-30 12:00:00') - epoch_us(ts) < 6 * 3600000000 then greatest(floor((epoch_us(timestamp '2024-01-30 12:00:00') - epoch_us(ts)) / 3.6e9)::bigint, 1)::varchar || 'h' when floor((epoch_us(timestamp '2024-01-30 12:00:00') - epoch_us(ts)) / 3.6e9 / 24) = 0 then 'today' else floor((epoch_us(timestamp '2024-01-30 12:00:00') - epoch_us(ts)) / 3.6e9 / 24)::bigint::varchar || 'd' end as age from events where ts < timestamp '2024-01-30 12:00:00'")
def dates_and_ages(spark, d):
    now = F.expr("timestamp_ntz '2024-01-30 12:00:00'")
    rows = table(spark, d, "events").filter(F.col("ts") < now)
    day = N.parse_date_fr(F.date_format("ts", "dd-MM-yyyy"))
    return rows.select("event_id", day.alias("day"), V.months_between_dates(day, F.lit("2024-03-01").cast("date")).alias("months"), V.age_label(F.col("ts"), now).alias("age"))


@query("select event_id, case when event_type <> 'view' then round_even(user_id * 10 / 100 * 0.5, 0)::bigint end as eur, round(user_id / 1000000 * 3.0 * 0.9 + 50 / 1000000 * 15.0 * 0.9, 9) as cost from events")
def money(spark, d):
    rate = F.when(F.col("event_type") != "view", 0.5)
    cost = V.call_cost({"in": F.col("user_id"), "out": F.lit(50), "cache": F.lit(None).cast("int")}, {"in": 3.0, "out": 15.0, "cache": 0.3}, 0.9)
    return table(spark, d, "events").select("event_id", V.converted(F.col("user_id") * 10, rate).alias("eur"), F.round(cost, 9).alias("cost"))


@query("select event_type, count(*) as runs, count(*) filter (where value > 95) as failed, case when count(*) filter (where value > 95) * 2 > count(*) then 'red' when count(*) filter (where value > 90) > 0 then 'green' else 'yellow' end as state from events group by event_type")
def run_recorder(spark, d):
    over = lambda x: F.count_if(F.col("value") > x)
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("runs"), over(95).alias("failed"), V.run_state(over(95) * 2 > F.count("*"), F.count("*"), F.count("*"), over(90)).alias("state"))


@query("select o_orderkey, case when o_orderstatus = 'F' and o_custkey % 4 = 0 then 'active' else o_orderstatus end as status, timestamp '2001-08-02' as updated_at from orders")
def reactivate(spark, d):
    alive = table(spark, d, "customer").filter("c_custkey % 4 = 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("alive"))
    rows = table(spark, d, "orders").join(alive, "o_custkey", "left")
    fine = (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 4 == 0)
    return rows.select("o_orderkey", F.when(fine, "active").otherwise(F.col("o_orderstatus")).alias("status"), F.expr("timestamp_ntz '2001-08-02'").alias("updated_at"))


@query("select r_regionkey, r_name, '{\"name\":\"' || r_name || '\",\"keys\":[' || r_regionkey::varchar || ',1]}' as j from region")
def json_build(spark, d):
    j = F.to_json(F.struct(F.col("r_name").alias("name"), F.array(F.col("r_regionkey"), F.lit(1)).alias("keys")))
    return table(spark, d, "region").select("r_regionkey", "r_name", j.alias("j"))


@query("select vec_id, len(embedding)::int as n, round(embedding[1], 5) as first, len(list_filter(embedding, lambda x: x > 0))::int as positive from embeddings")
def array_scalars(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", F.size(e).alias("n"), F.round(F.try_element_at(e, F.lit(1)), 5).alias("first"), F.size(F.filter(e, lambda x: x > 0)).alias("positive"))


@query("select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) as label from customer")
def null_helpers_and_sorts(spark, d):
    label = F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name")
    return table(spark, d, "customer").select("c_custkey", label.alias("label"), "c_acctbal").orderBy(F.desc_nulls_last("label"), F.desc("c_acctbal"), "c_custkey").select("c_custkey", "label")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'")
def sink_ctas_backup(spark, d):
    path = jobs.shared_folder(spark, "backup")
    kept = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    files.replace_table(kept, path)
    return spark.read.schema(kept.schema).parquet(path)


@query("select user_id, count(*) as n from events where event_type = 'view' group by user_id")
def sink_incremental(spark, d):
    folder, schema = jobs.shared_folder(spark, "incremental"), table(spark, d, "events").schema
    stream = jobs.read(spark, f"{d}/events.parquet", schema).filter("event_type = 'view'").select("event_id", "user_id")
    jobs.finish(stream, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema("event_id long, user_id long").parquet(f"{folder}/out").groupBy("user_id").agg(F.count("*").alias("n"))


@query("select event_type, time_bucket(interval 1 day, ts) as start, count(*) as n from events group by all")
def windowed_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type", F.window(F.col("ts"), "1 day").alias("w")).agg(F.count("*").alias("n")).select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


@query("select p_brand, p_type, count(*) as n from part where p_size > 10 group by p_brand, p_type order by n desc, p_brand, p_type limit 15")
def count_by(spark, d):
    return table(spark, d, "part").filter("p_size > 10").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand", "p_type").limit(15)


@query("with m as (select p_partkey, p_brand, p_size from part where p_size in (10, 20, 30)) select p_brand, count(*) as n, max(p_size) as largest, mode_size from m join (select p_brand, arg_min(p_size, {'a': -c, 'b': p_size}) as mode_size from (select p_brand, p_size, count(*) as c from m group by all) group by p_brand) using (p_brand) group by p_brand, mode_size")
def mode_size(spark, d):
    m = table(spark, d, "part").filter(F.col("p_size").isin(10, 20, 30))
    return m.groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_size").alias("largest")).join(A.mode_of(m, ["p_brand"], "p_size").select("p_brand", F.col("p_size").alias("mode_size")), "p_brand")


@query("select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as times_seen from events where event_type = 'view' group by user_id having count(*) > 3")
def seen_often(spark, d):
    return C.lifespan(table(spark, d, "events").filter("event_type = 'view'"), "user_id", "ts").filter("times_seen > 3")


@query("select c_custkey, case c_custkey % 3 when 0 then 'Aix-en-Provence' when 1 then 'Saint-Denis' else 'L''Haÿ les Roses' end as city from customer")
def clean_city(spark, d):
    k = F.col("c_custkey") % 3
    said = F.when(k == 0, " 13100  AIX-EN-PROVENCE").when(k == 1, "saint-denis").otherwise("L'HAŸ LES ROSES")
    return table(spark, d, "customer").select("c_custkey", V.clean_city(said).alias("city"))


@query("select p_partkey, case p_partkey % 4 when 0 then p_size::varchar when 1 then 'i0ab' when 2 then 'm_1.jpg' else 'x.jpg' end as key from part")
def photo_keys(spark, d):
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    by = {0: ("car_number", F.concat(F.lit("https://a/uploads/cars/77/"), n, F.lit("/b.jpg?w=1"))), 1: ("hash", F.lit("https://a/image/i0ab/v/1.jpg")), 2: ("media", F.lit("https://a/media/m_1.jpg/v1/fit")), 3: ("name", F.lit("https://a/800x600/x.jpg?y"))}
    out = None
    for at, (mode, url) in by.items():
        out = (F if out is None else out).when(k == at, V.photo_key(url, mode))
    return table(spark, d, "part").select("p_partkey", out.alias("key"))
