"""Queries that read and write files, page parts, features, and the batch forms of lifecycle jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import features as X
from quarrymill.functions import numbers as N
from quarrymill.functions import text as T
from quarrymill.operators import aggregates as A
from quarrymill.operators import lifecycle as C
from quarrymill.operators import matching as M
from quarrymill.operators import scans as S
from quarrymill.plans.listings import LISTING, listing, table
from quarrymill.sources import files
from quarrymill.streaming.jobs import shared_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


NATIONS = "select n_nationkey, n_name, n_regionkey from nation"
NATION = "n_nationkey int, n_name string, n_regionkey int"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark, name)}/{name}"


def _lines(df: DataFrame, path: str, line) -> str:
    df.select(line.alias("value")).coalesce(1).write.text(path)
    return path


def _document(df: DataFrame, path: str, root: str, line) -> str:
    """One XML document of a small table."""
    one = df.agg(F.concat(F.lit(f"<{root}>\n"), F.array_join(F.collect_list(line), "\n"), F.lit(f"\n</{root}>")).alias("value"))
    return _lines(one, path, F.col("value"))


@query("select count(*) as n, count(distinct l_orderkey) as n_orders, max(l_shipdate) as last from lineitem")
def scan_table(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("n_orders"), F.max("l_shipdate").alias("last"))


@query("select (row_number() over (order by o_orderkey) - 1) // 1000 as page, o_orderkey from orders where o_orderkey > 500")
def scan_keyset(spark, d):
    return files.keyset_pages(table(spark, d, "orders").filter("o_orderkey > 500").select("o_orderkey"), "o_orderkey", 1000)


@query(NATIONS)
def scan_csv(spark, d):
    path = _folder(spark, "csv")
    table(spark, d, "nation").write.option("header", True).csv(path)
    return files.csv(spark, path, NATION)


@query("select n_nationkey, nullif(n_name, 'FRANCE') as n_name, n_regionkey from nation")
def scan_tsv(spark, d):
    path = _folder(spark, "tsv")
    table(spark, d, "nation").withColumn("n_name", F.nullif("n_name", F.lit("FRANCE"))).write.option("sep", "\t").option("nullValue", "").csv(path)
    return files.tsv(spark, path, NATION)


@query(NATIONS)
def scan_jsonl(spark, d):
    path = _folder(spark, "jsonl")
    table(spark, d, "nation").write.json(path)
    return files.json_lines(spark, path, NATION)


@query("select n_nationkey as k from nation")
def scan_json(spark, d):
    rows = table(spark, d, "nation").agg(F.to_json(F.struct(F.sort_array(F.collect_list("n_nationkey")).alias("found"))).alias("value"))
    path = _lines(rows, _folder(spark, "json"), F.col("value"))
    return files.json_array(spark, path, "found array<int>").select(F.explode("found").alias("k"))


@query("select 'http://x/' || n_name as url from nation where n_nationkey > 2")
def scan_textlines(spark, d):
    line = F.when(F.col("n_nationkey") > 2, F.concat(F.lit(" http://x/"), "n_name", F.lit("/ "))).otherwise(F.lit("# none"))
    return files.text_lines(spark, _lines(table(spark, d, "nation"), _folder(spark, "lines"), line))


@query("select r_name as batch, r_regionkey as found from region")
def scan_reports(spark, d):
    path = _folder(spark, "reports")
    one = F.to_json(F.struct(F.col("r_name").alias("batch"), F.col("r_regionkey").alias("found")))
    table(spark, d, "region").select(one.alias("value")).repartition(5, "r_regionkey").write.option("maxRecordsPerFile", 1).text(path)
    return files.reports(spark, path, "batch string, found int").select("batch", "found")


@query("select 'http://x/' || n_nationkey::varchar as loc from nation")
def scan_sitemap(spark, d):
    line = F.concat(F.lit("<url><loc>http://x/"), F.col("n_nationkey").cast("string"), F.lit("</loc></url>"))
    return files.xml_rows(spark, _document(table(spark, d, "nation"), _folder(spark, "sitemap"), "urlset", line), "url", "loc string")


@query("select n_name as title, 'http://x/' || n_nationkey::varchar as link from nation")
def scan_rss(spark, d):
    line = F.concat(F.lit("<item><title>"), "n_name", F.lit("</title><link>http://x/"), F.col("n_nationkey").cast("string"), F.lit("</link></item>"))
    return files.xml_rows(spark, _document(table(spark, d, "nation"), _folder(spark, "rss"), "channel", line), "item", "title string, link string")


@query("select page_id, url as name, case when page_id % 2 = 0 then 'Car' else 'Product' end as kind from pages")
def scan_jsonld(spark, d):
    kind = F.when(F.col("page_id") % 2 == 0, "Car").otherwise("Product")
    block = F.concat(F.lit('<script type="application/ld+json">{"@type": "'), kind, F.lit('", "name": "'), "url", F.lit('"}</script>'))
    first = F.from_json(files.vehicle_block(F.concat(F.lit('<script type="application/ld+json">{"@type": "Product", "name": "other"}</script>'), block, "html")), "`@type` string, name string")
    other = F.from_json(files.vehicle_block(F.concat(block, "html")), "`@type` string, name string")
    return table(spark, d, "pages").select("page_id", F.when(kind == "Car", first).otherwise(other).alias("x")).select("page_id", "x.name", F.col("x.`@type`").alias("kind"))


@query("select page_id, i::int as i, page_id + i as price from pages, range(3) as t(i)")
def scan_next_data(spark, d):
    cars = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(i.alias("i"), (F.col("page_id") + i).alias("price")))
    data = F.to_json(F.struct(F.struct(F.struct(cars.alias("listings")).alias("pageProps")).alias("props")))
    page = F.concat("html", F.lit('<script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script>"))
    found = F.from_json(files.next_data(page), "props struct<pageProps: struct<listings: array<struct<i: int, price: bigint>>>>")
    return table(spark, d, "pages").select("page_id", F.inline(F.slice(found["props"]["pageProps"]["listings"], 1, 25)))


@query("select page_id, url as component from pages")
def scan_inertia(spark, d):
    data = F.replace(F.to_json(F.struct(F.col("url").alias("component"))), F.lit('"'), F.lit("&quot;"))
    page = F.concat("html", F.lit('<div id="app" data-page="'), F.replace(data, F.lit("&"), F.lit("&")), F.lit('">'))
    return table(spark, d, "pages").select("page_id", F.from_json(files.inertia_data(page), "component string")["component"].alias("component"))


@query("select page_id, trim(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '\\s+', ' ', 'g')) as title, len(regexp_extract_all(html, '<p[ >]'))::int as n_paragraphs, len(regexp_extract_all(html, '<li[ >]'))::int as n_items from pages")
def scan_html_css(spark, d):
    n = lambda tag: F.size(F.regexp_extract_all("html", F.lit(f"<{tag}[ >]"), F.lit(0)))
    title = F.trim(F.regexp_replace(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1), r"\s+", " "))
    return table(spark, d, "pages").select("page_id", title.alias("title"), n("p").alias("n_paragraphs"), n("li").alias("n_items"))


@query("select p_partkey, p_size * 10 as built, 1990 + p_size % 20 as y0, 1995 + p_size % 20 as y1 from part".replace("p_size * 10", "p_size * 10"))
def scan_wikitext(spark, d):
    size = F.col("p_size")
    box = F.concat(F.lit("{{Infobox\n| production = "), (1990 + size % 20).cast("string"), F.lit("–"), (1995 + size % 20).cast("string"), F.lit("\n| built = "), (size * 10).cast("string"), F.lit(" units\n}}"))
    pick = lambda p, k: F.regexp_extract(box, p, k).try_cast("int")
    years = r"\|\s*production\s*=\s*(\d{4})\s*[–-]\s*(\d{4})"
    return table(spark, d, "part").select("p_partkey", pick(r"\|\s*built\s*=\s*(\d+)", 1).alias("built"), pick(years, 1).alias("y0"), pick(years, 2).alias("y1"))


@query("select p_brand as uri, min(p_size) as first_size, string_agg(distinct p_type, ',' order by p_type) as bodies from part group by p_brand")
def scan_sparql(spark, d):
    bindings = table(spark, d, "part").select(F.to_json(F.struct(F.struct(F.col("p_brand").alias("value")).alias("uri"), F.struct(F.col("p_type").alias("value")).alias("body"), F.struct(F.col("p_size").alias("value")).alias("size"))).alias("j"))
    row = F.from_json("j", "uri struct<value: string>, body struct<value: string>, size struct<value: int>")
    rows = bindings.select(row.alias("r")).select(F.col("r.uri.value").alias("uri"), F.col("r.body.value").alias("body"), F.col("r.size.value").alias("size"))
    return rows.groupBy("uri").agg(F.min("size").alias("first_size"), F.array_join(F.array_sort(F.collect_set("body")), ",").alias("bodies"))


# ---- writes ----


@query("select n_name, count(*) as n from (select n_name from nation union all select n_name from nation where n_regionkey = 2) group by n_name")
def sink_insert(spark, d):
    path, n = _folder(spark, "insert"), table(spark, d, "nation").select("n_name", "n_regionkey")
    files.append(n, path)
    files.append(n.filter("n_regionkey = 2"), path)
    return spark.read.schema(n.schema).parquet(path).groupBy("n_name").agg(F.count("*").alias("n"))


@query("select p_brand, count(*) as n from part group by p_brand having count(*) >= 5")
def sink_truncate_insert(spark, d):
    path, part = _folder(spark, "segments"), table(spark, d, "part")
    files.replace_table(part.groupBy("p_brand").agg(F.count("*").alias("n")), path)
    files.replace_table(part.groupBy("p_brand").agg(F.count("*").alias("n")).filter("n >= 5"), path)
    return spark.read.schema("p_brand string, n long").parquet(path)


@query("select s_suppkey, s_name from supplier where not (s_acctbal < 0 or s_nationkey in (1, 2))")
def sink_delete(spark, d):
    return C.move(table(spark, d, "supplier"), (F.col("s_acctbal") < 0) | F.col("s_nationkey").isin(1, 2))[1].select("s_suppkey", "s_name")


@query("select o_orderkey, case when o_orderstatus = 'O' and o_custkey % 5 = 0 then 'removed' else o_orderstatus end as status from orders")
def sink_softdelete(spark, d):
    gone = F.expr("o_orderstatus = 'O' and o_custkey % 5 = 0")
    return table(spark, d, "orders").select("o_orderkey", F.when(gone, "removed").otherwise(F.col("o_orderstatus")).alias("status"))


@query("select o_orderkey, coalesce(c_mktsegment, o_orderpriority) as label from orders left join customer on o_custkey = c_custkey and c_acctbal > 0")
def sink_update_in(spark, d):
    known = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"))
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("label"))
    return C.update_from(rows, known, ["o_custkey"], ["label"]).select("o_orderkey", "label")


@query("select r_regionkey, r_name from region")
def sink_tsv(spark, d):
    path = _folder(spark, "out-tsv")
    files.write_tsv(table(spark, d, "region"), path)
    return spark.read.schema("r_regionkey int, r_name string").option("sep", "\t").option("header", True).csv(path)


# ---- descriptions ----


@query("select doc_id, case when n_chars <= 800 then 'short_de' when toxic = 1 then 'has_positive_bool' when doc_id % 7 = 0 then 'already_llm' when doc_id % 5 = 0 then 'no_yr_px' when 2024 - (1980 + doc_id % 40) >= 25 then 'collector' when doc_id * 100 >= 60000 then 'passion_px' else 'not_premium' end as reason from documents left join labels using (doc_id)")
def llm_eligibility(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    k = F.col("doc_id")
    reason = X.eligibility(F.col("text"), F.coalesce(F.col("toxic") == 1, F.lit(False)), F.when(k % 7 == 0, "h"), F.when(k % 5 != 0, 1980 + k % 40), k * 100, 2024)
    return rows.select("doc_id", reason.alias("reason"))


@query("select event_id, case when event_id % 3 = 0 then null else user_id end::bigint as k from events")
def json_parse_guard(spark, d):
    said = F.when(F.col("event_id") % 3 == 0, F.lit('{"other": 1}')).otherwise(F.concat(F.lit('```json\n{"k": '), F.col("user_id").cast("string"), F.lit("}\n```")))
    return table(spark, d, "events").select("event_id", X.guarded_answer(said, "k bigint", ["k"])["k"].alias("k"))


@query("select event_id, coalesce(case when user_id % 2 = 0 then event_type end, 'old') as a, coalesce(case when user_id % 3 = 0 then value end, 0.0) as b from events")
def json_merge_patch(spark, d):
    rows = table(spark, d, "events").select("event_id", F.struct(F.when(F.col("user_id") % 2 == 0, F.col("event_type")).alias("a"), F.when(F.col("user_id") % 3 == 0, F.col("value")).alias("b")).alias("patch"), F.struct(F.lit("old").alias("a"), F.lit(0.0).alias("b")).alias("old"))
    return rows.select("event_id", *[F.coalesce(f"patch.{c}", f"old.{c}").alias(c) for c in "ab"])


@query("select event_id, event_type as source, user_id as lot, coalesce(round_even((epoch_us(ts) - epoch_us(timestamp '2024-01-15')) / 3.6e9, 2), 1) as h_offset, case when event_type = 'purchase' then value end as sold_price from events")
def json_bridge(spark, d):
    status = F.when(F.col("event_type") == "purchase", "sold").otherwise("live")
    rows = table(spark, d, "events").select("event_id", F.struct(F.col("event_type").alias("auctioneer"), F.col("user_id").alias("lot_number"), F.col("value").alias("bid_current"), F.col("ts").alias("closes_at"), status.alias("status")).alias("a"))
    a = F.col("a")
    bridged = a.withField("source", a["auctioneer"]).withField("lot", a["lot_number"]).withField("h_offset", N.hours_to(a["closes_at"], a["status"], F.expr("timestamp_ntz '2024-01-15'"))).withField("sold_price", F.when(a["status"] == "sold", a["bid_current"]))
    return rows.select("event_id", bridged.alias("a")).select("event_id", "a.source", "a.lot", "a.h_offset", "a.sold_price")


@query("select doc_id, case when contains(lower(text), 'license') then 'licence' when contains(lower(text), 'token') then 'token' when regexp_matches(text, '[A-Z]{6}') then 'upper' end as rule from documents")
def rule_tags(spark, d):
    t = F.lower("text")
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.when(t.contains("license"), "licence"), F.when(t.contains("token"), "token"), F.when(F.col("text").rlike("[A-Z]{6}"), "upper")).alias("rule"))


@query("select p_partkey, p_brand as mk, trim(p_name) as mo from part")
def make_model(spark, d):
    """The makes are those of the table, however many: titles meet them by their first word."""
    part = table(spark, d, "part")
    title = F.concat("p_brand", F.lit("  "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.concat(F.lit(" "), "p_name")))
    makes = part.select(F.lower("p_brand").alias("alias"), F.col("p_brand").alias("make")).distinct()
    return M.make_model(part.select("p_partkey", title.alias("title")), "title", makes).select("p_partkey", "mk", "mo")


@query("select page_id, link from (select page_id, link, row_number() over (partition by page_id, regexp_replace(link, '.*/', '') order by pos) as r from (select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as link, unnest(range(len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)))) as pos from pages)) where r = 1")
def photo_dedup(spark, d):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))
    return rows.groupBy("page_id", F.regexp_replace("link", ".*/", "").alias("key")).agg(F.min_by("link", "pos").alias("link")).select("page_id", "link")


# ---- lifecycle jobs over a table ----


@query("select user_id, max(ts) as last_seen from events where user_id in (select user_id from events where event_type = 'signup') group by user_id")
def bump_seen(spark, d):
    e = table(spark, d, "events")
    return e.join(e.filter("event_type = 'signup'").select("user_id"), "user_id", "left_semi").groupBy("user_id").agg(F.max("ts").alias("last_seen"))


@query("select doc_id, min(doc_id) over (partition by md5(trim(regexp_replace(text, '\\s+', ' ', 'g')))) as first_id from documents where text <> ''")
def dedup_content(spark, d):
    rows = table(spark, d, "documents").filter("text <> ''").select("doc_id", T.content_hash(F.col("text")).alias("h"))
    return rows.join(rows.groupBy("h").agg(F.min("doc_id").alias("first_id")), "h").select("doc_id", "first_id")


@query(LISTING + ", f as (select id, src, px, lower(mk) || yr::varchar || (round_even(km / 5000, 0) * 5000)::bigint::varchar as fp from listing) select fp, min(id) as primary_id, count(*) as n, count(distinct src) as n_sources from f group by fp having count(distinct src) > 1")
def dedup_fingerprints(spark, d):
    rows = listing(spark, d).select("id", "src", F.concat(F.lower("mk"), F.col("yr").cast("string"), N.bucket(F.col("km"), 5000).cast("string")).alias("fp"))
    return rows.groupBy("fp").agg(F.min("id").alias("primary_id"), F.count("*").alias("n"), F.countDistinct("src").alias("n_sources")).filter("n_sources > 1")


@query("select o_orderkey, case when o_orderstatus = 'O' and o_totalprice < 50000 then 'expired' when o_orderstatus = 'P' and o_totalprice >= 50000 then 'active' else o_orderstatus end as status from orders")
def persona_reconcile(spark, d):
    keep = F.col("o_totalprice") >= 50_000
    status = F.when((F.col("o_orderstatus") == "O") & ~keep, "expired").when((F.col("o_orderstatus") == "P") & keep, "active").otherwise(F.col("o_orderstatus"))
    return table(spark, d, "orders").select("o_orderkey", status.alias("status"))


@query("with v as (select page_id, page_id % 4 = 1 as sold from pages) select case when sold then 'sold_history' else 'kept' end as part, count(*) as n, min(page_id) as least from v group by 1")
def wash(spark, d):
    page = F.when(F.col("page_id") % 4 == 1, F.concat("html", F.lit(" listing not found"))).otherwise(F.col("html"))
    rows = table(spark, d, "pages").select("page_id", page.alias("page")).select("page_id", T.sold_verdict(F.col("page")).alias("verdict"))
    gone, kept = C.move(rows, F.col("verdict").isNotNull())
    return gone.select("page_id", F.lit("sold_history").alias("part")).union(kept.select("page_id", F.lit("kept"))).groupBy("part").agg(F.count("*").alias("n"), F.min("page_id").alias("least"))


@query("select event_type, count(*) as total, count(*) filter (where value < 30) as skipped, round(100.0 * count(*) filter (where value < 30) / count(*), 1) as saved_pct, count(*) filter (where value < 50) * 2 >= count(*) as alert from events group by event_type")
def stats_flush(spark, d):
    low = lambda x: F.count_if(F.col("value") < x)
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("total"), low(30).alias("skipped"), F.round(100.0 * low(30) / F.count("*"), 1).alias("saved_pct"), (low(50) * 2 >= F.count("*")).alias("alert"))


@query("select user_id, string_agg(event_type, '>' order by ts, event_id) as log from events group by user_id")
def append_log(spark, d):
    rows = table(spark, d, "events")
    log = F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type")))
    return rows.groupBy("user_id").agg(F.array_join(F.transform(log, lambda x: x["event_type"]), ">").alias("log"))


@query("select event_type, quantile_cont(value, 0.5) as p50, quantile_cont(value, 0.95) as p95, round(avg(value), 4) as mean, round(sum(user_id * 0.001::double), 3) as cost, case when quantile_cont(value, 0.95) <= 95 then 'go' else 'no-go' end as verdict from events group by event_type")
def latency_stats(spark, d):
    rows = table(spark, d, "events")
    means = rows.groupBy("event_type").agg(F.round(F.avg("value"), 4).alias("mean"), F.round(F.sum(F.col("user_id") * 0.001), 3).alias("cost"))
    p = S.percentiles(rows, ["event_type"], "value", [0.5, 0.95]).select("event_type", F.col("p0").alias("p50"), F.col("p1").alias("p95"))
    return means.join(p, "event_type").select("event_type", "p50", "p95", "mean", "cost", F.when(F.col("p95") <= 95, "go").otherwise("no-go").alias("verdict"))


@query("select event_type as status, count(*) as n, count(*) filter (where value > 99) as failed from events group by 1 union all select 'all', count(*), count(*) filter (where value > 99) from events")
def batch_summary(spark, d):
    e = table(spark, d, "events")
    both = [F.count("*").alias("n"), F.count_if(F.col("value") > 99).alias("failed")]
    return e.groupBy(F.col("event_type").alias("status")).agg(*both).unionByName(e.agg(*both).withColumn("status", F.lit("all")))


@query("select event_type, max(len) as longest from (select event_type, count(*) as len from (select event_type, value > 50 as bad, row_number() over (partition by event_type order by ts, event_id) - row_number() over (partition by event_type, value > 50 order by ts, event_id) as island from events) where bad group by event_type, island) group by event_type")
def longest_failures(spark, d):
    return A.longest_runs(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], F.col("value") > 50)
