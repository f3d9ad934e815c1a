"""Further queries: shares of sources, documents within documents, maps, reports, changes and sightings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.operators import aggregates as A
from quarrymill.operators import lifecycle as C
from quarrymill.plans.listings import LISTING, listing, table
from quarrymill.sources import files
from quarrymill.sources.shared import shared_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(LISTING + ", r as (select src, px, row_number() over (partition by src order by px) - 1 as r, count(*) over (partition by src) as n from listing) select src, max(n) as rows, max(n) as n, max(case when r = n // 4 then px end) as q25, max(case when r = 3 * n // 4 then px end) as q75, round(100.0 * max(n) / (select count(*) from listing), 4) as share_pct, (select quantile_cont(px, 0.5) from listing)::double as median_all from r group by src")
def source_share(spark, d):
    return A.source_share(listing(spark, d), "src", "px")


@query("select n_nationkey, 'm' || n_nationkey::varchar as found from nation where n_nationkey % 3 <> 0")
def scan_json_deep(spark, d):
    """An array of listings three objects deep; one seven deep is not looked for."""
    k = F.col("n_nationkey").cast("string")
    row = F.concat(F.lit('[{"make": "m'), k, F.lit('", "price": 1}]'))
    page = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('{"a":{"b":{"c":{"d":{"e":{"f":{"g":'), row, F.lit("}}}}}}}"))).otherwise(F.concat(F.lit('{"x": [1, 2], "a": {"y": {"list": '), row, F.lit("}}}")))
    rows = table(spark, d, "nation").select("n_nationkey", F.explode(files.deep_rows(page, ["make", "price", "mileage"])).alias("row"))
    return rows.select("n_nationkey", F.get_json_object("row", "$.make").alias("found"))


@query("select case when n_regionkey = 0 then 'https://x.example/index.xml' else 'https://x.example/' || n_regionkey || '.xml' end as root, 'https://x.example/car/' || n_nationkey as url from nation")
def scan_sitemap_index(spark, d):
    n = table(spark, d, "nation")
    url = lambda name: F.concat(F.lit("https://x.example/"), name, F.lit(".xml"))
    loc = lambda u: F.concat(F.lit("<url><loc> "), u, F.lit(" </loc></url>"))
    maps = n.groupBy("n_regionkey").agg(F.array_join(F.collect_list(loc(F.concat(F.lit("https://x.example/car/"), F.col("n_nationkey")))), "").alias("xml")).select(url(F.col("n_regionkey")).alias("url"), "xml")
    index = maps.filter("url = 'https://x.example/0.xml'").select(F.lit("https://x.example/index.xml").alias("url"), F.concat(F.lit("<sitemapindex>"), loc(F.col("url")), F.lit("</sitemapindex>")).alias("xml"))
    return files.sitemap_pages(maps.union(index))


@query("select r_regionkey as region, r_name as name from region")
def sink_report(spark, d):
    """Written as JSON and Markdown and read back."""
    folder = shared_folder(spark, "report")
    rows = table(spark, d, "region").select(F.col("r_regionkey").alias("region"), F.col("r_name").alias("name"))
    files.report(rows, folder)
    return spark.read.schema("region long, name string").json(f"{folder}/json")


@query("select o_orderkey, case when o_orderstatus <> 'O' or o_totalprice > 200000 then timestamp '2024-02-01' else o_orderdate end as updated_at from orders")
def updated_at(spark, d):
    """A row's time of change follows only where a watched column differs from what it was."""
    o = table(spark, d, "orders")
    old = o.select("o_orderkey", F.lit("O").alias("status"), F.least("o_totalprice", F.lit(200_000)).alias("price"), F.col("o_orderdate").alias("updated_at"))
    new = o.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return A.touched(old, new, "o_orderkey", ["status", "price"], "updated_at", F.expr("timestamp_ntz '2024-02-01'")).select("o_orderkey", "updated_at")


@query("select c_nationkey as nation, count(*) as n, round(sum(c_acctbal), 2) as balance from customer where c_acctbal >= 1000 group by 1")
def scan_rpc(spark, d):
    """A stored function with parameters, called by name with JSON arguments."""
    return A.call(spark, {"balances": lambda least: table(spark, d, "customer").filter(F.col("c_acctbal") >= least).groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))}, "balances", '{"least": 1000}')


@query("""with o as (select o_orderkey as k, o_totalprice as price, case o_orderstatus when 'F' then 'expired' else 'active' end as status, case when o_orderstatus = 'F' and o_custkey % 2 = 0 then 'sold' end as exit_reason, o_custkey % 5 as times_seen, o_orderdate as seen_at from orders where o_orderkey % 4 <> 0),
s as (select o_orderkey as k, case when o_custkey % 7 = 0 then null when o_custkey % 3 = 0 then o_totalprice * 1.1 when o_custkey % 3 = 1 then o_totalprice * 1.001 else o_totalprice end as price from orders where o_custkey % 4 <> 1)
select coalesce(o.k, s.k) as k, round(case when o.k is null then s.price when s.k is null or exit_reason = 'sold' or s.price is null then o.price when abs(s.price - o.price) / o.price >= 0.02 then s.price else o.price end, 4) as price,
  case when s.k is not null and coalesce(exit_reason, '') <> 'sold' then 'active' else status end as status, exit_reason,
  (case when s.k is not null and coalesce(exit_reason, '') <> 'sold' then coalesce(times_seen, 0) + 1 else times_seen end)::bigint as times_seen,
  case when s.k is not null and coalesce(exit_reason, '') <> 'sold' then timestamp '2030-01-01' else seen_at end as last_seen_at
from o full join s on o.k = s.k""")
def listing_sightings(spark, d):
    """Sightings come twice, the first with another price."""
    o = table(spark, d, "orders")
    photos = F.array().cast("array<string>").alias("photos")
    gone, sold = F.col("o_orderstatus") == "F", (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 2 == 0)
    old = o.filter("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.when(gone, "expired").otherwise("active").alias("status"), F.when(sold, "sold").alias("exit_reason"), (F.col("o_custkey") % 5).alias("times_seen"), F.col("o_orderdate").alias("last_seen_at"), photos)
    c, px = F.col("o_custkey"), F.col("o_totalprice")
    price = F.when(c % 7 == 0, F.lit(None)).when(c % 3 == 0, px * 1.1).when(c % 3 == 1, px * 1.001).otherwise(px)
    some = o.filter("o_custkey % 4 <> 1")
    seen = some.select(F.col("o_orderkey").alias("k"), price.alias("price"), photos, F.lit(2).alias("at")).union(some.select("o_orderkey", px * 9, photos, F.lit(1)))
    out = C.sighted(old, seen, "k", "at", F.expr("timestamp_ntz '2030-01-01'"))
    return out.select("k", F.round("price", 4).alias("price"), "status", "exit_reason", F.col("times_seen").cast("long").alias("times_seen"), "last_seen_at")
