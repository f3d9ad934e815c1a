"""Text queries over documents, pages and conversations, which play descriptions and listing pages; and event streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.functions import numbers as N
from quarrymill.functions import text as T
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


def _quote(text: str) -> str:
    return text.replace("'", "''")


_NORM = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'), '([a-z])([0-9])', '\\1 \\2', 'g'), '([0-9])([a-z])', '\\1 \\2', 'g'), ' +', ' ', 'g'))"


@query("select p_partkey, " + _NORM.format("p_brand || p_size::varchar || '-' || p_name") + " as norm from part")
def normalize_model(spark, d):
    return table(spark, d, "part").select("p_partkey", T.normalize_model(F.concat("p_brand", F.col("p_size").cast("string"), F.lit("-"), "p_name")).alias("norm"))


@query(
    "with n as (select p_partkey, trim(regexp_replace(lower(p_name || ' RS ' || p_size::varchar || ' d'), '[^a-z0-9]+', ' ', 'g')) as n from part) select p_partkey, regexp_replace(regexp_replace(n, '\\b([a-z]{1,3})\\s+(\\d{1,3})\\b', '\\1\\2', 'g'), '\\b(\\d{1,3})\\s+([a-z]{1,3})\\b', '\\1\\2', 'g') as tight, trim(regexp_replace(regexp_replace(regexp_replace(n, '([a-z])([0-9])', '\\1 \\2', 'g'), '([0-9])([a-z])', '\\1 \\2', 'g'), ' +', ' ', 'g')) as split from n"
)
def norm_tight_split(spark, d):
    text = F.concat(F.col("p_name"), F.lit(" RS "), F.col("p_size").cast("string"), F.lit(" d"))
    return table(spark, d, "part").select("p_partkey", T.norm_tight(text).alias("tight"), T.norm_split(text).alias("split"))


@query(
    "with p as (select p_partkey, case p_partkey % 5 when 0 then '€ ' || p_size::varchar || '.500' when 1 then p_size::varchar || '.234,56 EUR' when 2 then p_size::varchar || ',234.5' when 3 then p_size::varchar || ',5' else p_size::varchar || '.25' end as s from part) select p_partkey, s, case p_partkey % 5 when 0 then p_size * 1000 + 500 when 1 then p_size * 1000 + 234.56 when 2 then p_size * 1000 + 234.5 when 3 then p_size + 0.5 else p_size + 0.25 end::double as price from p join part using (p_partkey)"
)
def parse_price(spark, d):
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    s = F.when(k == 0, F.concat(F.lit("€ "), size, F.lit(".500"))).when(k == 1, F.concat(size, F.lit(".234,56 EUR"))).when(k == 2, F.concat(size, F.lit(",234.5"))).when(k == 3, F.concat(size, F.lit(",5"))).otherwise(F.concat(size, F.lit(".25")))
    return table(spark, d, "part").select("p_partkey", s.alias("s"), N.parse_price(s).alias("price"))


@query("select l_orderkey, l_linenumber, (l_quantity * 1000)::bigint as km, year(l_shipdate)::int as yr from lineitem")
def extract_year_km(spark, d):
    km = (F.col("l_quantity") * 1000).cast("long").cast("string")
    text = F.concat(F.lit("Bj. "), F.year("l_shipdate").cast("string"), F.lit(", "), F.regexp_replace(km, r"(\d)(\d{3})$", "$1 $2"), F.lit(" km"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", N.extract_km(text).alias("km"), N.parse_year(text).alias("yr"))


_SPACED = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


@query("select doc_id, case when text = '' then '' else left(md5(" + _SPACED.format("text") + "), 16) end as hash from documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("hash"))


_BARE = "html"
for _tag in ("script", "style", "template", "noscript"):
    _BARE = f"regexp_replace({_BARE}, '(?is)<{_tag}[^>]*>.*?</{_tag}>', ' ', 'g')"
_VISIBLE = "trim(regexp_replace(regexp_replace(" + _BARE + ", '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"select page_id, length(v) as n, md5(v) as hash from (select page_id, {_VISIBLE} as v from pages)")
def visible_text(spark, d):
    v = T.visible_text(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.length(v).cast("long").alias("n"), F.md5(v.cast("binary")).alias("hash"))


def _sold_sql() -> str:
    noise = "(?i)" + T.SOLD_NOISE
    quiet = lambda x: f"regexp_replace({x}, '{_quote(noise)}', ' ', 'g')"
    grab = lambda t: f"lower(trim(regexp_replace(regexp_replace(regexp_extract(page, '(?is)<{t}[^>]*>(.*?)</{t}>', 1), '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')))"
    edge = lambda x, m: f"regexp_matches(' ' || {x} || ' ', '[^\\pL\\pN_]{m}[^\\pL\\pN_]')"
    cases = [f"when contains(clean, '{_quote(m)}') then '{_quote(m)}'" for m in T.SOLD_HARD]
    cases += [f"when {edge('head', m)} then '{m}'" for m in T.SOLD_SOFT]
    cases += [f"when length(v) < {T.SHORT_PAGE} and {edge('short', m)} then '{m}'" for m in T.SOLD_SOFT]
    visible = _VISIBLE.replace("regexp_replace(html", "regexp_replace(page")
    return f"""with p as (select page_id, case when page_id % 4 = 0 then replace(html, '<h1>', '<h1>Verkauft: ') when page_id % 4 = 1 then html || ' listing not found' when page_id % 4 = 2 then left(html, 700) || ' sold out, vendu' else html end as page from pages),
q as (select page_id, {quiet('lower(page)')} as clean, {quiet(grab('title') + " || ' ¦ ' || " + grab('h1'))} as head, {visible} as v from p),
r as (select *, {quiet('lower(v)')} as short from q)
select page_id, case {' '.join(cases)} end as verdict from r"""


@query(_sold_sql())
def sold_verdict(spark, d):
    html, k = F.col("html"), F.col("page_id") % 4
    page = F.when(k == 0, F.replace(html, F.lit("<h1>"), F.lit("<h1>Verkauft: "))).when(k == 1, F.concat(html, F.lit(" listing not found"))).when(k == 2, F.concat(F.left(html, F.lit(700)), F.lit(" sold out, vendu"))).otherwise(html)
    return table(spark, d, "pages").select("page_id", page.alias("page")).select("page_id", T.sold_verdict(F.col("page")).alias("verdict"))


@query("with l as (select distinct page_id, unnest(regexp_extract_all(html, 'href=[\"'']([^\"'']+)[\"'']', 1)) as link from pages) select page_id, link from l")
def link_discovery(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(files.links(F.col("html"))).alias("link"))


def _lang_sql() -> str:
    n = {k: f"len(regexp_extract_all(' ' || replace(replace(lower(text), ' ', '  '), chr(10), '  ') || ' ', '(?:^|[^\\pL\\pN_])(?:{'|'.join(w)})(?:$|[^\\pL\\pN_])'))" for k, w in T.STOP_WORDS.items()}
    return "with t as (select doc_id, regexp_replace(lower(text), '([^\\pL\\pN_])', '\\1 ', 'g') as text from documents where lower(text) = text or true), c as (select doc_id, " + ", ".join(f"{e} as {k}_n" for k, e in n.items()) + " from t) select doc_id, case when greatest(" + ", ".join(f"{k}_n" for k in n) + ") = 0 then 'fr' " + " ".join(f"when {k}_n = greatest({', '.join(f'{x}_n' for x in n)}) then '{k}'" for k in n) + " end as lang from c"


@query(_lang_sql())
def lang_detect(spark, d):
    return table(spark, d, "documents").select("doc_id", T.language_by_stop_words(F.col("text")).alias("lang"))


@query("select doc_id, coalesce(regexp_matches(lower(text), 'license|copyright'), false) as has_license, coalesce(regexp_matches(lower(text), '(?s)(?:sans.{0,26}|pas de.{0,24}|pas d''.{0,24}|aucun.{0,25}|aucune.{0,24}|manque.{0,24}|manquant.{0,22}|manquante.{0,21}|absent.{0,24}|absente.{0,23}|no .{0,27}|without.{0,23}|non .{0,26}|n''est pas.{0,21})license'), false) as negated, coalesce(regexp_matches(lower(text), 'su richiesta|poa|price on application|preis auf anfrage|prix sur demande|on request|sur demande'), false) as on_request from documents")
def feature_flags(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.has_any(t, ["license", "copyright"]).alias("has_license"), T.near_negation(t, "license").alias("negated"), T.on_request(t).alias("on_request"))


@query("select p_partkey, case when p_size between 20 and 50 then p_size end::int as n from part")
def limited_of(spark, d):
    text = F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" 1 of "), F.col("p_size").cast("string"))).otherwise(F.concat(F.lit(" Final Edition "), F.col("p_size").cast("string"))))
    return table(spark, d, "part").select("p_partkey", T.limited_edition(text).alias("n"))


_PLATFORMS = {"symfio_v2": "case when regexp_matches(html, '<script id=\"__NEXT_DATA__\"') then 0.3 else 0.0 end", "symfio_v1": "case when regexp_matches(html, '(?s)<script[^>]*type=\"application/ld\\+json\"[^>]*>.*?\"@type\"\\s*:\\s*\"Vehicle\"') then 0.3 else 0.0 end", "rivamedia": "0.0", "drupal": "case when contains(html, '/sites/default/files/') then 0.2 else 0.0 end", "inertia": "0.0", "generic_cards": "0.0"}


@query("select page_id, " + ", ".join(f"({v})::double as {k}" for k, v in _PLATFORMS.items()) + " from pages")
def platform_sniff(spark, d):
    return table(spark, d, "pages").select("page_id", *[c.cast("double").alias(k) for k, c in T.platform_scores(F.col("html"), F.col("url")).items()])


@query("with u as (select page_id, lower(regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www\\.', '')) as host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) as path from pages) select page_id, host, regexp_replace(split_part(host, '.', 1), '[^a-z0-9-]', '-', 'g') as slug, case when regexp_matches(trim(path, '/'), '\\.html?$') or regexp_matches(path, '(19|20)\\d\\d') or len(list_filter(string_split(path, '/'), lambda s: s <> '')) >= 2 then 'car_page' else 'root' end as shape, nullif(list_extract(regexp_extract_all(path, '\\d{5,}'), -1), '') as listing from u")
def url_parts(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", T.host(u).alias("host"), T.slug(u).alias("slug"), T.url_shape(u).alias("shape"), T.listing_id(u).alias("listing"))


@query("select n_nationkey, case n_name when 'FRANCE' then 'fr' when 'GERMANY' then 'de' when 'UNITED KINGDOM' then 'gb' end as iso, not (lower(n_name) in ('france', 'germany', 'canada', 'japan', 'united kingdom', 'united states')) and length(trim(n_name)) > 2 as city from nation".replace(", 'japan'", ""))
def country_and_city(spark, d):
    n = F.col("n_name")
    return table(spark, d, "nation").select("n_nationkey", T.country_iso(n).alias("iso"), T.is_city(n).alias("city"))


@query("select conv_id, turn, lower(role) as role, regexp_replace(text, '\\s*\\([^)]*\\)', '', 'g') as text from conversations")
def remove_parens(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.lower("role").alias("role"), T.remove_parens(F.col("text")).alias("text"))


@query("select event_id, (props->>'k')::int as k from events where (props->>'k')::int >= 50")
def json_path(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select("event_id", k.alias("k")).filter("k >= 50").orderBy(F.desc("k"), "event_id")


@query("select event_type, string_agg(k, ',' order by k) as keys from (select distinct event_type, props->>'k' as k from events) group by event_type")
def map_agg(spark, d):
    rows = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").alias("k")).distinct()
    counted = rows.groupBy("event_type").agg(F.map_from_entries(F.collect_list(F.struct("k", F.lit(1)))).alias("m"))
    return counted.select("event_type", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"))


@query("select distinct user_id, event_type from events")
def dedup_stream(spark, d):
    return jobs.dedup_once(spark, d, table(spark, d, "events").schema)


@query("select * exclude (r) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1")
def lifecycle_stream(spark, d):
    return jobs.lifecycle_once(spark, d, table(spark, d, "events").schema)
