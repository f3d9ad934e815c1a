"""The queries opN_<name> over the corpus tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import centroids, decontaminate, html, hpylm, langid, negatives, packing, pii, quality, simhash, substrings, toxicity, urls
from quarrymill.llm.common import fold, table


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score_folds(table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 4) != 2))
    found = langid.identify(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(fold("doc_id", 3) != 1))
    return toxicity.score(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9_quality that SQL can express."""
    return op9_quality(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html": op1_html,
        "op2_pii": op2_pii,
        "op3_decontaminate": op3_decontaminate,
        "op4_hpylm": op4_hpylm,
        "op5_langid": op5_langid,
        "op6_substrings": op6_substrings,
        "op7_packing": op7_packing,
        "op8_toxicity": op8_toxicity,
        "op9_quality": op9_quality,
        "op10_simhash": op10_simhash,
        "op11_urls": op11_urls,
        "op12_negatives": op12_negatives,
        "op13_centroids": op13_centroids,
        "quality_base": quality_base,
    }


#: Repeated words of the same place in a text have places of their own; a repeated row is a row of its own.
OP3_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (
  select item_id::varchar as item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark where item_id is not null),
w as (
  select distinct item_id, least(10, len(ws)) as n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') as s
  from b, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) as t(i) where len(ws) > 0),
lengths as (select distinct n from w),
p as (
  select rid, i, n, array_to_string(ws[i : i + n - 1], ' ') as s
  from (select rid, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, lengths where len(ws) >= n)),
hit as (select rid, i, p.n, item_id from p join w on p.n = w.n and p.s = w.s),
covered as (select rid, count(distinct i + k) as n_hit from hit, unnest(range(0, n)) as t(k) group by rid),
found as (select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct rid, item_id from hit) group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (rid) left join found using (rid)
"""

OP6_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (
  select rid, doc_id, i, array_to_string(ws[i : i + 49], ' ') as s
  from (select rid, doc_id, ws, unnest(range(1, len(ws) - 48)) as i from d where len(ws) >= 50 and doc_id is not null)),
first as (select s, min(doc_id) as least from w group by s),
gone as (select distinct rid, i + k as p from w join first using (s), unnest(range(0, 50)) as t(k) where doc_id > least),
kept as (
  select rid, string_agg(word, ' ' order by p) as text, count(*) as n
  from (select rid, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from d) anti join gone using (rid, p) group by rid)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (rid)
"""


QUALITY_SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (
  select rid, i, array_to_string(ws[i : i + 7], ' ') as s
  from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from d where len(ws) >= 8)),
twice as (select rid, s from w group by rid, s having count(*) > 1),
rep as (select rid, count(distinct i + k) as n from w join twice using (rid, s), unnest(range(0, 8)) as t(k) group by rid),
lines as (select rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d)
select doc_id, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
  coalesce(rep.n, 0)::bigint as n_repeat_words, len(ws) < 20 or 100 * coalesce(rep.n, 0) > 30 * len(ws) as base_failed
from d join lines using (rid) left join rep using (rid)
"""

#: Levels are rolled up from hosts; a level's prior weighs 1 / spread - 1 outcomes.
OP11_SQL = r"""
with cut as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
named as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
rules(verdict, rule, domain, begin) as (
  values ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
    ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
found as (
  select n.*, (select max(length(rule)) from rules where (host = domain or ends_with(host, '.' || domain)) and starts_with(path, begin)) as longest from named n),
decided as (
  select f.page_id, f.host, f.path, r.rule, r.verdict from found f
  left join rules r on length(r.rule) = f.longest and (host = domain or ends_with(host, '.' || domain)) and starts_with(path, begin)),
bare as (
  select host, count(verdict) as n, count(*) filter (verdict = 'block') as k, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*\z', '') as b from decided group by host),
suffixed as (
  select *, case when regexp_matches(b, '^[0-9]+(\.[0-9]+)*\z') then ''
    when regexp_matches(b, '\.((?:ac|co|com|edu|gov|net|org)\.[a-z][a-z])\z') then regexp_extract(b, '\.((?:ac|co|com|edu|gov|net|org)\.[a-z][a-z])\z', 1)
    else regexp_extract(b, '[^.]*\z') end as suffix from bare),
hosts as (
  select host, n, k, suffix, case when suffix = '' or length(b) = length(suffix) then b
    else regexp_extract(substr(b, 1, greatest(length(b) - length(suffix) - 1, 0)), '[^.]*\z') || '.' || suffix end as domain from suffixed),
domains as (select domain, suffix, sum(n) as n, sum(k) as k from hosts group by all),
suffixes as (select suffix, sum(n) as n, sum(k) as k from domains group by all),
s0 as (select *, (select (sum(k) + 0.5) / (sum(n) + 1) from suffixes)::double as m from suffixes),
sw as (select 1 / least(greatest(coalesce((sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))) / nullif(sum(n * m * (1 - m) * (n - 1)), 0), 0.001), 0.001), 0.9) - 1 as w from s0),
s1 as (select suffix, (k + m * w) / (n + w) as mean from s0, sw),
d0 as (select domain, n, k, mean as m from domains join s1 using (suffix)),
dw as (select 1 / least(greatest(coalesce((sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))) / nullif(sum(n * m * (1 - m) * (n - 1)), 0), 0.001), 0.001), 0.9) - 1 as w from d0),
d1 as (select domain, (k + m * w) / (n + w) as mean from d0, dw),
h0 as (select host, n, k, mean as m from hosts join d1 using (domain)),
hw as (select 1 / least(greatest(coalesce((sum((k - n * m) * (k - n * m)) - sum(n * m * (1 - m))) / nullif(sum(n * m * (1 - m) * (n - 1)), 0), 0.001), 0.001), 0.9) - 1 as w from h0),
h1 as (select host, n, k, n + w as size, (k + m * w) / (n + w) as mean from h0, hw),
h2 as (select host, n, k, mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1)) as bound from h1)
select page_id, host, path, rule, coalesce(verdict, case when round(bound, 9) >= 0.5 then 'block' else 'allow' end) as verdict,
  n::bigint as n_outcomes, k::bigint as n_blocked, round(bound, 6) as bound
from decided join h2 using (host)
"""

OP12_SQL = r"""
with e as (
  select row_number() over () as rid, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.rid, a.vec_id as anchor_id, a.label as own, b.vec_id, b.label,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::bigint as score
  from e a join e b on a.vec_id % 50 = 0 and true),
p as (
  select rid, anchor_id, own, vec_id as positive_id, score as positive_score, row_number() over (partition by rid order by score desc, vec_id) as k
  from s where label = own and vec_id <> anchor_id qualify k <= 5),
n as (
  select p.rid, p.k, p.anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.rid, p.k order by s.score desc, s.vec_id) as r
  from p join s on p.rid = s.rid and s.label <> p.own and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id, positive_id, r::integer as rank, negative_id, positive_score, negative_score from n where r <= 3
"""


def _op13_sql() -> str:
    """One chain of tables for each round: distances by centroid, the nearest, the new centroids."""
    steps = [
        r"""with e as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
c0 as (select row_number() over (order by sha256('3:' || coalesce(vec_id::varchar, '')), v) - 1 as c, v as m from e order by c limit 8)"""
    ]
    for r in range(11):
        steps.append(f"""d{r} as (select rid, vec_id, v, c, m, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from e join c{r} on true),
a{r} as materialized (select * from d{r} qualify row_number() over (partition by rid order by d, c) = 1)""")
        if r < 10:
            steps.append(f"""s{r} as (select c, i, sum(v[i])::hugeint as s, count(*)::hugeint as n from a{r}, unnest(range(1, 65)) as t(i) group by c, i),
c{r + 1} as materialized (
  select c, coalesce((select list(((s - ((s % n) + n) % n) // n)::bigint order by i) from s{r} where s{r}.c = c{r}.c), m) as m from c{r})""")
    steps.append(r"""o as (select vec_id, c, d, sum(d) over (partition by c) as own, sum(d) over () as total, sha256(array_to_string(m, ',')) as mark from a10)""")
    return ",\n".join(steps) + "\nselect vec_id, c::integer as cluster, d as distance, own::bigint as cluster_inertia, total::bigint as inertia, mark as centroid_sha256 from o"


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": OP3_SQL.replace("\\\\", "\\"), "op6_substrings": OP6_SQL.replace("\\\\", "\\"), "op11_urls": OP11_SQL, "op12_negatives": OP12_SQL, "op13_centroids": _op13_sql(), "quality_base": QUALITY_SQL.replace("\\\\", "\\")}
