"""URL filters against a plain version, and what odd rows come to."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import queries, urls

COLUMNS = "page_id long, url string, host string, rule string, rows int"


def pages(spark, found):
    return spark.createDataFrame([(k, u, "clash", "clash", 1) for k, u in found], COLUMNS)


def plain(found, rules=urls.RULES, more=()):
    """page_id, host, path, rule, verdict, by dictionaries; and each host's bound."""
    out, seen = [], {}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

    def cut(url):
        if "://" not in (url or ""):
            return "", ""
        rest = url.split("://", 1)[1]
        end = min([rest.find(x) for x in "/?#" if x in rest] or [len(rest)])
        path = rest[end:]
        return rest[:end].translate(lower), path[: min([path.find(x) for x in "?#" if x in path] or [len(path)])]

    def owner(host):
        labels = host.rsplit("@")[-1].split(":")[0].split(".")
        if all(x.isdigit() for x in labels):
            return ".".join(labels), ""
        n = 2 if len(labels) > 2 and labels[-2] in urls.SECOND_LEVEL and len(labels[-1]) == 2 else 1
        return ".".join(labels[-n - 1 :]), ".".join(labels[-n:])

    for k, url in found:
        host, path = cut(url)
        fit = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(fit, default=(0, None, None))
        out.append([k, host, path, rule[1], rule[2]])
        n, b = seen.get(host, (0, 0))
        seen[host] = (n + (rule[2] is not None), b + (rule[2] == "block"))
    for url, b in more:
        n, k = seen.get(cut(url)[0], (0, 0))
        seen[cut(url)[0]] = (n + 1, k + b)

    def level(members, priors):
        rest = {k: (n, b, priors[k]) for k, (n, b) in members.items()}
        free = {k: n * m * (1 - m) for k, (n, b, m) in rest.items()}
        room = sum(free[k] * (rest[k][0] - 1) for k in rest)
        spread = (sum((b - n * m) ** 2 for n, b, m in rest.values()) - sum(free.values())) / room if room else 0
        w = 1 / min(max(spread, urls.LEAST_SPREAD), urls.MOST_SPREAD) - 1
        return {k: ((b + m * w) / (n + w), n + w) for k, (n, b, m) in rest.items()}

    def summed(members, key):
        out = {}
        for k, (n, b) in members.items():
            old = out.get(key(k), (0, 0))
            out[key(k)] = (old[0] + n, old[1] + b)
        return out

    domains = summed(seen, owner)
    suffixes = summed(domains, lambda d: d[1])
    total = [sum(x) for x in zip(*suffixes.values(), strict=True)]
    top = level(suffixes, dict.fromkeys(suffixes, (total[1] + 0.5) / (total[0] + 1)))
    middle = level(domains, {d: top[d[1]][0] for d in domains})
    low = level(seen, {h: middle[owner(h)][0] for h in seen})
    bound = {h: m - urls.DEVIATIONS * math.sqrt(m * (1 - m) / (size + 1)) for h, (m, size) in low.items()}
    return [(k, h, p, r, v or ("block" if bound[h] >= urls.THRESHOLD else "allow")) for k, h, p, r, v in out], bound


def check(spark, found, more=()):
    outcomes = spark.createDataFrame(list(more), "url string, blocked int") if more else None
    got = urls.judge(pages(spark, found), outcomes=outcomes).collect()
    want, bound = plain(found, more=more)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got], key=key) == sorted(want, key=key)
    assert all(r.bound == pytest.approx(bound[r.host], abs=2e-6) for r in got)
    return {r.page_id: r for r in got}


ODD = [
    (1, "http://Example.ORG/es/1"), (2, "https://a.b.example.org/en/123?x=/es/"), (3, "http://example.org/en/2"), (4, "http://example.org"), (5, "http://notexample.org/es/1"),
    (6, "http://example.com/fr/"), (7, "http://example.com/fr"), (8, "http://x.com/de/a#b"), (9, "ftp://com/de/"), (10, None), (11, ""), (12, "example.org/es/"), (13, "a://b://c/d"),
    (14, "http://h?x=1"), (15, "http://h#/a"), (16, "://h/p"), (17, "http://\u00c9COLE.com/de/"), (18, "http://a.com:80/de/1"), (19, "http://u:p@a.co.uk/x"), (20, "http://10.0.0.1/x"), (None, "http://q.net/"),
    (21, "http://q.net/\n/x?y"), (22, "http://" + "a." * 3000 + "com/de/" + "x" * 100_000), (23, "http://.com/de/"), (24, "http://a..net/"), (20, "http://10.0.0.1/x"),
]


def test_odd_urls(spark):
    got = check(spark, ODD)
    assert (got[1].rule, got[2].rule, got[3].rule, got[4].rule, got[5].rule) == ("example.org/es/", "example.org/en/1", "org/", None, "org/")
    assert (got[17].host, got[9].verdict, got[10].host, got[16].host) == ("\u00c9cole.com", "block", "", "h")


def test_reputation_spreads_from_host_to_domain_to_suffix(spark):
    bad = [(k, f"http://h{k % 4}.bad.com/de/{k}") for k in range(400)] + [(1000, "http://h1.bad.com/x"), (1001, "http://new.bad.com/x")]
    good = [(2000 + k, f"http://h{k % 40}.good{k % 9}.com/fr/{k}") for k in range(400)] + [(3000, "http://h1.good1.com/x"), (3001, "http://other.com/x"), (3002, "http://x.net/")]
    got = check(spark, bad + good)
    assert got[1000].verdict == got[1001].verdict == "block"
    assert got[3000].verdict == got[3001].verdict == got[3002].verdict == "allow"
    assert got[1001].bound < got[1000].bound and got[3000].bound < got[3001].bound


def test_other_outcomes_and_a_host_with_most_rows(spark):
    found = [(k, f"http://www.hot.net/{k}") for k in range(3000)] + [(5000 + k, f"http://h{k}.net/") for k in range(50)]
    got = check(spark, found, [("http://www.hot.net/1", 1)] * 60 + [("http://h1.net/", 0)] * 60)
    assert got[7].verdict == "block" and got[5001].verdict == "allow" and got[7].n_outcomes == 60


def test_heavy_hosts_are_salted(spark):
    rows = [(k, f"http://hot.com/{k}") for k in range(4000)] + [(9000 + k, f"http://h{k}.com/") for k in range(3000)]
    known = urls.reputation(pages(spark, rows).select(urls.host_and_path(F.col("url"))[0].alias("host"), F.lit(None).cast("long").alias("blocked")))
    assert known.agg(F.sum("rows"), F.count("*"), F.min("mean"), F.max("mean")).first() == (7000, 3001, 0.5, 0.5)
    assert urls.judge(pages(spark, rows)).groupBy("verdict").count().collect() == [("allow", 7000)]


def test_empty_tables_and_no_rules(spark):
    assert urls.judge(pages(spark, [])).collect() == []
    assert [(r.rule, r.verdict) for r in urls.judge(pages(spark, [(1, "http://a.org/")]), rules=()).collect()] == [(None, "allow")]


def test_sql_agrees_on_odd_urls(spark, tmp_path):
    pages(spark, ODD[:-4]).select("page_id", "url").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = queries.op11_urls(spark, str(tmp_path))
    key = lambda r: tuple((x is not None, x) for x in r)
    want = con.sql(queries.OP11_SQL).select(*got.columns).fetchall()
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
