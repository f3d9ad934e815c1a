"""Selectors, nested maps, known keys and named extractors."""

import json
from html.parser import HTMLParser
from xml.etree import ElementTree

import duckdb
import pytest
from pyspark.sql import functions as F

from quarrymill.operators import known
from quarrymill.plans import pages as plans
from quarrymill.sources import maps, named
from quarrymill.sources import selectors as S

DATA = "/root/testdata/sf0.001"
PAGE = """<html><head><title>T &amp; t</title></head><body><div id="a" class="card big" data-k="x-1"><h2>One</h2><p class="t">p <b>1</b></p><p>p2</p></div>
<div class="card" lang="en-GB"><ul><li>1</li><li class="t u">2</li><li>3</li><li>4</li></ul><a href="/x.html">x</a><a href="https://y">y</a><a>z</a></div><p>last</p></body></html>"""


class Plain(HTMLParser):
    """The path, attributes and text of each element, by a list of open ones alone: for pages that end what they begin."""

    def __init__(self):
        super().__init__()
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs):
        self.open.append([tag, dict(attrs), ""])
        self.found.append(([x[0] for x in self.open], self.open[-1], list(self.open)))
        if tag in S.VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        if any(x[0] == tag for x in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for x in self.open:
            x[2] += data


@pytest.mark.parametrize(
    ("selector", "want"),
    [
        ("title", ["T & t"]), (".card", ["One p 1 p2", "1 2 3 4 x y z"]), ("div.card.big", ["One p 1 p2"]), ("#a > p", ["p 1", "p2"]), ("div p", ["p 1", "p2"]), ("body > p", ["last"]), ("li:first-child", ["1"]),
        ("li:last-child, h2", ["One", "4"]), ("li:nth-child(2n)", ["2", "4"]), ("li:nth-child(odd)", ["1", "3"]), ("li:nth-child(-n+2)", ["1", "2"]), ("li:not(.t)", ["1", "3", "4"]), ("li.t + li", ["3"]), ("li.t ~ li", ["3", "4"]),
        ("[data-k^=x]", ["One p 1 p2"]), ("[lang|='en'] a[href$='.html']", ["x"]), ("a[href*=\"//\"]", ["y"]), ("a:not([href])", ["z"]), ("[class~=u]", ["2"]), ("b:only-child", ["1"]), ("* > b", ["1"]), ("DIV H2", ["One"]), (".car", []), ("p > p", []),
    ],
)
def test_selectors(selector, want):
    test = S.compiled(selector)
    got = [n.text() for n in S.tree(PAGE) if test(n)]
    assert [" ".join(x.split()) for x in got] == [" ".join(x.split()) for x in want] or [x.replace(" ", "") for x in got] == [x.replace(" ", "") for x in want]


def test_like_another_parser_on_whole_pages():
    """Paths of ElementTree on a page that is well formed."""
    root = ElementTree.fromstring(PAGE)
    for css, path in (("body div p", ".//div//p"), ("div > p", ".//div/p"), ("li", ".//li"), ("ul > li.t", ".//ul/li[@class='t u']"), ("div a[href='/x.html']", ".//a[@href='/x.html']"), ("[class='card']", ".//*[@class='card']")):
        test = S.compiled(css)
        assert [n.text() for n in S.tree(PAGE) if test(n)] == [" ".join("".join(x.itertext()).split()) for x in root.findall(path)]


@pytest.mark.parametrize("bad", ["", "div >", "a[", ":hover", "p:nth-child(x)", "a..b"])
def test_bad_selectors(bad):
    with pytest.raises(ValueError):
        S.compiled(bad)


def test_open_elements_are_closed():
    nodes = S.tree("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table><p>x<p>y<div>z</div></b><br>w")
    paths = [f"{n.parent.tag}>{n.tag}" for n in nodes]
    assert paths == [">ul", "ul>li", "ul>li", "li>ul", "ul>li", "ul>li", ">table", "table>tr", "tr>td", "tr>td", "table>tr", "tr>td", ">p", ">p", ">div", ">br"]
    assert [n.text() for n in nodes if n.tag == "li"] == ["a", "bc", "c", "d"]


def test_all_pages(spark):
    """Fifteen selectors over all pages against elements and their paths."""
    fields = {
        "a": ("nav a", lambda p, x, o: p[-1] == "a" and "nav" in p[:-1]), "b": ("nav > ul > li", lambda p, x, o: p[-3:] == ["nav", "ul", "li"]), "c": ("h1", lambda p, x, o: p[-1] == "h1"), "d": ("article > h1", lambda p, x, o: p[-2:] == ["article", "h1"]),
        "e": ("[class]", lambda p, x, o: "class" in x[1]), "f": ("div.ad", lambda p, x, o: p[-1] == "div" and "ad" in (x[1].get("class") or "").split()), "g": ("head > title", lambda p, x, o: p[-2:] == ["head", "title"]),
        "h": ("a[href^='/']", lambda p, x, o: p[-1] == "a" and (x[1].get("href") or "").startswith("/")), "i": ("html[lang]", lambda p, x, o: p[-1] == "html" and "lang" in x[1]), "j": ("meta[charset=utf-8]", lambda p, x, o: p[-1] == "meta" and x[1].get("charset") == "utf-8"),
        "k": ("html footer", lambda p, x, o: p[-1] == "footer" and "html" in p[:-1]), "l": ("script, style", lambda p, x, o: p[-1] in ("script", "style")), "m": ("body > nav", lambda p, x, o: p[-2:] == ["body", "nav"]),
        "n": ("nav li > a[href]", lambda p, x, o: p[-2:] == ["li", "a"] and "nav" in p and "href" in x[1]), "o": ("article h1, article h2", lambda p, x, o: p[-1] in ("h1", "h2") and "article" in p[:-1]),
    }
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r.x for r in pages.select("page_id", S.selected(F.col("html"), {k: v[0] for k, v in fields.items()}).alias("x")).collect()}
    total = 0
    for page in pages.collect():
        plain = Plain()
        plain.feed(page.html or "")
        for name, (_, fits) in fields.items():
            want = sum(1 for p, x, o in plain.found if fits(p, x, o))
            total += want
            assert len(got[page.page_id][name]) == want, (page.page_id, name)
    assert total > 500


def test_fields_of_odd_pages(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<p>a<p>b"), (4, "<div>" * 3000 + "x" + "</div>" * 3000), (5, "<a href='1'>x</a><a>y</a>")], "k int, h string")
    got = {r.k: r.x for r in rows.select("k", S.selected(F.col("h"), {"p": "p", "d": "div > div", "a": "a @href"}).alias("x")).collect()}
    assert [tuple(got[k]) for k in (1, 2, 3)] == [([], [], []), ([], [], []), (["a", "b"], [], [])]
    assert len(got[4].d) == 2999 and got[5].a == ["1"]


def test_page_fields_as_by_sql(spark, tmp_path):
    """Only lt, gt and amp with a semicolon are decoded, in titles alone; other spaces than HTML's are cut off at the ends and stay within; a null page."""
    head = "<html><head><title>{}</title><meta charset='utf-8'></head><body><nav><ul><li><a href=\"{}\">x</a></li></ul></nav></body></html>"
    said = ["a &amp; b &lt;c&gt;", "a&amp", "&quot;a&#39; &auml; &nbsp;b", "&amp;lt; &amp;amp; &&gt;", " \u00a0a\n\t b\u00a0\u00a0c \u2003", "\ufdd0 &amp;&"]
    pages = [(k, head.format(x, f"/{k}?a=1&amp;b={k}&lt")) for k, x in enumerate(said)] + [(10, None), (11, "")]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, plans.page_fields(spark, str(tmp_path)).collect()))
    with duckdb.connect() as con:
        con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
        assert got == sorted(con.execute(plans.SQL["page_fields"]).fetchall())
    assert [r[1] for r in got] == ["a & b <c>", "a&amp", "&quot;a&#39; &auml; &nbsp;b", "&lt; &amp; &>", "a b\u00a0\u00a0c", "\ufdd0 &&", None, ""]


def test_maps_to_a_depth_and_in_circles(spark):
    index = lambda *to: "<sitemapindex>" + "".join(f"<sitemap><loc>\n {t}</loc></sitemap>" for t in to) + "</sitemapindex>"
    urls = lambda *to: "<urlset>" + "".join(f"<url><loc>{t} </loc></url>" for t in to) + "</urlset>"
    docs = [("r", index("i1", "m0", "r")), ("m0", urls("u0", "u0"))] + [(f"i{k}", index(f"i{k + 1}", f"m{k}", "i1")) for k in range(1, 9)] + [(f"m{k}", urls(f"u{k}", "both")) for k in range(1, 9)] + [("alone", urls("a")), ("empty", index())]
    docs, roots = spark.createDataFrame(docs, "url string, xml string"), spark.createDataFrame([("r",), ("alone",), ("gone",), ("empty",)], "root string")
    got = sorted(map(tuple, maps.nested(docs, roots, 5).collect()))
    assert got == sorted([("alone", "a", 0), ("r", "both", 2), ("r", "u0", 1)] + [("r", f"u{k}", k + 1) for k in range(1, 5)])
    assert maps.nested(docs, roots, 1).filter("root = 'r'").collect() == [("r", "u0", 1)]
    assert maps.nested(docs, roots, 0).collect() == [("alone", "a", 0)]


def test_no_known_key_is_lost(spark, tmp_path):
    old = spark.range(0, 200_000, 2).select(F.col("id").alias("k"), F.lit(1).alias("at"), F.lit(1).alias("n"))
    new = spark.range(100_000).select(F.when(F.col("id") % 1000 != 7, F.col("id")).alias("k"), F.lit(2).alias("at"))
    known.build(old, ["k"], str(tmp_path))
    assert new.join(old, "k", "left_semi").count() == known.maybe_known(spark, new, ["k"], str(tmp_path)).filter("maybe and k % 2 = 0").count()
    fresh, again = known.split(new, old, ["k"], str(tmp_path))
    assert again.filter("k % 2 <> 0").count() == 0 and again.count() == 50_000 and fresh.count() == 50_000
    # of those that are new few reach the join
    assert known.maybe_known(spark, new.filter("k % 2 <> 0"), ["k"], str(tmp_path)).filter("maybe").count() < 0.02 * 49_900
    assert known.refreshed(old, again, ["k"], "at", "n").groupBy("at", "n").count().orderBy("at").collect() == [(1, 1, 50_000), (2, 2, 50_000)]
    known.build(old.limit(0), ["k"], str(tmp_path / "none"))
    fresh, again = known.split(new, old.limit(0), ["k"], str(tmp_path / "none"))
    assert (fresh.count(), again.count()) == (100_000, 0)


def test_named_extractors(spark, tmp_path):
    named.register(spark)
    (tmp_path / "csv").mkdir()
    for k in range(3):
        (tmp_path / f"csv/{k}.csv").write_text("a,b\n" + "".join(f"{10 * k + i},x{i}\n" for i in range(4)) + ",none\n")
    (tmp_path / "csv/_hidden").write_text("no")
    read = spark.read.format("extracted").schema("a long, b string, c double").option("extractor", "csv").load(str(tmp_path / "csv"))
    assert read.rdd.getNumPartitions() == 3 and read.count() == 15 and read.filter("a = 21").collect() == [(21, "x1", None)] and read.filter("a is null").count() == 3
    (tmp_path / "rpc").mkdir()
    (tmp_path / "rpc/1.json").write_text(json.dumps({"result": [{"a": 1, "b": "x"}, {"a": 2}]}))
    assert sorted(map(tuple, spark.read.format("extracted").schema("a long, b string").option("extractor", "rpc").load(str(tmp_path / "rpc")).collect()), key=repr) == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="no extractor"):
        spark.read.format("extracted").schema("a long").option("extractor", "other").load(str(tmp_path / "rpc")).collect()
    with pytest.raises(ValueError):
        named.add("csv", named.comma_rows)


def test_pages_outside_a_filter_are_not_opened(spark, tmp_path):
    named.register(spark)
    folder = str(tmp_path / "pages")
    rows = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartitionByRange(5, "k")
    put = lambda df, mode: df.write.format("extracted").option("key", "k").option("page", 100).mode(mode).save(folder)
    put(rows, "append")
    read = lambda: spark.read.format("extracted").schema("k long, v string").option("key", "k").load(folder)
    assert read().count() == 1000 and read().rdd.getNumPartitions() >= 10
    few = read().filter("k >= 250 and k < 260")
    assert few.count() == 10 and few.rdd.getNumPartitions() <= 2
    # what never committed is not read
    (tmp_path / "pages/page-left.jsonl").write_text('{"k": 1, "v": "x"}\n')
    put(spark.createDataFrame([(5000, "new"), (None, "none")], "k long, v string"), "append")
    assert read().count() == 1002 and read().filter("k = 5000").collect() == [(5000, "new")] and read().filter("k is null").count() == 1
    put(spark.createDataFrame([(1, "only")], "k long, v string"), "overwrite")
    assert read().collect() == [(1, "only")]
