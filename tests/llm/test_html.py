"""Main text of pages: by counts of subtrees, by names, and on odd and very long pages."""

import collections
import random
import re
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from quarrymill.llm import html


def text(page, template=()):
    return html.main_text(page, set(template))[0]


def test_main_text_of_an_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <nav><a href="/">Home</a></nav><!-- ad --><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>One<br>two<p>Three &eacute;&#233;&nbsp;x</p>
    <ul><li>a<li>b</ul><div class="newsletter">Sign</div><form>f</form></article><section id="comments"><p>C</p></section><footer>F</footer></body></html>"""
    assert text(page) == "Head & line\n\nOne two\n\nThree éé x\n\na\n\nb"
    assert text("") == "" and text("plain <b>text") == "plain text"
    frame = "<div class='page with-sidebar'><div class=menu>M</div><article><header class='article-header'><h1>H</h1></header><p>t</p></article><div class=comments><article>c</article></div></div>"
    assert text(frame) == "H\n\nt"
    assert text("<section class=comments><article>c</article></section><p>t") == "t"
    assert text("<article hidden>x</article><article><p>y</article>") == "y"


def test_running_text_stays_whatever_its_class():
    assert text('<article><div class="search-results">body text</div><p class="form">hello</p><math><mi>x</mi></math></article>') == "body text\n\nhello\n\nx"
    assert text('<p id="skip-intro">intro paragraph</p>') == "intro paragraph"
    assert text("<p>a <a class=share href=x>link</a> b</p>") == "a link b"


def test_articles_that_are_not_the_main_text():
    long = "<main><h1>T</h1><p>a long text of many words here</p></main>"
    assert text(long + '<article class="related"><p>teaser</p></article>') == "T\n\na long text of many words here"
    assert text("<main>" + long[6:-7] + "<article><p>teaser</p></article></main>") == "T\n\na long text of many words here\n\nteaser"
    assert text("<article></article><p>x") == "x"
    assert text('<article>a b c d e f<article class="comment">c</article></article>') == "a b c d e f"


def test_no_main_text_goes_with_a_short_article():
    """An article of 30 % is no reason to drop the seven sentences beside it, nor a main part of a third the rest."""
    said = [f"Sentence {k} of the main text is here." for k in range(7)]
    main = "<main>" + "".join(f"<p>{s}</p>" for s in said) + f"<article><p>{'teaser ' * 15}</p></article></main>"
    got = text(main + "<footer>f</footer>")
    assert all(s in got for s in said) and "f" != got[-1]
    got = text("<div>" + "".join(f"<p>{s}</p>" for s in said) + "</div><main><p>" + "aside " * 16 + "</p></main>")
    assert all(s in got for s in said)
    article = "<article>" + "".join(f"<p>{s}</p>" for s in said) + "</article><div>unnamed and short</div>"
    assert text(article) == "\n\n".join(said)


@pytest.mark.parametrize("name", ["related-work", "modal-verbs", "informed-consent", "ad-hoc-networks", "promo-code-list", "consent", "related", "cookies", "cookie-recipes", "commentary", "adds", "replies-to-critics"])
def test_subjects_are_no_furniture(name):
    for kind in ("class", "id"):
        assert text(f'<article><p>begin</p><section {kind}="{name}"><h2>h</h2><p>what it says</p></section><div {kind}="{name}">more</div></article>') == "begin\n\nh\n\nwhat it says\n\nmore"


@pytest.mark.parametrize("name", ["ad", "ads", "ad-slot", "ad_unit-3", "comments", "comment-list", "newsletter-signup", "x sponsored", "advertisement"])
def test_furniture_goes_inside_articles(name):
    assert text(f'<article><p>begin</p><div class="{name}">go away</div></article>') == "begin"


@pytest.mark.parametrize("name", ["related", "related-posts", "modal", "cookie-banner", "promo-box", "recommended-articles"])
def test_doubtful_names_go_with_a_second_sign(name):
    assert text(f'<article><p>begin</p><div class="{name}"><a href="/x">other page</a> and</div></article>') == "begin"
    assert text(f'<article><p>begin</p><div class="{name}">we ask <button>ok</button></div></article>') == "begin"
    assert text(f'<article><p>begin</p><div class="{name}">running words of the article <a href=x>y</a></div></article>') == "begin\n\nrunning words of the article y"
    assert text(f'<article><p>begin</p></article><div class="{name}">outside</div>') == "begin"


def test_paragraphs_and_items_end_where_they_should():
    assert text("<p>a<div>b</div>c<p>d<table><tr><td><p>e<td>f</table>g") == "a\n\nb\n\nc\n\nd\n\ne\n\nf\n\ng"
    assert text("<p>" + "<b>" * 9 + "x<div>y</div>") == "x\n\ny"
    assert text("a < b <3 &lt;c <a title='x > y'>d</a>") == "a < b <3 <c d"


LONG = {
    "open elements": "<div>a" * 170_000, "open tags": "<a " * 350_000, "quotes": '<a ">' * 150_000 + "<a '>x" * 100_000, "ends of nothing": "<div>" * 80_000 + "</p>" * 80_000, "rows of no table": "<div>" * 80_000 + "<tr></tr>" * 60_000,
    "signs": "<" * 1_000_000, "comments": "<!--" * 250_000, "lists": "<ul><li>" * 100_000, "scripts": "<script>" * 100_000, "paragraphs": "<p>x" * 200_000, "attributes": "<a " + "class=" * 160_000 + ">",
}


@pytest.mark.parametrize("name", LONG)
def test_a_megabyte_takes_seconds(name):
    begin = time.process_time()
    html.main_text(LONG[name], {1})
    html.signatures(LONG[name])
    assert time.process_time() - begin < 20


def site(rng, n):
    """Pages with a menu, a notice that is not named and a frame, and paragraphs that articles share."""
    shared = "<p>licensed to all</p>"
    rows = []
    for k in range(n):
        own = " ".join(f"w{rng.randrange(900)}" for _ in range(60))
        notice = "<div class=x1><p>we use your data</p></div>" if k % 3 else ""
        body = f"<div><ul><li>one<li>two</ul></div>{notice}<div class=c><article><h1>t{k}</h1><p>{own}</p>{shared}<section><div>more of this site</div></section></article></div><div>page {k}</div>"
        rows.append((k, f"https://u@h.example:80/{k}", f"<html><body>{body}</body></html>"))
    return rows + [(n + k, "https://H.example/copy", rows[0][2]) for k in range(5)] + [(n + 9, "https://other.example/", rows[0][2]), (n + 10, None, rows[0][2]), (n + 11, "x", None), (None, "https://h.example/", "")]


def plain_counts(pages):
    """Of each host, how many different pages have each possible subtree: by the texts and names of elements, not by hashes."""
    seen = collections.defaultdict(lambda: collections.defaultdict(set))
    for _, url, page in pages:
        if url and "//" in url:
            elements, _ = html.parse(page or "")
            children = collections.defaultdict(list)
            for k, e in enumerate(elements):
                children[e.parent].append(k)
            spell = lambda k, elements=elements, children=children: (elements[k].tag, elements[k].chars, tuple(spell(c) for c in children[k]), elements[k].sign)
            for k in html.candidates(elements):
                seen[url.split("/")[2].split("@")[-1].split(":")[0].lower()][spell(k)].add(page)
    return {host: collections.Counter({s: len(p) for s, p in found.items()}) for host, found in seen.items()}


def test_counts_decide(spark):
    pages = site(random.Random(1), 40)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "sign": F.lit(1), "template": F.lit("t")})
    counts = plain_counts(pages)
    want = {s[-1] for s, n in counts["h.example"].items() if n >= html.LEAST_PAGES}
    rows = df.select(F.when(F.col("url").rlike("[hH].example"), F.lit(1).cast("long")).alias("host"), "html")
    got = {s & (1 << 64) - 1 for r in html.template_hashes(rows.filter("host = 1")).collect() for s in r.template}
    assert got == want and len(want) >= 5
    out = {r.page_id: r for r in html.extract(df).collect()}
    assert len(out) == len(pages) and out[3].n_template >= 2
    # what recurs goes, running text of an article and what is a page's own stay
    assert "licensed to all" in out[3].text and "more of this site" not in out[3].text and "more of this site" in out[49].text
    assert out[3].n_chars == len(out[3].text) and out[51].text == out[None].text == "" and out[50].text == out[49].text
    assert html.extract(df.limit(0)).collect() == []


def test_whole_pages_without_names(spark):
    """Without an article or a name, only counts can tell."""
    rows = [(k, f"http://h.example/{k}", f"<div><div>home about</div><div><p>text {k} of its own and some more words</p></div><div>all rights kept</div></div>") for k in range(12)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.text for r in got) == sorted(f"text {k} of its own and some more words" for k in range(12)) and all(r.n_template == 2 for r in got)


def test_templates_joined_by_a_shuffle(spark, monkeypatch):
    df = spark.createDataFrame(site(random.Random(2), 20), "page_id long, url string, html string")
    want = sorted(map(str, html.extract(df).collect()))
    monkeypatch.setattr(html, "MOST_BROADCAST", 0)
    assert sorted(map(str, html.extract(df).collect())) == want


def test_pages_made_of_known_parts():
    """Main blocks and furniture put together at random: what comes out are the main blocks, in their order."""
    rng = random.Random(12)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps&amp;lon", "zeta\n  eta", "<b>theta</b>", "<a href=/x>iota</a>", "kappa<!-- x -->"]) for _ in range(n))
    plain = lambda x: re.sub(r"\s+", " ", re.sub(r"<!--.*?-->|</?[ab](?: [^>]*)?>", "", x).replace("&amp;", "&")).strip()
    furniture = [
        "<nav><ul><li><a href=/>home</a></li></ul></nav>", "<header><div>site name</div></header>", "<footer>all rights</footer>", "<aside><p>beside</p></aside>", "<form><input><button>send</button></form>", "<script>var a = '<p>no</p>'</script>",
        "<style>p{}</style>", "<div class='ad'>buy</div>", "<div id=comments><p>first!</p></div>", "<div class='x cookie-notice'>we use cookies <button>ok</button></div>", "<div class=sidebar><p>side</p></div>", "<div class='related-posts'><a href=1>one</a></div>",
    ]
    for _ in range(300):
        want, body = [], []
        for _ in range(rng.randrange(2, 8)):
            x = words(rng.randrange(3, 30))
            tag = rng.choice(["p", "h2", "blockquote", "li"])
            body.append(f"<ul><li>{x}</li></ul>" if tag == "li" else f"<{tag}>{x}</{tag}>")
            want.append(plain(x))
        inside = rng.choice(["<div class='ad-slot'>buy now</div>", "<div class=newsletter><form>join</form></div>", "", ""])
        body.insert(rng.randrange(len(body)), inside)
        frame = rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<div role=main>{}</div>", "<div class=page><div>{}</div></div>"])
        around = [rng.choice(furniture) for _ in range(rng.randrange(6))]
        at = rng.randrange(len(around) + 1)
        page = "<html><head><title>t</title></head><body>" + "".join(around[:at]) + frame.format("".join(body)) + "".join(around[at:]) + "</body></html>"
        assert text(page) == "\n\n".join(want), page


def test_articles_of_all_pages_by_regular_expressions(spark):
    """The table's pages are plain enough to be cut by expressions alone."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r.page_id: r.text for r in html.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()}
    same = 0
    for r in rows:
        m = re.search(r"<article>(.*?)</article>", re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1>", "", r.html or ""), re.S)
        if m:
            cut = re.sub(r"</?(?:p|h1|h2|h3|ul|ol|li|div|section|blockquote|table|tr)\b[^>]*>", "\n\n\n", re.sub(r"<(?:br|td|th)\b[^>]*>", " ", m[1]))
            blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in cut.split("\n\n\n")]
            same += got[r.page_id] == "\n\n".join(b for b in blocks if b)
    assert same >= 0.98 * len(rows)
