"""Main text of web pages: subtrees that recur across many pages of a host are deleted.

Elements' subtrees are hashed, the different pages that have a hash are counted for each host in Spark, and what enough
of the host's pages share is taken for the site's template. What stands on one page only (a rotating advert, readers'
comments, a menu with its own entry marked) cannot be counted: of what is left, elements that say what they are go by
their names, but never running text by a class.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Set

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import stored

#: A subtree belongs to the template if it is on at least so many different pages of its host, and on this share of them.
LEAST_PAGES, LEAST_SHARE = 4, 0.005
#: Article elements, or a main part, are the main text if they have over this share of the text that is left; else all of it
#: is, and what belongs to no text goes by counts and names.
ARTICLE_SHARE = 0.5
#: Where templates are joined by a shuffle, the pages of a host are dealt over so many tasks.
SALTS = 16
#: So many pairs of host and template hash are broadcast at most (16 bytes each); more are joined by a shuffle.
MOST_BROADCAST = 1_000_000

# Names of HTML elements by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea noscript template iframe xmp noembed noframes title".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split())
_FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th tr figcaption caption".split())
_SKIP = frozenset("nav footer aside form button select menu dialog head datalist search svg".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Elements beyond which an open paragraph is not closed by a block.
_SCOPE = frozenset("html table caption td th button object".split())
#: Names of class and id by which an element that is no running text holds no article text.
_FIRM = frozenset(["ad", "ads", "advert", "adverts", "advertisement", "advertisements", "comment", "comments", "commentlist", "disqus", "newsletter", "gdpr", "sponsored"])
#: Names that may as well be a subject: inside an article they do so only with a second sign, links or controls.
_DOUBTFUL = frozenset(["cookie", "cookies", "reply", "replies", "respond", "related", "recommended", "consent", "modal", "popup", "promo"])
#: Words that may stand beside them in one name: `related-posts` is such a name, `related-work` is not.
_BESIDE = frozenset([
    "post", "posts", "article", "articles", "story", "stories", "link", "links", "item", "items", "list", "lists", "box", "block", "section", "area", "container", "wrapper", "wrap", "inner", "outer", "widget", "banner", "bar",
    "slot", "unit", "panel", "content", "body", "header", "footer", "title", "form", "signup", "subscribe", "overlay", "dialog", "notice", "layer", "window", "backdrop", "top", "bottom", "left", "right", "middle", "side",
    "sidebar", "mobile", "desktop", "page", "site", "js", "reader", "readers", "user", "thread", "count", "google", "leaderboard", "skyscraper", "rectangle", "placeholder", "label", "module", "group", "row", "col", "grid", "feed", "more",
])
#: Elements that are filled in or pressed.
_CONTROLS = frozenset(["button", "input", "select", "textarea", "form"])
#: Words of layout: they do so outside articles only, and not on a frame around an article or most of the page.
_LAYOUT = frozenset(
    "advertising adsense adbox banner banners sponsor promotion privacy notice notices notification alert overlay nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars masthead topbar toolbar "
    "header footer colophon subscribe subscription signup login share sharing social recommendations widget widgets pagination pager form search".split()
)
#: What ends an open element of the same list, up to the nearest of the second names.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^\"'>]*")
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|itemprop)(?![^\s=>/])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_END = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.I) for tag in _RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Element:
    """kind: article, main or nothing. named: 2 if its names rule it out, 1 if only words of layout do, 3 if they do so with a
    second sign, else 0. running: whether it carries running text of an article. chars: characters of text in it, linked:
    those in links; controls: elements that are filled in or pressed."""

    __slots__ = ("chars", "controls", "kind", "linked", "named", "open_p", "parent", "parts", "running", "sign", "tag")

    def __init__(self, tag: str, parent: int, kind: str, named: int, running: bool, open_p: int):
        self.tag, self.parent, self.kind, self.named, self.running, self.open_p = tag, parent, kind, named, running, open_p
        self.parts, self.chars, self.sign = [tag.encode("utf-8", "replace")], 0, 0
        self.linked = self.controls = 0

    def out(self) -> bool:
        """Whether its names rule it out, whatever is around it. A second sign is that half of it is links, or a control."""
        return self.named == 2 or self.named == 3 and (self.controls > 0 or 2 * self.linked >= self.chars)


def _called(value: str, words: frozenset) -> bool:
    """Whether one of the names in a class or id is one of the words, alone or beside words that go with it."""
    for name in value.split():
        parts = [p for p in _SPLIT.split(name) if p]
        if any(p in words for p in parts) and all(p in words or p in _FIRM or p in _DOUBTFUL or p in _BESIDE or p.isdigit() for p in parts):
            return True
    return False


def _role(tag: str, attrs: str, inside: bool) -> tuple[str, int]:
    """What an element is, and whether its own names rule it out. A header is no reason inside an article: it has the
    article's own title. Class and id say nothing of running text."""
    kind, named = {"article": "article", "main": "main"}.get(tag, ""), 2 * (tag in _SKIP or tag == "header" and not inside)
    if "=" in attrs or "hidden" in attrs:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "role":
                named = 2 if value in _ROLES else named
                kind = kind or ("main" if value == "main" else "")
            elif name == "itemprop" and value == "articlebody":
                kind = "article"
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                named = 2 if tag not in ("html", "body") else named
            elif name in ("class", "id") and tag in _BLOCK and tag not in _FLOW and tag not in ("html", "body", "main"):
                if _called(value, _FIRM):
                    named = 2
                elif named != 2 and _called(value, _DOUBTFUL):
                    named = 3 if inside else 2
                elif named == 0 and set(_SPLIT.split(value)) & _LAYOUT and not inside and kind != "article":
                    named = 1
    return kind, named


class _Scanner:
    """Tags of a page, one after another. Each character is looked at a bounded number of times, whatever the page."""

    def __init__(self, page: str):
        self.page, self.gone = page, set()

    def _end(self, at: int) -> int:
        """Where a tag whose name ends at `at` has its >; -1 if nowhere. A quote that is never closed is none."""
        page = self.page
        while True:
            at = _PLAIN.match(page, at).end()
            if at == len(page):
                return -1
            if page[at] == ">":
                return at
            quote = page[at]
            close = -1 if quote in self.gone else page.find(quote, at + 1)
            if close < 0:
                self.gone.add(quote)
                at += 1
            else:
                at = close + 1

    def tags(self) -> Iterator[tuple[str, str, str]]:
        """Pairs of the text before a tag and the tag: its name (with / if it ends an element) and its attributes."""
        page, at, begin = self.page, 0, 0
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                yield page[begin:at], "", ""
                begin = at = end + 3 if end >= 0 else len(page)
            elif page.startswith(("<!", "<?"), at):
                end = page.find(">", at)
                yield page[begin:at], "", ""
                begin = at = end + 1 if end >= 0 else len(page)
            elif m := _NAME.match(page, at + 1):
                end = self._end(m.end())
                if end < 0:
                    end = len(page)
                name = m[0].lower()
                yield page[begin:at], name, page[m.end() : end]
                begin = at = min(end + 1, len(page))
                if name in _RAW:
                    close = _END[name].search(page, at)
                    begin = at = close.start() if close else len(page)
            else:
                at += 1
        yield page[begin:], "", ""


def parse(page: str) -> tuple[list[Element], list[list[tuple[int, str]]]]:
    """Elements in the order in which they begin, and blocks of text: pieces, each with the number of its element. The
    first element stands for the page."""
    elements = [Element("", -1, "", 0, False, 0)]
    blocks: list[list[tuple[int, str]]] = [[]]
    stack, where, inside = [0], {}, 0

    def flush() -> None:
        if blocks[-1]:
            blocks.append([])

    def close() -> None:
        nonlocal inside
        number = stack.pop()
        element = elements[number]
        where[element.tag].pop()
        if element.tag in _BLOCK:
            flush()
        element.sign = xxhash.xxh64_intdigest(b"\0".join(element.parts))
        element.parts = ()
        above = elements[element.parent]
        above.parts.append(element.sign.to_bytes(8, "little"))
        above.chars += element.chars
        above.linked += element.linked
        above.controls += element.controls
        inside -= element.kind != ""

    for text, tag, attrs in _Scanner(page).tags():
        if text:
            plain = " ".join(text.split())
            if plain:
                top = elements[stack[-1]]
                top.parts.append(plain.encode("utf-8", "replace"))
                top.chars += len(plain)
                top.linked += len(plain) if where.get("a") else 0
            blocks[-1].append((stack[-1], text))
        if not tag:
            continue
        if tag[0] == "/":
            at = where.get(tag[1:])
            if at:
                least = at[-1]
                while len(stack) > least:
                    close()
            continue
        if tag in _CONTROLS:
            elements[stack[-1]].controls += 1
        if tag in _RAW:
            continue
        if tag in ("br", "td", "th"):
            blocks[-1].append((stack[-1], " "))
        if tag in _BLOCK:
            flush()
            while elements[stack[-1]].open_p:
                close()
        if tag in _VOID:
            continue
        if tag in _ENDS:
            own, fence = _ENDS[tag]
            last = lambda names: max((where[x][-1] for x in names if where.get(x)), default=-1)
            barrier = last(fence)
            first = min((k for x in own for k in where.get(x, ())[-1:] if k > barrier), default=-1)
            while 0 <= first < len(stack):
                close()
        kind, named = _role(tag, attrs, inside > 0)
        above = elements[stack[-1]]
        where.setdefault(tag, []).append(len(stack))
        elements.append(Element(tag, stack[-1], kind, named, inside > 0 and (tag in _FLOW or tag not in _BLOCK), 0 if tag in _SCOPE else above.open_p + (tag == "p")))
        stack.append(len(elements) - 1)
        inside += kind != ""
    while len(stack) > 1:
        close()
    return elements, blocks


def bulk(elements: list[Element]) -> int:
    """The innermost element that has over half of the page's text: pages that have the same one are copies."""
    found = 0
    for k, e in enumerate(elements):
        if e.parent == found and 2 * e.chars > elements[0].chars:
            found = k
    return found


def candidates(elements: list[Element]) -> list[int]:
    """Numbers of the elements that may belong to a template: blocks with text, but no running text of an article, and
    nothing that has over half of the page's text."""
    most = elements[0].chars
    return [k for k, e in enumerate(elements) if e.tag in _BLOCK and e.chars and 2 * e.chars <= most and not e.running and not e.kind and e.tag not in ("html", "body")]


def signatures(page: str) -> tuple[int, list[int]]:
    """As signed longs, the hash of the page's bulk, and those of the subtrees that may belong to a template, each once."""
    elements, _ = parse(page)
    found = np.unique(np.array([elements[k].sign for k in candidates(elements)], np.uint64))
    return int(np.array([elements[bulk(elements)].sign], np.uint64).view(np.int64)[0]), found.view(np.int64).tolist()


def main_text(page: str, template: Set[int]) -> tuple[str, int]:
    """The main text, and the number of subtrees that were deleted because their hash (a signed long) is in the template."""
    elements, blocks = parse(page)
    n = len(elements)
    counted = {k for k in candidates(elements) if (s := elements[k].sign) - (1 << 64 if s >> 63 else 0) in template} if template else set()
    holds = [False] * n  # an article or main part
    for k in range(n - 1, 0, -1):
        holds[elements[k].parent] |= holds[k] or elements[k].kind != "" and not elements[k].out()
    gone, place, deleted = [False] * n, [0] * n, 0
    for k in range(1, n):
        e = elements[k]
        if gone[e.parent]:
            gone[k] = True
        elif k in counted:
            gone[k] = True
            deleted += 1
        else:
            gone[k] = e.out() or e.named == 1 and not holds[k] and 2 * e.chars <= elements[0].chars
        place[k] = max(place[e.parent], {"article": 2, "main": 1}.get(e.kind, 0))
    texts: list[list[str]] = [[], [], []]  # of the whole page, of main parts, of articles
    for pieces in blocks:
        kept = [(at, x) for at, x in pieces if not gone[at]]
        words = " ".join(html.unescape("".join(x for _, x in kept)).split()) if kept else ""
        if words:
            for part in texts[: place[kept[0][0]] + 1]:
                part.append(words)
    size = [sum(map(len, x)) for x in texts]
    wide = 1 if size[1] > ARTICLE_SHARE * size[0] else 0
    chosen = 2 if size[2] > ARTICLE_SHARE * size[wide] else wide
    return "\n\n".join(texts[chosen]), deleted


def template_hashes(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """pages: host (a hash), html. Returns host and, as an array, its template's hashes.

    Each page gives a row for each different subtree; copies of a page count once, and rows are counted with partial
    sums, so a large host costs no task more than others. A host has at most 1 / least_share times as many hashes as its
    pages have subtrees on average.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, of, found = [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if host is not None:
                    own, signs = signatures(page.as_py() or "")
                    hosts += [host] * (len(signs) + 1)
                    of += [own] * (len(signs) + 1)
                    found += [None, *signs]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.int64()), pa.array(of, pa.int64()), pa.array(found, pa.int64())], ["host", "page", "sign"])

    # one row of each page has no sign: their number is the host's
    counted = pages.select("host", "html").mapInArrow(run, "host long, page long, sign long").distinct().groupBy("host", "sign").count()
    counted = stored(counted.filter((F.col("count") >= least_pages) | F.col("sign").isNull()), "subtrees")
    sizes = counted.filter("sign is null").select("host", F.col("count").alias("of"))
    often = counted.filter(F.col("sign").isNotNull() & (F.col("count") >= least_pages)).join(sizes, "host").filter(F.col("count") >= F.col("of") * least_share)
    return often.groupBy("host").agg(F.collect_set("sign").alias("template"))


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars (code points), n_template (subtrees deleted by counts).

    Blocks are joined by two line feeds. Null and empty pages have an empty text; pages without a host in their url have
    no template. Null ids and repeated rows are kept, and repeated pages count once; an empty table gives an empty
    result. Other columns are not looked at. Time and memory for a page grow in proportion to its length.
    """
    host = F.regexp_extract(F.col(url_col), _HOST, 1)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.when(host != "", F.xxhash64(F.lower(host))).alias("host"), F.col(html_col).cast("string").alias("html"))
    templates = stored(template_hashes(rows, least_pages, least_share), "templates")
    small = templates.agg(F.coalesce(F.sum(F.size("template") + 1), F.lit(0))).first()[0]
    if small <= MOST_BROADCAST:
        joined = rows.join(F.broadcast(templates), "host", "left")
    else:
        salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = salted.join(templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict = {}  # templates of hosts met lately
        for batch in batches:
            found = []
            for k, (page, host) in enumerate(zip(batch.column(2), batch.column(4).to_pylist(), strict=True)):
                if host not in met:
                    if len(met) >= 100:
                        met.clear()
                    met[host] = frozenset(batch.column(3)[k].as_py() or ())
                found.append(main_text(page.as_py() or "", met[host]))
            texts, deleted = [x for x, _ in found], [n for _, n in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(deleted, pa.int64())], ["page_id", "url", "text", "n_chars", "n_template"])

    kind = dict(rows.dtypes)
    return joined.select("page_id", "url", "html", "template", "host").mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long, n_template long")
