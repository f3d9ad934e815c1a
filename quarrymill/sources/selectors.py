"""Fields of a page by CSS selectors: the page becomes a tree once, and compiled selectors are matched on it.

Selectors: tag, `*`, `#id`, `.class`, `[attr]`, `[attr=v]` and with `~= |= ^= $= *=`, `:first-child`, `:last-child`,
`:only-child`, `:nth-child(an+b | odd | even)`, `:not(...)` of those, joined by descendant (space), child (`>`), next (`+`)
and later sibling (`~`), and lists by comma.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])
#: What the begin of an element ends, up to the nearest of the elements that hold it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
#: What ends a paragraph.
BLOCKS = frozenset(["address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"])


@dataclass(eq=False)
class Node:
    tag: str
    attrs: dict[str, str]
    parent: Node | None
    at: int = 0
    children: list[Node] = field(default_factory=list)
    parts: list = field(default_factory=list)

    def text(self, white: re.Pattern = re.compile(r"\s+")) -> str:
        """Without scripts and styles, white space as one space."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x is self or x.tag not in ("script", "style"):
                todo.extend(reversed(x.parts))
        return white.sub(" ", "".join(out)).strip(" ")


class _Builder(HTMLParser):
    """mark: what stands for `&`, so that the parser decodes nothing; references: what texts then have decoded."""

    def __init__(self, mark: str | None = None, references: Mapping[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.mark, self.references = mark, references or {}
        self.named = re.compile("&(" + "|".join(self.references) + ");")
        self.root = self.open = Node("", {}, None)
        self.all: list[Node] = []

    def handle_starttag(self, tag, attrs):
        ends, within = CLOSES.get(tag, (set(), set()))
        if tag in BLOCKS:
            ends, within = {"p"}, {"div", "article", "section", "td", "li", "body", "main"}
        x = self.open
        while ends and x.parent is not None and x.tag not in within:
            if x.tag in ends:
                self.open = x.parent
            x = x.parent
        node = Node(tag, {k: self._written(v or "") for k, v in reversed(attrs)}, self.open, len(self.open.children))
        self.open.children.append(node)
        self.open.parts.append(node)
        self.all.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        x = self.open
        while x.parent is not None and x.tag != tag:
            x = x.parent
        if x.parent is not None:
            self.open = x.parent

    def handle_data(self, data):
        self.open.parts.append(self.named.sub(lambda m: self.references.get(m[1], m[0]), self._written(data)) if self.mark else data)

    def _written(self, said):
        return said.replace(self.mark, "&") if self.mark else said


def tree(page: str, references: Mapping[str, str] | None = None) -> list[Node]:
    """All elements of a page in its order. With references (a name and what it stands for), texts have only these decoded,
    if they end in a semicolon, and attributes are as written; else all references of HTML are decoded."""
    mark = None if references is None else next(c for c in map(chr, range(0xFDD0, 0x110000)) if c not in page)
    builder = _Builder(mark, references)
    builder.feed(page.replace("&", mark) if mark else page)
    builder.close()
    return builder.all


Test = Callable[[Node], bool]
_SIMPLE = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*|\*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<q>[^"]*)"|'(?P<a>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]|:not\((?P<no>[^()]*(?:\([^()]*\))?[^()]*)\)|:(?P<pseudo>[\w-]+)(?:\((?P<arg>[^)]*)\))?""",
)
_OPS = {
    "=": lambda v, x: v == x, "~=": lambda v, x: x != "" and x in v.split(), "|=": lambda v, x: v == x or v.startswith(x + "-"),
    "^=": lambda v, x: x != "" and v.startswith(x), "$=": lambda v, x: x != "" and v.endswith(x), "*=": lambda v, x: x != "" and x in v,
}


def _nth(arg: str) -> Test:
    arg = {"odd": "2n+1", "even": "2n"}.get(arg.strip(), arg.replace(" ", ""))
    m = re.fullmatch(r"(?:([+-]?\d*)n)?([+-]?\d+)?", arg)
    if not m or not arg:
        raise ValueError(f"no position: {arg}")
    step = 0 if m[1] is None else int(m[1] + "1") if m[1] in ("", "+", "-") else int(m[1])
    first = int(m[2] or 0)
    return lambda n: (n.at + 1 == first) if step == 0 else (n.at + 1 - first) % step == 0 and (n.at + 1 - first) // step >= 0


def compound(text: str) -> Test:
    """A test of one element."""
    tests: list[Test] = []
    end = 0
    for m in _SIMPLE.finditer(text):
        if m.start() != end:
            break
        end = m.end()
        if m["tag"]:
            if m["tag"] != "*":
                tests.append(lambda n, t=m["tag"].lower(): n.tag == t)
        elif m["id"]:
            tests.append(lambda n, x=m["id"]: n.attrs.get("id") == x)
        elif m["cls"]:
            tests.append(lambda n, x=m["cls"]: x in n.attrs.get("class", "").split())
        elif m["attr"]:
            want, name = m["q"] if m["q"] is not None else m["a"] if m["a"] is not None else m["bare"], m["attr"].lower()
            tests.append((lambda n, k=name: k in n.attrs) if m["op"] is None else (lambda n, k=name, f=_OPS[m["op"]], x=want: k in n.attrs and f(n.attrs[k], x)))
        elif m["no"] is not None:
            tests.append(lambda n, f=compound(m["no"].strip()): not f(n))
        elif m["pseudo"] == "first-child":
            tests.append(lambda n: n.at == 0)
        elif m["pseudo"] == "last-child":
            tests.append(lambda n: n.at == len(n.parent.children) - 1)
        elif m["pseudo"] == "only-child":
            tests.append(lambda n: len(n.parent.children) == 1)
        elif m["pseudo"] == "nth-child":
            tests.append(_nth(m["arg"] or ""))
        else:
            raise ValueError(f"not known: {m[0]}")
    if end != len(text) or not text:
        raise ValueError(f"no selector: {text}")
    return lambda n: all(f(n) for f in tests)


_STEP = re.compile(r"""\s*([>+~])\s*|\s+(?![>+~])""")


def _steps(text: str) -> list[str]:
    """Compounds and, between them, what joins them; marks inside brackets do not."""
    hidden = re.sub(r"\[[^\]]*\]|\([^()]*(?:\([^()]*\))?[^()]*\)", lambda m: "\0" * len(m[0]), text)
    out, at = [], 0
    for m in _STEP.finditer(hidden):
        out += [text[at : m.start()], m[1] or " "]
        at = m.end()
    return [*out, text[at:]]


def _split(text: str) -> list[str]:
    hidden = re.sub(r"\[[^\]]*\]|\([^()]*(?:\([^()]*\))?[^()]*\)", lambda m: "\0" * len(m[0]), text)
    ends = [-1, *[m.start() for m in re.finditer(",", hidden)], len(text)]
    return [text[a + 1 : b].strip() for a, b in zip(ends, ends[1:], strict=False)]


def compiled(selector: str) -> Test:
    """Whether an element is one that the selector means."""
    chains = []
    for part in _split(selector):
        steps = _steps(part)
        chains.append(([compound(s) for s in steps[::2]], steps[1::2]))

    def fits(n: Node, tests: list[Test], joins: list[str], k: int) -> bool:
        if not tests[k](n):
            return False
        if k == 0:
            return True
        join, up = joins[k - 1], n.parent
        if join == ">":
            return up.parent is not None and fits(up, tests, joins, k - 1)
        if join == "+":
            return n.at > 0 and fits(up.children[n.at - 1], tests, joins, k - 1)
        if join == "~":
            return any(fits(x, tests, joins, k - 1) for x in up.children[: n.at])
        while up.parent is not None:
            if fits(up, tests, joins, k - 1):
                return True
            up = up.parent
        return False

    return lambda n: any(fits(n, tests, joins, len(tests) - 1) for tests, joins in chains)


def _field(spec: str) -> tuple[Test, str | None]:
    """`selector` gives texts, `selector @attr` an attribute."""
    m = re.fullmatch(r"(.*?)(?:\s*@([\w:-]+))?", spec.strip(), re.DOTALL)
    return compiled(m[1].strip()), m[2]


def selected(page: Column, fields: dict[str, str], references: Mapping[str, str] | None = None) -> Column:
    """struct<field: array<string>>: of each field the texts of all elements that its selector means, in the page's order;
    or, for `selector @attr`, that attribute where there is one. A null page has empty arrays.

    With references only these are decoded (see `tree`), and white space is what HTML calls so: other spaces stay."""
    for spec in fields.values():
        _field(spec)

    @F.pandas_udf(", ".join(f"`{name}` array<string>" for name in fields))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tests = {name: _field(spec) for name, spec in fields.items()}
        white = re.compile(r"\s+" if references is None else r"[ \t\n\f\r]+")
        for pages in batches:
            rows = []
            for text in pages:
                nodes = tree(text, references) if text else []
                rows.append({name: [n.text(white) if attr is None else n.attrs[attr] for n in nodes if test(n) and (attr is None or attr in n.attrs)] for name, (test, attr) in tests.items()})
            yield pd.DataFrame(rows, columns=list(fields))

    return run(page)
