"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import let


@dataclass(frozen=True)
class Kind:
    """pattern: possessive throughout, so that no text makes it backtrack; it starts where a run starts, or where the
    last match ended (\\G). score: of a span that the check has confirmed; `near` words add to it. Kinds that are not
    base are reported from LEAST_SCORE on."""

    name: str
    pattern: str
    check: callable
    score: float
    near: str
    base: bool = True


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _ip(span: Column) -> Column:
    return F.forall(F.split(span, r"\."), lambda part: part.cast("double") <= 255)


def _card(span: Column) -> Column:
    n = F.length(_digits(span))
    return (n >= 14) & (n <= 19) & F.call_function("luhn_check", _digits(span))


def _phone(span: Column) -> Column:
    n = F.length(_digits(span))
    return (n >= 10) & (n <= 15)


def _iban(span: Column) -> Column:
    """Mod-97: the first four characters go last, letters count from 10, the number leaves 1."""
    plain = F.regexp_replace(span, " ", "")
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    codes = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda k: F.ascii(F.substr(turned, k, F.lit(1))))
    value = F.when(F.size(codes) >= 15, F.aggregate(codes, F.lit(0), lambda a, c: F.when(c < 65, (a * 10 + c - 48) % 97).otherwise((a * 100 + c - 55) % 97)))
    return F.coalesce(value == 1, F.lit(False))


def _any(span: Column) -> Column:
    return F.lit(True)


LEAST_SCORE = 0.5
#: Code points before and after a span where `near` words count, and what they add.
BEFORE, AFTER, ADDED = 48, 24, 0.3

KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.7, "e-?mail|mail|contact|write to"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 0.5, "ip|host|server|addr"),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9]++(?:[ -][0-9]++)*+", _card, 0.7, "card|visa|master|amex|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", _phone, 0.6, "phone|tel|call|mobile|fax|cell"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban, 0.8, "iban|account|bank|konto", False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", _any, 0.3, "ssn|social security|tax id", False),
]

#: Prefix sums are taken in blocks of this length, so that they cost little more than the number of spans.
BLOCK = 256


def _running_sums(steps: Column) -> Column:
    """Of a non-empty array of numbers, the sum up to and with each."""
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x)
    at = lambda i: F.floor(i / F.lit(BLOCK)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), at(F.size(steps) - 1)), lambda b: total(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    return let(
        blocks,
        lambda sums: let(
            F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b))),
            lambda ahead: F.transform(steps, lambda _, i: F.get(ahead, at(i)) + total(F.slice(steps, at(i) * BLOCK + 1, i - at(i) * BLOCK + 1))),
        ),
    )


def _confirmed(kind: Kind, span: Column, before: Column, after: Column) -> Column:
    """The score of a span, null if its check fails or the score is too low."""
    around = F.lower(F.concat(F.right(before, F.lit(BEFORE)), F.lit(" "), F.left(after, F.lit(AFTER))))
    score = F.lit(kind.score) + F.when(around.rlike(rf"\b(?:{kind.near})"), F.lit(ADDED)).otherwise(F.lit(0.0))
    return F.when(kind.check(span) if kind.base else kind.check(span) & (score >= LEAST_SCORE), score)


def _proposed(kind: Kind, text: Column) -> tuple[Column, Column]:
    """Matches, and the texts around them: one more."""
    return F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)


def _spans(kind: Kind, order: int, text: Column) -> Column:
    """array<struct<start, order, end, kind, score>> of one kind; start and end in code points."""
    def of(match: Column, gap: Column) -> Column:
        steps = F.transform(match, lambda _, i: F.length(F.get(gap, i)) + F.when(i > 0, F.length(F.get(match, i - 1))).otherwise(0))
        found = let(
            steps,
            lambda step: let(
                _running_sums(step),
                lambda start: F.transform(
                    match,
                    lambda m, i: F.struct(
                        F.get(start, i).alias("start"), F.lit(order).alias("ord"), (F.get(start, i) + F.length(m)).alias("end"), F.lit(kind.name).alias("kind"),
                        _confirmed(kind, m, F.get(gap, i), F.get(gap, i + 1)).alias("score"),
                    ),
                ),
            ),
        )
        return F.filter(found, lambda x: x["score"].isNotNull())

    match, gap = _proposed(kind, text)
    some = let(match, lambda m: F.when(F.size(m) > 0, let(gap, lambda g: of(m, g))))
    return F.coalesce(some, F.array()).cast("array<struct<start:int,ord:int,end:int,kind:string,score:double>>")


def find(docs: DataFrame, text_col: str = "text", kinds: list[Kind] = KINDS, into: str = "spans") -> DataFrame:
    """docs with one more column (or another in its place): all spans, in the order of start and kind.

    Null and empty texts have none. All other columns and rows stay as they are.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    each = [_spans(kind, k, text) for k, kind in enumerate(kinds)]
    return docs.withColumn(into, F.array_sort(F.concat(*each)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, a count of each base kind, base_sha256, spans, and max_score.

    Spans are kind:start:end, code points with the end exclusive, by start and then by the order of kinds. Null and
    empty texts have none; null ids and repeated rows are kept; an empty table gives an empty result.
    """
    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = find(only).select("doc_id", "spans")
    base = [k.name for k in KINDS if k.base]
    of = lambda names: F.filter("spans", lambda x: x["kind"].isin(names))
    counts = [F.size(of([name])).cast("long").alias(f"n_{name}") for name in base]
    sure = of(base)
    return found.select("doc_id", *counts, F.sha2(_joined(sure), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.array_max(F.transform("spans", lambda x: x["score"])).alias("max_score"))


#: Texts are cut into parts of this many code points, and those into PART, so that a place is found without reading all
#: that lies before it.
LONG_PART, PART = 65_536, 1_024


def _parts(text: Column) -> Column:
    """The text in parts of PART code points."""
    cut = lambda x, size: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length(x) - 1, F.lit(0)) / size).cast("int")), lambda k: F.substr(x, k * size + 1, F.lit(size)))
    return F.flatten(F.transform(cut(text, LONG_PART), lambda x: cut(x, PART)))


def _between(parts: Column, begin: Column, end: Column) -> Column:
    """The text from code point `begin` up to `end`."""
    at = lambda i: F.floor(i / PART).cast("int")
    first, last = at(begin), at(end)
    inner = F.substr(F.get(parts, first), begin - first * PART + 1, end - begin)
    outer = F.concat(
        F.substr(F.get(parts, first), begin - first * PART + 1, F.lit(PART)),
        F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.coalesce(F.substr(F.get(parts, last), F.lit(1), end - last * PART), F.lit("")),
    )
    return F.when(begin >= end, "").when(first == last, inner).otherwise(outer)


def _running_most(values: Column) -> Column:
    """Of a non-empty array of numbers, the greatest up to and with each."""
    at = lambda i: F.floor(i / F.lit(BLOCK)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), at(F.size(values) - 1)), lambda b: F.array_max(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    return let(
        blocks,
        lambda most: let(
            F.transform(F.sequence(F.lit(0), F.size(most) - 1), lambda b: F.array_max(F.slice(most, F.lit(1), b))),
            lambda ahead: F.transform(values, lambda _, i: F.greatest(F.get(ahead, at(i)), F.array_max(F.slice(values, at(i) * BLOCK + 1, i - at(i) * BLOCK + 1)))),
        ),
    )


def _masked(text: Column, spans: Column) -> Column:
    def of(parts: Column, ends: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
        heads = F.filter(F.sequence(F.lit(0), F.size(ends) - 1), lambda i: F.get(spans, i)["start"] >= before(i))
        put = F.transform(heads, lambda i: F.concat(_between(parts, before(i), F.get(spans, i)["start"]), F.lit("["), F.upper(F.get(spans, i)["kind"]), F.lit("]")))
        return F.concat(F.array_join(put, ""), _between(parts, F.element_at(ends, -1), F.length(text)))

    return let(_parts(text), lambda parts: let(_running_most(F.transform(spans, lambda x: x["end"])), lambda ends: of(parts, ends)))


def mask(docs: DataFrame, text_col: str = "text", kinds: list[Kind] = KINDS, passes: int = 2) -> DataFrame:
    """docs with [KIND] in the place of personal data. All spans of the text as it was are masked; those that overlap are
    one, under the kind of the first. Another pass takes what could not be told before, such as a card number after the
    last figure of an address. Null texts stay null, texts without spans as they are; all rows and columns stay.
    """
    name = next(c for c in (f"_spans{k}" for k in range(len(docs.columns) + 1)) if c.lower() not in {x.lower() for x in docs.columns})
    out = docs
    for _ in range(passes):
        text = F.col(text_col).cast("string")
        out = find(out, text_col, kinds, name).withColumn(text_col, F.when(F.size(name) > 0, _masked(text, F.col(name))).otherwise(text)).drop(name)
    return out
