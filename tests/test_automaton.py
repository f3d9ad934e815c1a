"""Patterns by the automaton against one regular expression after another."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import automaton as A
from quarrymill.functions.patterns import NEGATIONS, PATTERNS

DATA = "/root/testdata/sf0.001"


def plain(text, table=PATTERNS, negations=NEGATIONS):
    out = set()
    for own in table.values():
        for name, patterns in own.items():
            for p in patterns:
                for m in re.finditer(p, text, re.IGNORECASE):
                    before = text[max(0, m.start() - 28) : m.start()].lower()
                    if not any(re.search(n + r"[\w\s']{0,12}$", before) for n in negations):
                        out.add(name)
    return sorted(out)


@pytest.mark.parametrize(
    ("pattern", "literal"),
    [
        (r"carnet\s+(?:d[\'e]\s*)?entretien", "entretien"), (r"factures?\s+jointes?", "facture"), (r"a|bcd", None), (r"(?:abc|bcd)", None), (r"\bfsh\b", "fsh"), (r"ab+cde", "cde"), (r"abcd{2}ef", "abc"),
        (r"premi[èe]re\s+main", "premi"), (r"\d{4}", None), (r"service[\s\-]?historie", "historie"), (r"Étaté?", "état"), (r"[)]abc\.def(", "abc.def"), (r"colou?r+s", "colo"), (r"ab", None),
    ],
)
def test_needed_literals(pattern, literal):
    assert A.needed(pattern) == literal


def test_all_patterns_have_what_they_need():
    """Words made from each pattern match it, and have its literal."""
    tried = A.Patterns(PATTERNS, NEGATIONS)
    assert len(tried.patterns) == sum(len(p) for own in PATTERNS.values() for p in own.values()) == 260
    assert len(tried.always) < 20


def phrases():
    """A phrase for each pattern: classes and choices by their first, spaces for white space."""
    out = []
    for own in PATTERNS.values():
        for patterns in own.values():
            for p in patterns:
                x = re.sub(r"\(\?:([^|()]*)(?:\|[^()]*)?\)\??", r"\1", re.sub(r"\(\?:([^|()]*)(?:\|[^()]*)?\)\??", r"\1", p))
                x = re.sub(r"\[\^[^\]]*\](\{[^}]*\}|[+*?])?", "", x)
                x = re.sub(r"\[(\\?.)[^\]]*\][+?*]?", lambda m: m[1], x).replace("\\s+", " ").replace("\\s*", " ").replace("\\s", " ").replace("\\b", "")
                x = re.sub(r"\\d(\{[^}]*\}|\+)?", "1", x)
                out.append(re.sub(r"\\(.)", r"\1", re.sub(r"(?<!\\)[?]", "", x)))
    return out


def test_texts_with_and_without_negations(spark):
    rng = random.Random(1)
    words, some = ["sans", "no", "KEIN", "the car", "voiture", "zonder de", "aucune", "  ", "\n", "ſ", "İ", "\u212a", "non", "et d'un", "x" * 30], phrases()
    assert sum(bool(plain(p)) for p in some) > 200
    texts = [" ".join(rng.choice(some) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    texts = [rng.choice([t, t.upper(), t.title()]) for t in texts] + ["", None, "a" * 200_000, "Pneus neufs " * 5000, "SERVICE HI\u017fTORY", "\u212aein scheckheftgepflegt"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    got = {r.k: r.shown for r in rows.select("k", A.features_shown(F.col("t")).alias("shown")).collect()}
    assert all(got[k] == plain(t or "") for k, t in enumerate(texts))
    assert sum(bool(x) for x in got.values()) > 800


def test_all_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = docs.select("doc_id", F.concat("text", F.when(F.col("doc_id") % 3 == 0, F.lit(" without service history")).when(F.col("doc_id") % 3 == 1, F.lit(" Scheckheft gepflegt."))).alias("text"))
    rows = docs.select("doc_id", "text").union(extra)
    for r in rows.select("text", A.features_shown(F.col("text")).alias("shown")).collect():
        assert r.shown == plain(r.text or "")


def test_tables_without_literals_or_patterns(spark):
    row = spark.createDataFrame([("a1 b",)], "t string")
    assert row.select(A.features_shown(F.col("t"), {}, []).alias("s")).first().s == []
    assert row.select(A.features_shown(F.col("t"), {"x": {"n": [r"\d", r"zz"], "m": [r"b|c"]}}, []).alias("s")).first().s == ["m", "n"]
