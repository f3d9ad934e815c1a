"""Masking of personal data: all spans of the text as it was, overlapping ones as one."""

import random
import time

import brute
from pyspark.sql import functions as F

from quarrymill.llm import pii


def plain_mask(text, spans):
    out, end = [], 0
    for kind, a, b in spans:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def told(spans):
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in spans.split(",") if x)]


def test_overlaps_leave_nothing(spark):
    texts = ["iban DE02587148418583989 end", "x +1 4111 1111 1111 1111 y", "a@1.2.3.4.b c", "+1 (555) 123-4567@a.bc", "GB82 WEST 1234 5698 7654 32 a@b.c", "plain", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: told(r.spans) for r in pii.report(rows).collect()}
    got = {r.doc_id: r.text for r in pii.mask(rows, passes=1).collect()}
    assert {r.doc_id: r.text for r in pii.mask(rows).collect()} == got == {k: None if t is None else plain_mask(t, spans[k]) for k, t in enumerate(texts)}
    assert got[0] == "iban [IBAN] end" and got[5] == "plain"


def test_random_and_long_texts(spark):
    rng = random.Random(3)
    some = ["a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+1 555 0100 200", "DE02587148418583989", "123-45-6789", "word", "é", "𝔘", "\n", "ssn"]
    texts = [" ".join(rng.choice(some) for _ in range(n)) for n in (1, 5, 40, 400, 3000)] + ["é" * 1023 + " a@b.co " + "x" * 70_000 + " 1.2.3.4", "y " * 40_000 + "a@b.co", "a@b.co " * 6_000]
    rows = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, _spans0 string")
    spans = {r.doc_id: told(r.spans) for r in pii.report(rows).collect()}
    begin = time.time()
    once = pii.mask(rows, passes=1).withColumn("n", F.length("text"))
    for r in once.collect():
        assert r.text == plain_mask(texts[r.doc_id], spans[r.doc_id]) and r.n == len(r.text) and r["_spans0"] == "s"
    twice = {r.doc_id: r.text for r in pii.mask(rows).collect()}
    assert time.time() - begin < 60
    again = {r.doc_id: r.text for r in pii.mask(once, passes=1).collect()}
    assert twice == again


def test_what_shows_only_after_a_pass(spark):
    rows = spark.createDataFrame([(1, "1.2.3.4 4111 1111 1111 1111")], "doc_id long, text string")
    got = pii.mask(rows).first().text
    assert got == "[IP] [CARD]" and not brute.base_spans(got)


def test_no_rows(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert pii.mask(rows.limit(0)).collect() == []
