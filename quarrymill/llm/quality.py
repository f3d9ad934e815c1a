"""Quality rules: counts of each text, and a hashed n-gram log-likelihood ratio between trusted texts and the raw corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import WordHashes, chunks, id_and_text

#: Buckets of the multinomials, as a power of two.
BITS = 17
#: Added to each bucket's count.
SMOOTHING = 0.5
#: Texts whose mean log ratio for an n-gram is under this are rejected.
THRESHOLD = -0.15
#: So many trusted ids are broadcast at most (about 60 bytes each in memory); more are joined by a shuffle.
MOST_BROADCAST = 500_000
REPEAT = 8

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SYMBOL = np.zeros(256, np.bool_)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, np.bool_)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def ngrams(hashes: np.ndarray, doc: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the word pairs of texts that lie one after another, and the text of each."""
    shift = np.uint64(64 - bits)
    pair = doc[1:] == doc[:-1]
    two = ((hashes[:-1] * _MIX + hashes[1:]) * _MIX)[pair] >> shift
    return np.concatenate([hashes >> shift, two]).astype(np.int64), np.concatenate([doc, doc[1:][pair]])


def repeated_words(hashes: np.ndarray, doc: np.ndarray, n_docs: int, width: int = REPEAT) -> np.ndarray:
    """For each text the number of its words in windows of `width` words that are found twice or more in it."""
    n = len(hashes) - width + 1
    if n < 2:
        return np.zeros(n_docs, np.int64)
    window = np.zeros(n, np.uint64)
    for k in range(width):
        window = window * _MIX + hashes[k : k + n]
    inside = doc[:n] == doc[width - 1 :]
    window = (window ^ (window >> np.uint64(31))) * _MIX + doc[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    ordered = np.sort(window[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(n_docs, np.int64)
    at = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    start = np.flatnonzero(inside & (twice[at] == window))
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + width, -1)
    return np.bincount(doc[np.cumsum(change[:-1]) > 0], minlength=n_docs)


def base_counts(text: bytes) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    raw = np.frombuffer(text, np.uint8)
    chars = int(((raw & 0xC0) != 0x80).sum() - _SPACE[raw].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return chars, int(_SYMBOL[raw].sum()), len(lines) - len(set(lines))


def _words(texts: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, the text of each, and the number of words of each text."""
    split = [t.split() for t in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    return np.concatenate([known.of(w) for w in split]) if len(split) else np.zeros(0, np.uint64), np.repeat(np.arange(len(split)), n), n


def multinomials(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """docs: text, trusted. Returns bucket, target and raw: n-grams of trusted and of all texts; at most 2^bits rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, raw, target = WordHashes(), np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            trusted = np.array(batch.column(1).to_pylist(), np.bool_)
            for begin, texts in chunks(batch.column(0)):
                hashes, doc, _ = _words(texts, known)
                bucket, of = ngrams(hashes, doc, bits)
                raw += np.bincount(bucket, minlength=1 << bits)
                target += np.bincount(bucket[trusted[begin + of]], minlength=1 << bits)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(target[at]), pa.array(raw[at])], ["bucket", "target", "raw"])

    counted = docs.select("text", "trusted").mapInArrow(run, "bucket long, target long, raw long")
    return counted.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counted: list, bits: int = BITS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Of each bucket, from rows of bucket, target, raw. Without trusted text all are 0."""
    target, raw = np.zeros(1 << bits), np.zeros(1 << bits)
    for b, t, r in counted:
        target[b], raw[b] = t, r
    if not target.sum():
        return np.zeros(1 << bits)
    each = smoothing * (1 << bits)
    return np.log((target + smoothing) / (target.sum() + each)) - np.log((raw + smoothing) / (raw.sum() + each))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, log_ratio.

    labels (doc_id, quality): texts with quality 1 are trusted; an id that is labelled both 1 and 0 is. log_ratio is the mean, over a text's words and word
    pairs, of log p(trusted) - log p(raw); kept if the base rules hold and it is at least `threshold`. Null and empty
    texts have no words and fail. Null ids and repeated rows are kept as they are; a repeated label row counts once.
    An empty table gives an empty result, no trusted text a ratio of 0. Other columns are not looked at.
    """
    trusted = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("trusted")).distinct()
    few = trusted.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    texts = id_and_text(docs, id_col, text_col)
    marked = texts.join(F.broadcast(trusted) if few else trusted, "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    ratio = log_ratios(multinomials(marked, bits).collect(), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for begin, texts in chunks(batch.column(1)):
                hashes, doc, n = _words(texts, known)
                bucket, of = ngrams(hashes, doc, bits)
                total = np.bincount(of, weights=ratio[bucket], minlength=len(texts)) / np.maximum(np.bincount(of, minlength=len(texts)), 1)
                repeats = repeated_words(hashes, doc, len(texts))
                chars, symbols, lines = zip(*map(base_counts, texts), strict=True)
                failed = (n < 20) | (100 * repeats > 30 * n)
                cols = [batch.column(0).slice(begin, len(texts)), n, chars, symbols, lines, repeats, failed, ~failed & (total >= threshold), total]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio"]
    types = ["long"] * 6 + ["boolean"] * 2 + ["double"]
    return texts.mapInArrow(run, ", ".join(f"{a} {b}" for a, b in zip(names, types, strict=True)))
