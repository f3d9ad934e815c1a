"""Removal of repeated substrings, by suffix trees that are partitioned by prefixes.

A suffix starts at a word and has the words after it. The trees are sparse: of the suffixes that start in a window of
`width` words only the one whose first words hash least is a leaf, so that the same window has its leaf at the same place
wherever it stands, and a leaf carries the words before it that its windows have. (With each suffix as a leaf, every word
would be shuffled `width` times.)

Leaves are dealt out by prefixes of variable length: their first LENGTHS[0] words, counted in Spark; a prefix with more
leaves than a task should hold is lengthened to LENGTHS[1] words, and so on. A prefix of `width` words is itself a node
as deep as is asked for, and of its leaves only the least document matters, which is a partial sum.

A subtree is held as its leaves in order with the lengths of the common prefixes of neighbours: an internal node of some
depth is a run of leaves whose neighbours share that many words. Where the depth of a node and the words that leaves
below it share to their left make `width`, the leaves' windows are the same: these are the maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import WordHashes, chunks, counted, id_and_text, stored, tasks_for

WIDTH = 50
#: Words of prefixes, in the order in which they are lengthened; the last is as long as a window.
LENGTHS = (12, 25, WIDTH)
#: A prefix with more leaves than this is lengthened; so many take about 200 MB while their subtree is built.
MOST_LEAVES = 20_000
#: Leaves whose subtrees are built at once; whole subtrees, so there may be MOST_LEAVES more.
LEAVES_AT_ONCE = 4_000
#: Keys that are broadcast at most, of about 40 bytes each; more are joined by a shuffle.
MOST_KEYS = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
_LEAF = "level int, key long, doc_id long, mark long, pos int, n int, at int, words binary"


def _hashed(texts: list[bytes], known: WordHashes) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    split = [t.split() for t in texts]
    n = np.fromiter(map(len, split), np.int64, len(split))
    return split, np.concatenate([known.of(w) for w in split]) if split else np.zeros(0, np.uint64), np.repeat(np.arange(len(split)), n)


def leaves(hashes: np.ndarray, doc: np.ndarray, width: int, prefix: int) -> tuple[np.ndarray, ...]:
    """hashes: of the words of texts that lie one after another; doc: the text of each.

    The leaf of a window is, of the places where `prefix` words lie inside it, the one whose words hash least, the first
    of equal ones. Returns for each run of windows with the same leaf the first window's place, the number of windows,
    the leaf's place and the hash of its prefix.
    """
    n, span = len(hashes) - width + 1, width - prefix + 1
    if n < 1:
        return _NONE
    value = np.zeros(len(hashes) - prefix + 1, np.uint64)
    for k in range(prefix):
        value = value * _MIX + hashes[k : k + len(value)]
    value = (value ^ (value >> np.uint64(32))) * _MIX
    key, place, size = value, np.arange(len(value)), 1
    while size < span:
        step = min(size, span - size)
        left, right = key[:-step], key[step:]
        first = left <= right
        key, place, size = np.where(first, left, right), np.where(first, place[:-step], place[step:]), size + step
    inside = np.flatnonzero(doc[:n] == doc[width - 1 :])
    if not len(inside):
        return _NONE
    place = place[inside]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)]))
    return inside[new], np.diff(np.append(new, len(inside))), place[new], key[inside[new]]


def _prefixes(batches: Iterator[pa.RecordBatch], width: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """doc_id, mark, text -> key, doc_id, mark, n: the prefixes of each document's leaves, and how many leaves have them."""
    known = WordHashes()
    for batch in batches:
        ids, marks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for begin, texts in chunks(batch.column(2)):
            _, hashes, doc = _hashed(texts, known)
            start, _, _, key = leaves(hashes, doc, width, prefix)
            order = np.lexsort((key, doc[start]))
            key, of = key[order], doc[start][order]
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])])) if len(key) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(key)))
            who = begin + of[new]
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(ids[who].astype(np.int64)), pa.array(marks[who].astype(np.int64)), pa.array(n.astype(np.int32))], ["key", "doc_id", "mark", "n"])


class _Rows:
    """Leaves on their way into a batch. Those of prefixes as long as a window carry its 128-bit hash for words."""

    def __init__(self, width: int, lengths: tuple[int, ...], known: WordHashes):
        self.width, self.lengths, self.known = width, lengths, known
        self.rows: list[tuple] = []

    def add(self, level: int, key: int, doc: int, mark: int, pos: int, n: int, at: int, words: list[bytes]) -> None:
        text = b" ".join(words)
        self.rows.append((level, key, doc, mark, pos, n, at, xxhash.xxh3_128_digest(text) if self.lengths[level] == self.width else text))

    def lengthen(self, level: int, doc: int, mark: int, pos: int, words: list[bytes]) -> None:
        """The leaves, with prefixes of `level`, of a run of windows whose words are given."""
        hashes = self.known.of(words)
        found = leaves(hashes, np.zeros(len(words), np.int64), self.width, self.lengths[level])
        for start, n, place, key in zip(*(x.tolist() for x in (*found[:3], found[3].view(np.int64))), strict=True):
            self.add(level, key, doc, mark, pos + start, n, place - start, words[start : start + n + self.width - 1])

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), types, strict=True)], [c.split()[0] for c in _LEAF.split(", ")])
            self.rows = []


def _leaves(batches: Iterator[pa.RecordBatch], width: int, lengths: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """doc_id, mark, text, key, long -> leaves of the document's keys; those of keys that are too long by a longer prefix."""
    out = _Rows(width, lengths, WordHashes())
    for batch in batches:
        ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for begin, texts in chunks(batch.column(2)):
            for k, text in enumerate(texts):
                doc, mark = ids[begin + k], marks[begin + k]
                held = dict(zip(batch.column(3)[begin + k].as_py(), batch.column(4)[begin + k].as_py(), strict=True))
                (words,), hashes, where = _hashed([text], out.known)
                found = leaves(hashes, where, width, lengths[0])
                for start, n, place, key in zip(*(x.tolist() for x in (*found[:3], found[3].view(np.int64))), strict=True):
                    long = held.get(key)
                    if long:
                        out.lengthen(1, doc, mark, start, words[start : start + n + width - 1])
                    elif long is not None:
                        out.add(0, key, doc, mark, start, n, place - start, words[start : start + n + width - 1])
                yield from out.batches(20_000)
            yield from out.batches()


def _lengthened(batches: Iterator[pa.RecordBatch], width: int, lengths: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Leaves -> leaves of the same windows, by the next longer prefix."""
    out = _Rows(width, lengths, WordHashes())
    for batch in batches:
        for level, _, doc, mark, pos, _, _, text in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
            out.lengthen(level + 1, doc, mark, pos, text.split(b" "))
            yield from out.batches(20_000)
    yield from out.batches()


class _Numbers(dict):
    """Numbers from 1 for words, in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) + 1
        return found


class Subtrees:
    """The suffix trees of some leaves: their order, and how many words neighbours share."""

    def __init__(self, right: np.ndarray):
        """right: the words from each leaf on, as numbers, filled up with zeros."""
        self.order = np.argsort(np.ascontiguousarray(right.astype(">u4")).view(f"S{4 * right.shape[1]}").ravel(), kind="stable") if right.shape[1] else np.arange(len(right))
        same = right[self.order[1:]] == right[self.order[:-1]]
        ends = np.concatenate([same, np.zeros((len(same), 1), np.bool_)], 1)
        self.shared = np.concatenate([[-1], np.argmin(ends, 1)])

    def nodes(self, depth: int) -> np.ndarray:
        """For each leaf the number of its node: the ancestor that is the highest of at least this depth."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.shared < depth)
        return out


def repeats(doc: np.ndarray, n: np.ndarray, at: np.ndarray, texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves, each with its document, its number of windows, the words before it and all words of its windows.

    Returns runs of windows that a document with a smaller id has too: the leaf, the first window and their number.
    """
    numbers, size = _Numbers(), n + width - 1
    flat = np.fromiter(map(numbers.__getitem__, b" ".join(texts).split(b" ")), np.int32, int(size.sum()))
    begin = np.cumsum(size) - size
    own = begin + at
    place = own[:, None] + np.arange(width)
    right = np.where(place < (begin + size)[:, None], flat[np.minimum(place, len(flat) - 1)], 0)
    place = own[:, None] - 1 - np.arange(int(at.max()))
    left = np.where(place >= begin[:, None], flat[np.maximum(place, 0)], 0)
    after, before = Subtrees(right), Subtrees(left)
    repeated = np.zeros((len(doc), int(n.max()) + 1), np.bool_)
    for ahead in range(int(at.max()) + 1):
        # windows that begin so many words before their leaf
        window = at - ahead
        leaf = np.flatnonzero((window >= 0) & (window < n))
        node = after.nodes(width - ahead)[leaf] * (len(doc) + 1) + before.nodes(ahead)[leaf]
        _, node = np.unique(node, return_inverse=True)
        least = np.full(len(leaf), np.iinfo(np.int64).max)
        np.minimum.at(least, node, doc[leaf])
        more = doc[leaf] > least[node]
        repeated[leaf[more], window[leaf[more]]] = True
    change = np.diff(np.concatenate([np.zeros((len(doc), 1), np.int8), repeated.astype(np.int8)], 1).ravel(), append=0)
    wide = repeated.shape[1] + 1
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    return first // wide, first % wide, last - first


def _trees(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Leaves sorted by key -> doc_id, mark, pos, n: runs of windows that a smaller doc_id has too; a few subtrees at a time."""

    def give(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts)
        doc, mark, pos, n, at = (rows.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "mark", "pos", "n", "at"))
        leaf, first, found = repeats(doc, n, at, rows.column("words").to_pylist(), width)
        if len(leaf):
            yield pa.RecordBatch.from_arrays([pa.array(doc[leaf]), pa.array(mark[leaf]), pa.array((pos[leaf] + first).astype(np.int32)), pa.array(found.astype(np.int32))], ["doc_id", "mark", "pos", "n"])

    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            if size < LEAVES_AT_ONCE:
                take = min(batch.num_rows, LEAVES_AT_ONCE - size)
            else:  # up to where the next subtree begins
                key = held[-1].column(1)[-1].as_py()
                take = int(np.argmax(np.append(batch.column(1).to_numpy() != key, True)))
            if take:
                held.append(batch.slice(0, take))
                size, batch = size + take, batch.slice(take)
            if batch.num_rows and size >= LEAVES_AT_ONCE and batch.column(1)[0].as_py() != held[-1].column(1)[-1].as_py():
                yield from give(held)
                held, size = [], 0
    if held:
        yield from give(held)


def repeated_windows(texts: DataFrame, copies: DataFrame, width: int = WIDTH, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """texts: doc_id (not null), mark, text as bytes; copies: doc_id, mark of those that take no part. Returns doc_id,
    mark, pos, n: the windows from place pos on that also start in a document with a smaller id."""
    spark, tasks = texts.sparkSession, tasks_for(texts.sparkSession)
    last = len(lengths) - 1
    prefixes = stored(texts.select("doc_id", "mark", "text").mapInArrow(lambda b: _prefixes(b, width, lengths[0]), "key long, doc_id long, mark long, n int"), "prefixes")
    prefixes = prefixes.join(copies, ["doc_id", "mark"], "left_anti")
    shared = prefixes.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.sum("n").alias("leaves"))
    shared = shared.filter("least < most").select("key", (F.col("leaves") > MOST_LEAVES).alias("long"))
    of_doc = prefixes.join(shared, "key").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("key", "long")).alias("held")).select("doc_id", "mark", "held.key", "held.long")
    some = texts.join(of_doc, ["doc_id", "mark"]).select("doc_id", "mark", "text", "key", "long")
    rows = stored(some.mapInArrow(lambda b: _leaves(b, width, lengths), _LEAF), "leaves")
    light, nodes = rows.filter("level = 0"), rows.filter(F.col("level") == last)
    for level in range(1, last):
        # of longer prefixes, those that are still too common are fewer than a MOST_LEAVES-th of the leaves
        now = rows.filter(F.col("level") == level)
        heavy = counted(now.groupBy("key").count().filter(F.col("count") > MOST_LEAVES).select("key"), "heavy", MOST_KEYS)
        light = light.union(now.join(heavy, "key", "left_anti").select(*rows.columns))
        more = stored(now.join(heavy, "key", "left_semi").select(*rows.columns).mapInArrow(lambda b: _lengthened(b, width, lengths), _LEAF), "leaves")
        rows = more
        nodes = nodes.union(more.filter(F.col("level") == last))
    found = light.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(lambda b: _trees(b, width), "doc_id long, mark long, pos int, n int")
    # the least document of each node; the leaves of common nodes stay where they are
    least = stored(nodes.groupBy("words").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("leaves")).filter("least < most"), "nodes")
    common = counted(least.filter(F.col("leaves") > MOST_LEAVES).select("words", "least"), "common", MOST_KEYS)
    others = nodes.join(common, "words", "left_anti").join(least.select("words", "least"), "words")
    deep = nodes.join(common, "words").select(*others.columns).union(others).filter("doc_id > least")
    return found.union(deep.select("doc_id", "mark", "pos", "n"))


def deduplicate(docs: DataFrame, width: int = WIDTH, lengths: tuple[int, ...] = LENGTHS, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept: the words left.

    Each word is removed that lies in a window of `width` words which also starts in a document with a smaller id; the
    windows are those of the input. Null and empty texts have no words. Rows without an id take no part and stay whole;
    rows that share an id do not remove words from each other. An empty table gives an empty result. Other columns are
    not looked at.

    Equal texts are one string of the trees, under the least of their ids; the others lose all words if they have a window.
    """
    if lengths[-1] != width or list(lengths) != sorted(set(lengths)) or len(lengths) < 2:
        raise ValueError(f"lengths must rise to {width}: {lengths}")
    texts = id_and_text(docs, id_col, text_col).withColumn("mark", F.coalesce(F.xxhash64("text"), F.lit(0)))
    own = stored(texts.filter("doc_id is not null and octet_length(text) > 0").select("doc_id", "mark", F.unhex(F.md5("text")).alias("digest")), "digests")
    first = own.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("times")).filter("times > 1").drop("times")
    copies = counted(own.join(first, "digest").filter("doc_id > least").select("doc_id", "mark").distinct(), "copies", MOST_KEYS)
    runs = repeated_windows(texts.filter("doc_id is not null"), copies, width, lengths).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("pos", "n")).alias("gone"))
    none = F.array().cast("array<struct<pos:int,n:int>>")
    found = runs.select("doc_id", "mark", "gone", F.lit(False).alias("whole")).union(copies.select("doc_id", "mark", none, F.lit(True)))
    joined = texts.join(found, ["doc_id", "mark"], "left").select("doc_id", "text", F.col("gone.pos").alias("pos"), F.col("gone.n").alias("n"), "whole")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, some in chunks(batch.column(1)):
                rows = []
                for k, text in enumerate(some):
                    words = text.split()
                    size, pos = len(words), batch.column(2)[begin + k].as_py()
                    if batch.column(4)[begin + k].as_py():
                        words = words if size < width else []
                    elif pos:
                        change, pos = np.zeros(size + 1, np.int32), np.array(pos, np.int64)
                        np.add.at(change, pos, 1)
                        np.add.at(change, pos + np.array(batch.column(3)[begin + k].as_py(), np.int64) + width - 1, -1)
                        words = [w for w, c in zip(words, np.cumsum(change[:-1]).tolist(), strict=True) if not c]
                    kept = b" ".join(words)
                    rows.append((size, size - len(words), hashlib.sha256(kept).hexdigest(), kept))
                n, removed, sha, kept = zip(*rows, strict=True)
                cols = [batch.column(0).slice(begin, len(some)), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())]
                more = [pa.array(kept, pa.binary())] if with_text else []
                yield pa.RecordBatch.from_arrays(cols + more, ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text])

    out = joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept binary" * with_text)
    return out.withColumn("kept", F.col("kept").cast("string")) if with_text else out
