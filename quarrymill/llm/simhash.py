"""SimHash near-duplicates: 64-bit fingerprints, linked by a self-join of a binary trie within a Hamming budget."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import stored, tasks_for
from quarrymill.llm.components import components

#: Bits of the three blocks: two fingerprints within 2 bits agree on all of one block.
BLOCKS = (22, 21, 21)
#: A block value with more fingerprints than this is dealt out by pairs of deeper trie nodes.
HEAVY = 50_000
#: Levels by which a heavy trie node is deepened.
DEEPER = 8
#: Node pairs that are expanded at once.
CHUNK = 200_000


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of UTF-8 text: a bit is 1 if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    digest = xxhash.xxh64_intdigest
    pairs = zip(start[: 1 - shingle].tolist(), end[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 100_000):
        part = hashes[at : at + 100_000]
        total += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, marks: bool = False) -> DataFrame:
    """Columns doc_id and fp (signed long), with marks also the text's xxhash64: one row for each row of docs. Null and
    empty texts have fingerprint 0."""
    more = ["mark"] if marks else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], ["doc_id", "fp", *more])

    text = F.col(text_col).cast("string")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"), *[F.xxhash64(text).alias(m) for m in more])
    return ids.mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", "fp", *more]))


def trie_pairs(values: np.ndarray, pairs: list[np.ndarray], top: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Joins a binary trie with itself.

    values: sorted within each trie node, distinct. pairs: arrays aL, aR, bL, bR, differing: ranges of values that are
    nodes at bit `top`, the node pairs to start from (a == b for a node with itself) and the bits in which their
    prefixes differ. Yields index arrays i, j of all values within the budget, each pair once.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(top, pairs)]
    while stack:
        bit, (a0, a1, b0, b1, d) = stack.pop()
        if len(a0) > CHUNK:
            half = len(a0) // 2
            stack += [(bit, [x[:half] for x in (a0, a1, b0, b1, d)]), (bit, [x[half:] for x in (a0, a1, b0, b1, d)])]
            continue
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = (np.bitwise_count(values[i] ^ values[j]) <= budget) & (i != j)
            yield i[near], j[near]
            a0, a1, b0, b1, d = (x[~single] for x in (a0, a1, b0, b1, d))
        if bit < 0 or not len(a0):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1))]).astype(np.int64)
        c = ones[bit]
        am, bm, same = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0]), a0 == b0
        parts = [(a0, am, b0, bm, d, None), (am, a1, bm, b1, d, None), (a0, am, bm, b1, d + 1, None), (am, a1, b0, bm, d + 1, ~same)]
        kept = []
        for l0, l1, r0, r1, diff, only in parts:
            keep = (l1 > l0) & (r1 > r0) & (diff <= budget)
            if only is not None:
                keep &= only
            kept.append([x[keep] for x in (l0, l1, r0, r1, diff)])
        stack.append((bit - 1, [np.concatenate(x) for x in zip(*kept, strict=True)]))


class Forest:
    """Union-find over 0..n-1; keeps no edges."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        up = self.up
        while len(i):
            while True:
                nxt = up[up]
                if (nxt == up).all():
                    break
                up[:] = nxt
            a, b = up[i], up[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def _links(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows of key (turn, block, low, high), turned and fp -> a spanning forest of each task's links, as u and v."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    rows = pa.Table.from_batches(got)
    cols = {c: rows.column(c).to_numpy() for c in rows.column_names}
    value = cols["turned"].view(np.uint64)
    order = np.lexsort((value, cols["high"], cols["low"], cols["block"], cols["turn"]))
    value, fp = value[order], cols["fp"][order]
    keys = np.stack([cols[c][order] for c in ("turn", "block", "low", "high")])
    first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
    last = np.append(first[1:], len(value))
    low, high = keys[2, first], keys[3, first]
    cross = high > low
    # The deeper node of each value: the DEEPER bits below its block.
    width = np.array(BLOCKS)[keys[0]]
    node = ((value << width.astype(np.uint64)) >> np.uint64(64 - DEEPER)).astype(np.int64)
    ahead = np.concatenate([[0], np.cumsum((keys[3] > keys[2]) & (node == keys[3]))])
    mid = last - (ahead[last] - ahead[first])
    a1, b0 = np.where(cross, mid, last), np.where(cross, mid, first)
    # A cross pair differs in its deeper bits; the traversal starts below them.
    differing = np.where(cross, np.bitwise_count((low ^ high).astype(np.uint64)), 0).astype(np.int64)
    forest = Forest(len(value))
    plain = (~cross) & (last - first > 1)
    starts = [(63 - min(BLOCKS), plain)] + [(63 - w - DEEPER, cross & (a1 > first) & (last > b0) & (width[first] == w)) for w in sorted(set(BLOCKS))]
    for top, take in starts:
        begin = [x[take] for x in (first, a1, b0, last, differing)]
        for i, j in trie_pairs(value, begin, top, budget):
            # rows of one fingerprint in several groups need no link here: links are by value
            forest.add(i, j)
    root = forest.roots()
    moved = root != np.arange(len(root))
    yield pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], ["u", "v"])


def linked_fingerprints(distinct: DataFrame, budget: int = 2) -> DataFrame:
    """Edges u, v between fingerprints within the budget: not all pairs, but a forest with the same components.

    The trie is held three times, each time with another third of the bits first; a pair within two bits agrees on one
    third, so in one of the three its two nodes share a prefix and meet in one task. Prefixes with over HEAVY
    fingerprints are deepened by DEEPER bits and dealt out by pairs of deeper nodes within the budget.
    """
    if not 0 <= budget < len(BLOCKS):
        raise ValueError(f"budget must be under {len(BLOCKS)}: {budget}")
    spark = distinct.sparkSession
    turned, shift = [], 0
    for turn, width in enumerate(BLOCKS):
        value = F.col("fp") if not shift else F.shiftleft("fp", shift).bitwiseOR(F.shiftrightunsigned("fp", 64 - shift))
        turned.append(F.struct(F.lit(turn).alias("turn"), F.shiftrightunsigned(value, 64 - width).alias("block"), value.alias("turned")))
        shift += width
    rows = distinct.select("fp", F.explode(F.array(*turned)).alias("x")).select("fp", "x.*")
    heavy = rows.groupBy("turn", "block").count().filter(F.col("count") > HEAVY).select("turn", "block", F.lit(True).alias("heavy"))
    masks = [m for m in range(1 << DEEPER) if m.bit_count() <= budget]
    width = F.element_at(F.array(*[F.lit(w) for w in BLOCKS]), F.col("turn") + 1)
    node = F.shiftrightunsigned(F.expr("shiftleft(turned, w)"), 64 - DEEPER)
    deep = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.struct(F.least(node, node.bitwiseXOR(m)).alias("low"), F.greatest(node, node.bitwiseXOR(m)).alias("high")))
    flat = F.array(F.struct(F.lit(-1).cast("long").alias("low"), F.lit(-1).cast("long").alias("high")))
    rows = rows.join(heavy, ["turn", "block"], "left").withColumn("w", width)
    rows = rows.select("turn", "block", "turned", "fp", F.explode(F.when(F.col("heavy"), deep).otherwise(flat)).alias("n")).select("turn", "block", "n.low", "n.high", "turned", "fp")
    dealt = rows.repartition(tasks_for(spark), "turn", "block", "low", "high")
    return dealt.mapInArrow(lambda batches: _links(batches, budget), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 2) -> DataFrame:
    """Columns doc_id, fingerprint (16 hex digits) and component_id: one row for each row of docs.

    Documents link if their fingerprints differ in `budget` or fewer bits; component_id is the least doc_id reachable.
    Null and empty texts have fingerprint zero and link like any other. Repeated rows give repeated results; null ids
    are kept and never become a component_id unless a component has no other. An empty table gives an empty result.
    Other columns of docs are not looked at.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(linked_fingerprints(distinct, budget)).withColumnRenamed("u", "fp")
    at = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = at.groupBy("root").agg(F.min("least").alias("component_id"))
    of = at.select("fp", "root").join(least, "root").select("fp", "component_id")
    joined = prints.join(of, "fp", "left")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: int = 2) -> DataFrame:
    """Columns doc_id, mark (xxhash64 of the text) and copy: one row for each row of docs.

    Groups are those of near_duplicates(). Of a group the row with the least doc_id, then the least mark, is no copy; a
    row without an id is one if any row of its group has an id. Rows equal in both are alike: all copies or none.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, marks=True), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    distinct = stored(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = components(linked_fingerprints(distinct.select("fp"), budget)).withColumnRenamed("u", "fp")
    at = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    kept = at.groupBy("root").agg(F.min("least").alias("kept"))
    of = at.select("fp", "root").join(kept, "root").select("fp", "kept")
    return prints.join(of, "fp", "left").select("doc_id", "mark", (~key.eqNullSafe(F.col("kept"))).alias("copy"))
