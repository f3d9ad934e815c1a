"""Packing of tokenised documents into sequences of bounded length, by bin completion with branch and bound.

Sequences differ only in the lengths that they hold, so the search runs over the histogram of lengths: it has at most
`capacity` entries however large the corpus is, and the whole corpus is packed at once. Pieces find their places in the
plan by their rank among the pieces of their length.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import chunks, id_and_text, stored

CAPACITY = 2048
#: Nodes of the search. When they are used up the best packing so far holds: it is whole, and `bound` tells how far it can
#: be from the best.
TRIES = 6_000
#: Nodes of a descent between two tries to complete it by best fit.
STEPS = 64


def vocabulary(name: str = "byte_bpe_50k") -> str:
    """The place of a public byte-level vocabulary, as ranks; its ids are those of the .json file of the same name."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens: full ones, but for the first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * (first > 0) + [(k, capacity) for k in range(first, n, capacity)]


def bound(counts: np.ndarray, capacity: int) -> int:
    """A number of sequences under which no packing can be.

    Lengths are rounded by dual feasible functions: numbers that add up to at most 1 for whatever fits into a sequence. The
    first is the share of the capacity itself; the k-th takes (k + 1) times that share, rounded down, over k, but leaves a
    share alone that it makes whole.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return 0
    n, best = counts[lengths], -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    for k in range(1, 101):
        whole, rest = divmod((k + 1) * lengths, capacity)
        value = np.where(rest == 0, lengths * k, whole * capacity)  # in parts of k x capacity
        best = max(best, -(-int((n * value).sum()) // (k * capacity)))
    return best


def dominated(filling: tuple[int, ...], left: np.ndarray, gap: int) -> bool:
    """Whether a filling does no better than one that has a longer length in the place of some of its own, or one of the
    same length in the place of several. left: lengths that are not used by it."""
    slack = gap - sum(filling)
    any_sum, of_two = 1, 0  # bit s: a part of the filling adds up to s; and one of two or more
    for a in filling:
        of_two |= (of_two << a) | ((any_sum & ~1) << a)
        any_sum |= any_sum << a
    more = np.concatenate([[0], np.cumsum(left > 0)])  # lengths under each
    top = len(left) - 1
    for s in range(1, sum(filling) + 1):
        if any_sum >> s & 1 and (more[min(s + slack, top) + 1] - more[min(s, top) + 1] > 0 or of_two >> s & 1 and s <= top and left[s] > 0):
            return True
    return False


def fillings(counts: np.ndarray, gap: int, most_waste: int) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of a gap with the lengths at hand that waste no more than most_waste; those that waste least
    first, of these such of long lengths first. All of them, one at a time; for what no length fits into, the empty one."""
    lengths = np.flatnonzero(counts[: gap + 1])[::-1].tolist() if gap > 0 else []
    if not lengths:
        if gap <= most_waste:
            yield ()
        return
    mask = (1 << gap + 1) - 1
    reach = [1] * (len(lengths) + 1)  # bit s of the k-th: lengths from the k-th on can add up to s
    for k in range(len(lengths) - 1, -1, -1):
        found, n, step = reach[k + 1], min(int(counts[lengths[k]]), gap // lengths[k]), 1
        while n:
            some = min(step, n)
            found |= found << some * lengths[k] & mask
            n, step = n - some, step * 2
        reach[k] = found

    def search(k: int, room: int, held: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        if not room:
            yield held
            return
        while k < len(lengths):
            if not reach[k] >> room & 1:
                return
            a = lengths[k]
            for n in range(min(int(counts[a]), room // a), 0, -1):
                if reach[k + 1] >> room - n * a & 1:
                    yield from search(k + 1, room - n * a, held + (a,) * n)
            k += 1

    for waste in range(min(most_waste, gap) + 1):
        for filling in search(0, gap - waste, ()) if reach[0] >> gap - waste & 1 else ():
            left = counts.copy()
            np.subtract.at(left, list(filling), 1)
            if not left[1 : waste + 1].any() and not dominated(filling, left[: gap + 1], gap):
                yield filling


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The incumbent: longest first, each into the fullest sequence that has room, over the histogram."""
    rooms: Counter[tuple[int, ...]] = Counter()
    by_room: list[list[tuple[int, ...]]] = [[] for _ in range(capacity + 1)]
    for a in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[a])
        while n:
            room = next((r for r in range(a, capacity) if by_room[r]), None)
            if room is None:
                each = capacity // a
                whole, rest = divmod(n, each)
                for held, k in (((a,) * each, whole), ((a,) * rest, int(rest > 0))):
                    if k:
                        if not rooms[held]:
                            by_room[capacity - a * len(held)].append(held)
                        rooms[held] += k
                break
            held = by_room[room][-1]
            k = min(n, rooms[held])
            rooms[held] -= k
            if not rooms[held]:
                by_room[room].pop()
            new = (*held, a)
            if not rooms[new]:
                by_room[room - a].append(new)
            rooms[new] += k
            n -= k
    return [(held, k) for held, k in rooms.items() if k]


def plan(counts: np.ndarray, capacity: int = CAPACITY, tries: int = TRIES) -> list[tuple[tuple[int, ...], int]]:
    """Fillings, each with the number of sequences that have it, holding exactly the lengths in the histogram.

    Bin completion: the longest length at hand opens a sequence, its undominated fillings are tried in the order of waste,
    each for as many sequences at once as the histogram allows and then for one. A branch ends where its waste and what
    bound() says of the rest leave no packing that is better than the best so far, which at first is the best-fit one; a
    descent is also completed by best fit now and then. `tries` bounds the search, not the packing.
    """
    counts = np.asarray(counts, np.int64).copy()
    sizes = np.arange(len(counts))
    total = int((counts * sizes).sum())
    least = bound(counts, capacity)
    found = best_fit(counts, capacity)
    bins = sum(k for _, k in found)
    path: list[tuple[tuple[int, ...], int]] = []

    def options(left: np.ndarray, wasted: int) -> Iterator[tuple[tuple[int, ...], int]]:
        longest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[longest] -= 1
        for filling in fillings(rest, capacity - longest, (bins - 1) * capacity - total - wasted):
            whole = (longest, *filling)
            times = min(int(left[a]) // k for a, k in Counter(whole).items())
            for n in (times, 1) if times > 1 else (1,):
                yield whole, n

    # each level of the descent: its histogram, sequences and waste so far, and how many options were tried there; only
    # the deepest level keeps its options, others find their place again when the search comes back to them
    stack = [[counts, 0, 0, 0]] if bins > least and total else []
    more = None
    while stack and bins > least and tries > 0:
        left, used, wasted, tried = stack[-1]
        if more is None:
            more = islice(options(left, wasted), tried, None)
        choice = next(more, None)
        if choice is None or wasted > (bins - 1) * capacity - total:
            stack.pop()
            more = None
            del path[-1:]
            continue
        tries -= 1
        stack[-1][3] += 1
        whole, times = choice
        rest = left.copy()
        for a, k in Counter(whole).items():
            rest[a] -= k * times
        now, waste = used + times, wasted + times * (capacity - sum(whole))
        if now + bound(rest, capacity) >= bins:
            continue
        if not rest.any():
            found, bins = [*path, choice], now
            continue
        if len(stack) % STEPS == 1:
            completed = best_fit(rest, capacity)
            n = now + sum(k for _, k in completed)
            if n < bins:
                found, bins = [*path, choice, *completed], n
        path.append(choice)
        stack.append([rest, now, waste, 0])
        more = None
    return found


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, by length, the rank in its task: one row for each piece of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = encoder(path), TaskContext.get().partitionId()
        met = [0] * (capacity + 1)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, texts in chunks(batch.column(1)):
                rows = []
                for k, text in enumerate(texts):
                    found = np.array([*tokens.encode_ordinary(text.decode("utf-8", "replace")), end_id], "<u4")
                    for piece, (start, length) in enumerate(cut(len(found), capacity)):
                        rows.append((ids[begin + k], piece, start, length, zlib.crc32(found[start : start + length].tobytes()), part, met[length]))
                        met[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A text's ids end with end_id; null and empty texts are that one id. Texts of over `capacity` ids are cut, others
    stay whole. Null ids and repeated rows are packed as rows of their own; an empty table gives an empty result; other
    columns are not looked at. Sequences are numbered from 0, pieces lie in them without gaps from 0.
    """
    spark = docs.sparkSession
    made = stored(pieces(docs, path or vocabulary(), capacity, end_id, id_col, text_col), "pieces")
    by_part = stored(made.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    slots, met, base = [], np.zeros(capacity + 1, np.int64), 0
    for held, times in plan(counts, capacity):
        offset = 0
        for a in held:
            slots.append((a, int(met[a]), int(met[a]) + times, base - int(met[a]), offset))
            met[a] += times
            offset += a
        base += times
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    placed = made.join(ahead, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("ahead"))
    # at most a few thousand rows: the plan has about as many fillings as there are lengths
    where = spark.createDataFrame(slots, "length long, low long, high long, shift long, offset long")
    fits = (placed["length"] == where["length"]) & (placed["rank"] >= where["low"]) & (placed["rank"] < where["high"])
    return placed.join(F.broadcast(where), fits).select("doc_id", "piece", "start", placed["length"], "ids_crc32", (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset")
