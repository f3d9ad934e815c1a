"""A hierarchical Pitman-Yor language model whose seating is sampled over the whole corpus.

Restaurants: a word is drawn in the context of the word before it. Each word of the training texts has a restaurant of its
own, and so has the begin of a text; they share the parent, whose dishes are the words, over a base that is uniform over the
vocabulary and one unknown word. A context that the training texts lack is its parent.

Words are counted first. Those that come twice or more have places in arrays of totals (customers and tables of each
restaurant), which go to every task; a restaurant with one customer has one table, whatever is drawn. A corpus with more
than MOST_WORDS such words gives places to the most frequent; the restaurants of the rest are told by the words' hashes, and
their totals are added up by ranges of hashes and sent back to the buckets that need them, after each sweep. Every word has
a restaurant of its own either way, and the same seats.
What grows without bound are the dishes in the restaurants, and those are dealt out by word: all seats of a word lie in one
bucket; very common words are parted by context.

The corpus is read once more, into blocks that hold each text as numbers of the block's different pairs of word and context.
A block sends its pairs with their counts to the words' buckets (a row for each bucket that it has pairs for, so never more
rows than pairs), and each bucket sends their probabilities back.

Seating is sampled by Gibbs sweeps over dishes: the tables of one dish in one restaurant are taken out, of the restaurant
and of its parent, and their number is drawn anew from its law given all others. Restaurants' totals are those after the
sweep before, summed over all buckets, and chance is a function of word, context and sweep: results do not depend on how
words are dealt out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import WordHashes, fold, stored, stored_by, tasks_for, used_up

#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK_BYTES = 9_000_000
#: Discount and strength of the root and of contexts.
DISCOUNTS, STRENGTHS = (0.75, 0.8), (20.0, 3.0)
#: Sweeps before and while probabilities are averaged.
BURN_IN, SAMPLES = 1, 2
#: The law of the number of tables is taken as it is for so many customers, and in its limit for more.
EXACT = 256
#: Words with a place of their own in the arrays of totals, at most; and places where those of rarer words are only counted.
MOST_WORDS, SHARED = 1 << 22, 1 << 16
#: Different words that a task counts before it gives what it has.
COUNTED = 300_000
#: Restaurants in one row of totals, as a power of two.
PART_BITS = 16
#: Buckets for each shuffle partition: a task has one at a time in memory; and bytes of text for each bucket at most.
BUCKETS, BUCKET_BYTES = 4, 32_000_000
#: A word is parted by context if it is more than this part of a bucket's fair share.
HOT_SHARE = 0.25

#: The end as a word, and the begin as a context.
_END, _START = xxhash.xxh64_intdigest(b" "), 1
#: Numbers of contexts without a place: their hash with this bit.
_REST = np.uint64(1 << 63)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Vocabulary:
    """Numbers of contexts: 0 without customers, then those with places of their own, then those that come once. words and
    counts: of all words that precede a token in the training texts. least: how often words with a place come. If shared,
    words and counts are those with a place only, and other contexts are numbered by their hash."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, least: int = 2, shared: int = 0):
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        self.own, self.shared = words[counts >= least], shared
        self.single = words[counts == 1] if not shared else np.zeros(0, np.uint64)
        #: Places in arrays of totals: the last stands for all restaurants with one customer.
        self.places = 1 + len(self.own) + shared + 1
        #: What chance knows words with a place by.
        self.marks = self.own.astype(np.uint32)

    def contexts(self, words: np.ndarray) -> np.ndarray:
        out = words | _REST if self.shared else np.zeros(len(words), np.uint32)
        for known, begin in ((self.own, 1), (self.single, self.places - 1)):
            if len(known):
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                hit = known[at] == words
                out[hit] = begin + at[hit]
        return out


def counted_words(texts: DataFrame) -> DataFrame:
    """texts: text, held_out. word (the bits of its number as a signed long) and n: how often each word, and the begin of a
    text, comes before a token of a training text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, begins = Counter(), 0

        def give() -> pa.RecordBatch:
            n = np.fromiter(counts.values(), np.int64, len(counts))
            words = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if not held:
                    counts.update((text.as_py() or b"").lower().split())
                    begins += 1
                    if len(counts) > COUNTED:
                        yield give()
        if counts:
            yield give()
        yield pa.RecordBatch.from_arrays([pa.array([_START], pa.int64()), pa.array([begins], pa.int64())], ["word", "n"])

    return texts.select("text", "held_out").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """At most MOST_WORDS words with a place go through the driver, and as many that come once."""
    steps = range(1, 48)
    found = counts.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("n") >= 1 << k).alias(f"n{k}") for k in steps]).first()
    fits = found["n1"] <= MOST_WORDS and found["all"] - found["n1"] <= MOST_WORDS
    least = 2 if fits else 1 << next(k for k in steps if found[f"n{k}"] <= MOST_WORDS)
    got = counts.filter(F.col("n") >= (1 if fits else least)).toArrow()
    words, n = got.column("word").to_numpy().view(np.uint64), got.column("n").to_numpy()
    return Vocabulary(words, n, least, 0 if fits else SHARED)


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned numbers by planes of bytes, which compress well if most are small."""
    kind = np.dtype(f"<u{numbers.dtype.itemsize}")
    return numbers.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chance(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number from 0 to 1 for each key, never 0."""
    return ((_mixed(keys + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


# ---- tables of a dish ----


def _log_stirling(most: int, discount: float) -> np.ndarray:
    """Row c, column t: log of the generalised Stirling number of seating c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for c in range(most):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = out[c, 1 : c + 2] + np.log(np.maximum(c - discount * t, 0))
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], np.where(c - discount * t > 0, stay, -np.inf))
    return out


_STIRLING: dict[float, np.ndarray] = {}


def _quantile(mean: np.ndarray, chance: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Poisson numbers: by summing probabilities for small means, and by rounding a normal number for large ones."""
    out = np.maximum(np.rint(mean + np.sqrt(mean) * np.sqrt(-2 * np.log(chance)) * np.cos(2 * np.pi * other)), 0).astype(np.int64)
    small = np.flatnonzero(mean < 50)
    if len(small):
        p, k = np.exp(-mean[small]), np.zeros(len(small), np.int64)
        total, left = p.copy(), np.arange(len(small))
        for step in range(1, 200):
            left = left[chance[small[left]] > total[left]]
            if not len(left):
                break
            p[left] *= mean[small[left]] / step
            total[left] += p[left]
            k[left] = step
        out[small] = k
    return out


def seat(customers: np.ndarray, strength: np.ndarray, parent: np.ndarray, discount: float, keys: np.ndarray, salt: int) -> np.ndarray:
    """Of each dish the number of tables, drawn from its law given what is seated elsewhere.

    strength: the restaurant's strength and the discount of all tables of other dishes; parent: the parent's probability
    of the dish without these customers. The law of t tables is S(c, t) parent^t times the product of strength + discount
    i over i < t, with S the generalised Stirling numbers: what sitting down one by one gives, in any order. For over EXACT
    customers, t - 1 is Poisson in the limit, of the mean that tables have if their sizes add up to the customers.
    """
    tables = np.minimum(customers, 1)
    many = customers > 1
    exact = np.flatnonzero(many & (customers <= EXACT))
    if len(exact):
        if discount not in _STIRLING:
            _STIRLING[discount] = _log_stirling(EXACT, discount)
        table, draw = _STIRLING[discount], _chance(keys, salt)
        order = exact[np.argsort(customers[exact], kind="stable")]
        sizes, first = np.unique(customers[order], return_index=True)
        for c, at in zip(sizes.tolist(), np.split(order, first[1:]), strict=True):
            for some in np.array_split(at, max(1, len(at) * c // 2_000_000)):
                logs = np.log(strength[some][:, None] + discount * np.arange(c)) + np.log(parent[some])[:, None]
                weight = table[c, 1 : c + 1] + np.cumsum(logs, 1)
                weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
                tables[some] = 1 + (weight < (draw[some] * weight[:, -1])[:, None]).sum(1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        c, mean = customers[large].astype(np.float64), np.zeros(len(large))
        for _ in range(4):  # the strength grows with the tables
            rate = (strength[large] + discount * mean) * parent[large]
            low, high = np.zeros(len(large)), np.ones(len(large))
            for _ in range(50):  # rate x (1 - x)^(discount - 1) = c; tables are fewer where customers run out
                x = (low + high) / 2
                with np.errstate(divide="ignore"):
                    over = rate * x * (1 - x) ** (discount - 1) > c
                low, high = np.where(over, low, x), np.where(over, x, high)
            mean = rate / discount * (1 - (1 - high) ** discount)
        tables[large] = 1 + np.minimum(_quantile(mean, _chance(keys[large], salt), _chance(keys[large], salt + 1)), customers[large] - 1)
    return tables


# ---- blocks ----

_ROW = "block long, bucket int, a binary, b binary, c binary, d binary"
_KINDS = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
_NAMES = ["block", "bucket", "a", "b", "c", "d"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], _NAMES)


def bucket_of(word: np.ndarray, context: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """By word; of hot words, by word and a part of the contexts. hot: whether each word is."""
    key = np.where(hot, _mixed(word + (_mixed(context.astype(np.uint64)) % np.uint64(4 * buckets) + np.uint64(1)) * _K1), word)
    return (_mixed(key) % np.uint64(buckets)).astype(np.int64)


class Numbers(dict):
    """Words of a block by numbers in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int, vocabulary: Vocabulary, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """doc_id, text, held_out -> for each block its texts (bucket -1) and, for each bucket, its pairs."""
    hashes, part, made = WordHashes(), TaskContext.get().partitionId(), 0
    ids: list = []
    held: list[bool] = []
    tokens: list[np.ndarray] = []
    numbers = Numbers()
    end, size = np.int32([numbers[b" "]]), 0

    def give() -> pa.RecordBatch:
        block = part << 32 | made
        n = np.array([len(t) for t in tokens])
        own = np.concatenate(tokens)
        tokens.clear()
        # words and contexts by their rank, so that both make one number
        word = hashes.of(list(numbers))
        slots = np.append(vocabulary.contexts(word), vocabulary.contexts(np.array([_START], np.uint64)))
        order = np.argsort(word)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        contexts, slot = np.unique(slots, return_inverse=True)
        before = np.empty(len(own), np.int64)
        before[1:] = slot[own[:-1]]
        before[np.cumsum(n) - n] = slot[-1]
        key, of = np.unique(rank[own] << 32 | before, return_inverse=True)
        del before, own
        train = np.repeat(~np.array(held), n)
        count = np.bincount(of[train], minlength=len(key))
        w_all, u_all = word[order][key >> 32], contexts[key & (1 << 32) - 1]
        bucket = bucket_of(w_all, u_all, buckets, np.isin(word, hot)[order][key >> 32])
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        of = place[of]
        bucket, w_all, u_all, count = bucket[order], w_all[order], u_all[order], count[order]
        # texts: the pairs of each in order, as differences; sums need no other order
        last = np.cumsum(n)
        of = np.sort(np.repeat(np.arange(len(n)), n) << 32 | of) & (1 << 32) - 1
        step = np.diff(of, prepend=0)
        step[last[:-1]] = of[last[:-1]]
        who = np.array([0 if i is None else i for i in ids], np.int64)
        none = np.array([i is None for i in ids])
        rows = [(block, -1, who.tobytes(), none.tobytes() + np.array(held).tobytes(), n.astype(np.int64).tobytes(), _planes(step.astype(np.uint32)))]
        at = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(at)).tolist():
            w, u, c = w_all[at[b] : at[b + 1]], u_all[at[b] : at[b + 1]], count[at[b] : at[b + 1]]
            new = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            rows.append((block, b, w[new].tobytes(), _planes(np.diff(np.append(new, len(w))).astype(np.uint32)), _planes(u), _planes(c.astype(np.uint32))))
        return _batch(rows)

    for batch in batches:
        for doc_id, text, held_out in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = (text.as_py() or b"").lower().split()
            ids.append(doc_id)
            held.append(held_out)
            tokens.append(np.append(numbers.of(words), end))
            size += sum(map(len, words)) + len(words)
            if size >= BLOCK_BYTES:
                yield give()
                made, size = made + 1, 0
                ids.clear(), held.clear(), numbers.clear()
                end = np.int32([numbers[b" "]])
    if ids:
        yield give()


# ---- buckets ----


class Bucket:
    """All seats of some words, in the order of word and context. places, marks, shared: of Vocabulary. Totals of contexts
    without a place are given as rest: customers and tables of rest_words, for each state."""

    def __init__(self, word: np.ndarray, context: np.ndarray, count: np.ndarray, places: int, hot: np.ndarray | None = None, marks: np.ndarray | None = None, shared: int = 0):
        self.hot = np.zeros(0, np.uint64) if hot is None else hot
        self.count = count.astype(np.int64)
        self.rest = np.flatnonzero(context >= _REST) if shared else np.zeros(0, np.int64)
        self.rest_words, self.rest_of = np.unique(context[self.rest], return_inverse=True)
        self.place = np.minimum(context & ~_REST if shared else context, places - 1).astype(np.int64)
        if shared:
            self.place[self.rest] = places - 1 - shared + ((context[self.rest] & ~_REST) >> np.uint64(40)).astype(np.int64) % shared
            self.rest_at = np.full(len(context), -1)
            self.rest_at[self.rest] = self.rest_of
        new = np.concatenate([[True], word[1:] != word[:-1]])
        self.begin = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.word = word[new]
        self.n = np.add.reduceat(self.count, self.begin)
        # where each word is among the hot ones, else the number of those
        at = np.searchsorted(self.hot, self.word)
        same = np.append(self.hot, np.uint64(0))[at] == self.word
        self.is_hot = same & (at < len(self.hot))
        self.hot_at = at[self.is_hot]
        self.some = np.flatnonzero(self.count > 1)  # one customer is at one table
        mark, place = context[self.some].astype(np.uint32).astype(np.uint64), self.place[self.some]
        if marks is not None:
            own = np.flatnonzero((place > 0) & (place <= len(marks)))
            mark[own] = marks[place[own] - 1]
        self.keys = [_mixed(self.word * _K1), _mixed(word[self.some] * _K1 + np.uint64(1)) ^ (mark * _K2)]

    def totals_of(self, by_place: np.ndarray, rest: np.ndarray | None, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Of pairs their contexts' customers or tables. rest: those of rest_words."""
        out = by_place[self.place[some]]
        if len(self.rest):
            at = self.rest_at[some]
            out = np.where(at >= 0, rest[at], out)
        return out

    def rest_sums(self, t: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of rest_words in this bucket."""
        out = np.zeros((2, len(self.rest_words)), np.int64)
        np.add.at(out[0], self.rest_of, self.count[self.rest])
        np.add.at(out[1], self.rest_of, t[1][self.rest])
        return out[0], out[1]

    def states(self, known: list[Totals], sweeps: int, rest: list = ()) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Customers and tables of words at the root and of pairs, after so many sweeps. known: the corpus's totals before
        each. The same each time it is run anew."""
        *_, last = self.chain(known, sweeps, rest)
        return last

    def chain(self, known: list[Totals], sweeps: int, rest: list = ()) -> Iterator[tuple[list[np.ndarray], list[np.ndarray]]]:
        """The states at first and after each sweep."""
        t1 = np.minimum(self.count, 1)
        c0 = np.add.reduceat(t1, self.begin)
        t0 = np.minimum(c0, 1)
        yield [c0, self.count], [t0, t1]
        some = self.some
        for sweep in range(sweeps):
            at = known[sweep]
            c0 = at.root(self, c0)
            t0 = np.clip(t0, np.minimum(c0, 1), c0)
            # a dish's tables are no customers of its parent while they are drawn
            of, gone = self.of[some], t1[some]
            left = c0[of] - gone
            kept = np.minimum(t0[of], left)
            p0 = at.at_root(left, kept, gone, t0[of] - kept)
            t1 = t1.copy()
            others = self.totals_of(at.tables, rest[sweep][1] if rest else None, some) - gone
            t1[some] = seat(self.count[some], STRENGTHS[1] + DISCOUNTS[1] * others, p0, DISCOUNTS[1], self.keys[1], 8 * sweep)
            # the root's customers of this sweep are known once all buckets are through, for words that are in several
            t0 = seat(c0, STRENGTHS[0] + DISCOUNTS[0] * (at.root_tables - t0), np.full(len(t0), at.base), DISCOUNTS[0], self.keys[0], 8 * sweep + 2)
            c0 = np.add.reduceat(t1, self.begin)
            yield [c0, self.count], [t0, t1]

    def predicted(self, at: Totals, c: list[np.ndarray], t: list[np.ndarray], rest: tuple = (None, None)) -> np.ndarray:
        """The probability of each pair's word in its context. at, rest: the totals of this state."""
        c0 = at.root(self, c[0])
        below = at.at_root(c0, np.minimum(t[0], c0))[self.of]
        return in_restaurant(self.totals_of(at.customers, rest[0]), self.totals_of(at.tables, rest[1]), c[1], t[1], below)


def in_restaurant(customers: np.ndarray, tables: np.ndarray, c: np.ndarray, t: np.ndarray, below: np.ndarray | float) -> np.ndarray:
    """Probability of a dish with c customers at t tables in restaurants with so many of both. below: the parent's."""
    d, s = DISCOUNTS[1], STRENGTHS[1]
    return (np.maximum(c - d * t, 0) + (s + d * tables) * below) / (s + customers)


class Totals:
    """Customers and tables of the corpus's restaurants by their place, and of the root; of hot words their customers at the
    root, their tables there and their counts."""

    def __init__(self, places: int, n_hot: int):
        self.customers, self.tables = np.zeros(places, np.int64), np.zeros(places, np.int64)
        self.hot, self.base, self.tokens, self.words = np.zeros((3, n_hot), np.int64), 1.0, 0, 0
        self.root_customers = self.root_tables = 0

    def root(self, bucket: Bucket, own: np.ndarray) -> np.ndarray:
        """Customers of a bucket's words at the root."""
        out = own.copy()
        out[bucket.is_hot] = self.hot[0][bucket.hot_at]
        return out

    def at_root(self, c: np.ndarray, t: np.ndarray, fewer: np.ndarray | int = 0, fewer_tables: np.ndarray | int = 0) -> np.ndarray:
        """Probability at the root of a dish with c customers at t tables, without so many of the root's customers and tables."""
        d, s = DISCOUNTS[0], STRENGTHS[0]
        return (np.maximum(c - d * t, 0) + (s + d * (self.root_tables - fewer_tables)) * self.base) / (s + self.root_customers - fewer)

    def in_context(self, place: np.ndarray, c: np.ndarray, t: np.ndarray, below: np.ndarray | float) -> np.ndarray:
        """Probability of a dish with c customers at t tables in the restaurants at these places."""
        return in_restaurant(self.customers[place], self.tables[place], c, t, below)


def _zip(x: np.ndarray) -> bytes:
    return zlib.compress(_planes(x.astype(np.uint64)), 1)


def _unzip(x: bytes) -> np.ndarray:
    return _numbers(zlib.decompress(x), "<u8").astype(np.int64)


_TOTAL = "level int, part int, salt int, customers binary, tables binary"
#: Rows of one part of the totals are added in so many groups first.
SALTS = 32


class Sums:
    """What the corpus's totals need of some buckets, added up: rows of level, part, salt, customers and tables; level 0: the
    root, 1: contexts, 3: N and V, 4: hot words."""

    def __init__(self, places: int, n_hot: int):
        self.all = Totals(places, n_hot)

    def add(self, bucket: Bucket, c: list[np.ndarray], t: list[np.ndarray]) -> None:
        cold, out = ~bucket.is_hot, self.all
        out.tokens, out.words = out.tokens + int(bucket.count.sum()), out.words + int((bucket.n[cold] > 0).sum())
        out.root_customers += int(c[0][cold].sum())
        out.root_tables += int(t[0][cold].sum())
        np.add.at(out.customers, bucket.place, c[1])
        np.add.at(out.tables, bucket.place, t[1])
        hot, at = bucket.is_hot, bucket.hot_at
        out.hot[0][at] += c[0][hot]
        out.hot[1][at] = np.maximum(out.hot[1][at], t[0][hot])  # a hot word's tables are the same in all buckets
        out.hot[2][at] += bucket.n[hot]

    def rows(self, salt: int = 0) -> list[tuple[int, int, int, bytes, bytes]]:
        out = self.all
        one = lambda x: _zip(np.array([x]))
        rows = [(0, 0, salt, one(out.root_customers), one(out.root_tables)), (3, 0, salt, one(out.tokens), one(out.words))]
        for begin in range(0, len(out.customers), 1 << PART_BITS):
            own = [x[begin : begin + (1 << PART_BITS)] for x in (out.customers, out.tables)]
            if own[0].any():
                rows.append((1, begin >> PART_BITS, salt, *map(_zip, own)))
        if out.hot.size:
            rows.append((4, 0, salt, _zip(out.hot[[0, 2]].ravel()), _zip(out.hot[1])))
        return rows


def _total_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["level", "part", "salt", "customers", "tables"])


def _added(key: tuple, rows: pa.Table) -> pa.Table:
    level, part = key[0].as_py(), key[1].as_py()
    customers = tables = None
    for c, t in zip(rows.column("customers"), rows.column("tables"), strict=True):
        own = _unzip(c.as_py()), _unzip(t.as_py())
        customers = own[0] if customers is None else customers + own[0]
        tables = own[1] if tables is None else np.maximum(tables, own[1]) if level == 4 else tables + own[1]
    return pa.Table.from_batches([_total_batch([(level, part, 0, _zip(customers), _zip(tables))])])


def totals(rows: list, places: int, n_hot: int) -> Totals:
    """From summed rows; two numbers for each place."""
    out = Totals(places, n_hot)
    for level, part, _, customers, tables in rows:
        c, t = _unzip(customers), _unzip(tables)
        if level == 0:
            out.root_customers, out.root_tables = int(c[0]), int(t[0])
        elif level == 3:
            out.tokens, out.words = int(c[0]), int(t[0])
        elif level == 4:
            out.hot[0], out.hot[2], out.hot[1] = c[:n_hot], c[n_hot:], t
        else:
            begin = part << PART_BITS
            out.customers[begin : begin + len(c)], out.tables[begin : begin + len(t)] = c, t
    out.root_customers += int(out.hot[0].sum())
    out.root_tables += int(out.hot[1].sum())
    out.words += int((out.hot[2] > 0).sum())
    out.base = 1 / (out.words + 1)
    # nobody is in a restaurant that is none, and one at one table in those that share the last place
    for x in (out.customers, out.tables):
        x[0], x[-1] = 0, 1
    kind = np.int32 if out.customers.max() < 1 << 31 else np.int64
    out.customers, out.tables = out.customers.astype(kind), out.tables.astype(kind)
    return out


def _gathered(key: tuple, rows: pa.Table) -> pa.Table:
    """A bucket's pairs as one row, each pair once: words, contexts and counts; and where each block's pairs are in it."""
    parts = sorted(zip(*(rows.column(x).to_pylist() for x in ("block", "a", "b", "c", "d")), strict=True), key=lambda x: x[0])
    word = np.concatenate([np.repeat(np.frombuffer(a, np.uint64), _numbers(b, "<u4")) for _, a, b, _, _ in parts])
    context = np.concatenate([_contexts(c, len(d) // 4) for *_, c, d in parts])
    count = np.concatenate([_numbers(d, "<u4") for *_, d in parts])
    sizes = np.array([len(p[4]) // 4 for p in parts])
    different, rank = np.unique(word, return_inverse=True)
    order = np.argsort(rank << 32 | (context if context.itemsize == 4 else np.unique(context, return_inverse=True)[1]), kind="stable")
    del different, rank
    w, u = word[order], context[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (u[1:] != u[:-1])])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    total = np.add.reduceat(count[order].astype(np.int64), first)
    w, u = w[first], u[first]
    begin = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    step = np.diff(at, prepend=0)
    ends = np.cumsum(sizes)[:-1]
    step[ends] = at[ends]  # each block's places rise from its first
    row = (w[begin].tobytes(), _planes(np.diff(np.append(begin, len(w))).astype(np.uint32)), _planes(u), _planes(total.astype(np.uint64)))
    row += (np.array([p[0] for p in parts], np.int64).tobytes(), sizes.astype(np.int64).tobytes(), _planes(step.astype(np.uint32)))
    return pa.table([pa.array([key[0].as_py()], pa.int32()), *[pa.array([x], pa.binary()) for x in row]], ["bucket", *"abcdefg"])


_GATHERED = "bucket int, " + ", ".join(f"{c} binary" for c in "abcdefg")


def _contexts(planes: bytes, n: int) -> np.ndarray:
    return _numbers(planes, f"<u{len(planes) // n}")


#: What buckets know of a vocabulary: places, hot words, marks and shared.
Known = tuple[int, np.ndarray, np.ndarray, int]


def _bucket(batch: pa.RecordBatch, row: int, of: Known) -> tuple[Bucket, list]:
    """A gathered row's bucket, and the totals of its contexts without a place, from the columns after the gathered ones."""
    a, b, c, d = (batch.column(k)[row].as_py() for k in range(1, 5))
    own = Bucket(np.repeat(np.frombuffer(a, np.uint64), _numbers(b, "<u4")), _contexts(c, len(d) // 8), _numbers(d, "<u8").astype(np.int64), *of)
    told = (batch.column(k)[row].as_py() for k in range(8, batch.num_columns))
    return own, [np.split(_unzip(x), 2) if x else np.zeros((2, 0), np.int64) for x in told]


#: Level of rows for contexts without a place: part, bucket, hashes, and customers and tables one after the other.
_OF_REST = 5


def _summed(batches: Iterator[pa.RecordBatch], of: Known, known: list[Totals], parts: int) -> Iterator[pa.RecordBatch]:
    """Gathered rows -> the sums of a task's buckets, and of each bucket those of its contexts without a place, by parts."""
    total, some = Sums(of[0], len(of[1])), False
    for batch in batches:
        for row in range(batch.num_rows):
            own, rest = _bucket(batch, row, of)
            c, t = own.states(known, len(known), rest)
            total.add(own, c, t)
            some = True
            if len(own.rest):
                customers, tables = own.rest_sums(t)
                part = (((own.rest_words & ~_REST) >> np.uint64(31)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                at = np.searchsorted(part, np.arange(parts + 1))
                bucket = batch.column(0)[row].as_py()
                yield _total_batch([(_OF_REST, p, bucket, _zip(own.rest_words[at[p] : at[p + 1]]), _zip(np.append(customers[at[p] : at[p + 1]], tables[at[p] : at[p + 1]]))) for p in np.flatnonzero(np.diff(at)).tolist()])
    if some:
        yield _total_batch(total.rows(TaskContext.get().partitionId() % SALTS))


def _rest_added(key: tuple, rows: pa.Table) -> pa.Table:
    """Of one part the contexts' totals over all buckets, for each bucket in the order in which it sent them."""
    words = [_unzip(x.as_py()) for x in rows.column("customers")]
    sums = [np.split(_unzip(x.as_py()), 2) for x in rows.column("tables")]
    different, of = np.unique(np.concatenate(words), return_inverse=True)
    out = np.zeros((2, len(different)), np.int64)
    for k in range(2):
        np.add.at(out[k], of, np.concatenate([x[k] for x in sums]))
    ends = np.cumsum([len(x) for x in words])[:-1]
    found = [_zip(out[:, x].ravel()) for x in np.split(of, ends)]
    return pa.table([rows.column("salt"), rows.column("part"), pa.array(found, pa.binary())], ["bucket", "part", "told"])


def _rest_told(key: tuple, rows: pa.Table) -> pa.Table:
    """A bucket's totals from all parts as one row."""
    parts = sorted(zip(rows.column("part").to_pylist(), rows.column("told").to_pylist(), strict=True))
    told = np.concatenate([_unzip(x).reshape(2, -1) for _, x in parts], 1)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([_zip(told.ravel())], pa.binary())], ["bucket", "told"])


def _answers(batches: Iterator[pa.RecordBatch], of: Known, known: list[Totals]) -> Iterator[pa.RecordBatch]:
    """known: totals before each sweep and after the last. For each block: log10 of the averaged probability and, for the
    base score, the count of the word of each pair."""
    for batch in batches:
        for row in range(batch.num_rows):
            bucket, blocks, sizes, steps = (batch.column(k)[row].as_py() for k in (0, 5, 6, 7))
            own, rest = _bucket(batch, row, of)
            mean = 0
            for k, state in enumerate(own.chain(known, BURN_IN + SAMPLES, rest)):
                if k > BURN_IN:
                    mean = mean + own.predicted(known[k], *state, *rest[k : k + 1]) / SAMPLES
            n = own.n.copy()
            n[own.is_hot] = known[0].hot[2][own.hot_at]
            found, counts = np.log10(mean).astype("<f4"), n[own.of].astype(np.uint32)
            steps, begin = _numbers(steps, "<u4").view(np.int32).astype(np.int64), 0
            for block, size in zip(np.frombuffer(blocks, np.int64).tolist(), np.frombuffer(sizes, np.int64).tolist(), strict=True):
                at = np.cumsum(steps[begin : begin + size])
                begin += size
                yield _batch([(block, bucket, found[at].tobytes(), _planes(counts[at]), b"", b"")])


def _scored(rows: pa.Table, train_tokens: int, distinct: int) -> pa.Table:
    """A block's texts and the answers to its pairs, in the order of buckets -> one row for each text."""
    parts = sorted(zip(*(rows.column(x).to_pylist() for x in ("bucket", "a", "b", "c", "d")), strict=True), key=lambda x: x[0])
    _, who, flags, n, steps = parts[0]
    ids, flags, n = np.frombuffer(who, np.int64), np.frombuffer(flags, np.bool_).reshape(2, -1), np.frombuffer(n, np.int64)
    of = _numbers(steps, "<u4").astype(np.int64)
    begin = np.cumsum(n) - n
    of = np.cumsum(of)
    before = np.where(begin > 0, of[begin - 1], 0)
    of -= np.repeat(before, n)
    found = np.concatenate([np.frombuffer(p[1], "<f4") for p in parts[1:]]).astype(np.float64)
    count = np.concatenate([_numbers(p[2], "<u4") for p in parts[1:]])
    base = np.log10((count + 0.5) / (train_tokens + 0.5 * (distinct + 1)))
    total = lambda x: np.add.reduceat(x[of], begin)
    cols = [pa.array(ids, mask=flags[0]), pa.array(flags[1]), pa.array(n), pa.array(total((count > 0).astype(np.int64))), pa.array(np.full(len(n), train_tokens)), pa.array(total(base)), pa.array(total(found))]
    return pa.table(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def hot_words(counts: DataFrame, tokens: int, buckets: int) -> np.ndarray:
    """Numbers of the words that are over HOT_SHARE of a bucket's share; they are only dealt out otherwise. So there are at
    most buckets / HOT_SHARE of them."""
    rows = counts.filter((F.col("n") > HOT_SHARE * tokens / buckets) & (F.col("n") > 100)).select("word").collect()
    return np.unique(np.array([_END, *(r.word & (1 << 64) - 1 for r in rows)], np.uint64))


def score(docs: DataFrame, held_out: str = "held_out", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows whose column `held_out` is false, and scores all: score is log10 of the text's
    probability, each word's averaged over samples of the seating (perplexity is 10 to the power of -score / n_tokens);
    base_score that of single words with half a count added. Null and empty texts are one token, the end. Null ids and
    repeated rows are kept (repeated rows count twice); an empty table gives an empty result. Other columns are not looked
    at. The number of shuffle partitions sets that of buckets, and has no part in the scores.
    """
    flags = docs.select(F.col(id_col), F.col(text_col), F.col(held_out).alias("_held"))
    texts = flags.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.coalesce("_held", F.lit(False)).alias("held_out"))
    counts = stored(counted_words(texts), "words")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(BUCKETS * tasks_for(docs.sparkSession), -(-size // BUCKET_BYTES))
    tokens = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words, hot = vocabulary(counts), hot_words(counts, tokens, buckets)
    places = words.places
    of = places, hot, words.marks, words.shared
    blocks = texts.mapInArrow(lambda b: _blocks(b, buckets, words, hot), _ROW)
    made = stored_by(blocks.withColumn("kind", F.when(F.col("bucket") < 0, "text").otherwise("pairs")), "blocks", "kind", ("text", "pairs"))
    gathered = stored(made["pairs"].groupBy("bucket").applyInArrow(_gathered, _GATHERED), "gathered")
    used_up(made["pairs"])
    known: list[Totals] = []
    for sweep in range(BURN_IN + SAMPLES + 1):
        partial = gathered.mapInArrow(lambda b, known=tuple(known): _summed(b, of, known, buckets), _TOTAL)
        if words.shared:
            partial = stored(partial, "sums")
            rest = partial.filter(F.col("level") == _OF_REST).groupBy("part").applyInArrow(_rest_added, "bucket int, part int, told binary")
            told = stored(rest.groupBy("bucket").applyInArrow(_rest_told, "bucket int, told binary"), "rest")
            gathered = gathered.join(told.withColumnRenamed("told", f"told{sweep}"), "bucket", "left")
        added = partial.filter(F.col("level") != _OF_REST).groupBy("level", "part", "salt").applyInArrow(_added, _TOTAL).groupBy("level", "part").applyInArrow(_added, _TOTAL)
        known.append(totals(added.collect(), places, len(hot)))
        known[-1].customers = known[0].customers  # the texts' words: the same in all sweeps, and sent to tasks once
    train_tokens, distinct = known[0].tokens, known[0].words
    answers = gathered.mapInArrow(lambda b: _answers(b, of, known), _ROW)
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return made["text"].union(answers).groupBy("block").applyInArrow(lambda rows: _scored(rows, train_tokens, distinct), result)


def score_folds(docs: DataFrame, of: int = 5, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """score(), holding out the rows whose crc32 of the id as text, modulo `of`, is `held`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score(rows.withColumn("held_out", fold("doc_id", of) == held))
