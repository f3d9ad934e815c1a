"""Toxicity: a bidirectional gated recurrent network with attention pooling, over character and word inputs, in numpy.

Every text is cut into overlapping windows of words, all of them are scored, and the windows' scores make the text's.
A word's inputs are vectors of its hash and of the runs of bytes in it, learned with the network, and how often words and
runs are in toxic and in clean texts.

Training is on the driver, on a bounded sample of labelled texts; executors count words and runs, choose windows and score
them, so the driver gets counts, a few windows of each text and four numbers for it, never texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import WordHashes, chunks, id_and_text, stored

#: Words of a window and from one window to the next.
WINDOW, STRIDE = 32, 16
#: Hashed words and hashed runs of 3 to 7 bytes of words, as powers of two.
WORD_BITS, RUN_BITS = 16, 17
RUNS = (3, 4, 5, 6, 7)
HIDDEN, ATTENTION, LEARNED = 8, 8, 4
#: Steps of the words' and runs' vectors, as a share of the network's: each vector is seen by few texts.
LEARN_RATE = 0.1
#: Windows of a labelled text that training sees, those that look worst by their words' odds.
CANDIDATES = 8
#: Labelled texts of each class from which the network learns, at most, and the longest of them in bytes.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_BYTES = 1500, 3000, 60_000
PREDICT_AT = 0.7
#: A toxic text that is missed weighs as much as so many clean ones that are taken for one: scores are chances under that
#: weight, so that PREDICT_AT is where it says.
MISSED = 9
#: What is worked on at once, for memory's sake.
WORDS_AT_ONCE, WINDOWS_AT_ONCE, TEXTS_AT_ONCE = 50_000, 5_000, 64

_FIXED = 4
_INPUTS = _FIXED + 2 * LEARNED
_STRIP = bytes(range(33)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _unique(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words of texts (lower-cased, without marks around them), the number of each text's words in it one after
    another, and the texts' numbers of words."""
    place: dict[bytes, int] = {}
    at, n = [], []
    for text in texts:
        words = text.lower().split()
        n.append(len(words))
        at += [place.setdefault(w, len(place)) for w in words]
    return [w.strip(_STRIP) for w in place], np.array(at, np.int64), np.array(n, np.int64)


def _hashes(words: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words; buckets of their byte runs one after another, and the word of each run."""
    word = (known.of(words) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    marked = [b"^" + w + b"$" for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    of, end = np.repeat(np.arange(len(words)), size), np.repeat(np.cumsum(size), size)
    value, runs, owner = np.zeros(len(raw), np.uint32), [], []
    for k in range(1, max(RUNS) + 1):
        m = len(raw) - k + 1
        if m <= 0:
            break
        value = value[:m] * np.uint32(0x01000193) + raw[k - 1 :]
        if k in RUNS:
            inside = np.flatnonzero(np.arange(m) + k <= end[:m])
            mixed = (value[inside] ^ (value[inside] >> np.uint32(15)) ^ np.uint32(k)) * np.uint32(0x9E3779B1)
            runs.append((mixed >> np.uint32(32 - RUN_BITS)).astype(np.int64))
            owner.append(of[inside])
    return word, np.concatenate(runs) if runs else np.zeros(0, np.int64), np.concatenate(owner) if owner else np.zeros(0, np.int64)


def _text_counts(texts: list[bytes], group: np.ndarray, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """For each of four groups of texts, the texts that have each bucket: of words, and of runs. A few texts at a time."""
    out = np.zeros((4, 1 << WORD_BITS), np.int64), np.zeros((4, 1 << RUN_BITS), np.int64)
    for k in range(0, len(texts), TEXTS_AT_ONCE):
        words, at, n = _unique(texts[k : k + TEXTS_AT_ONCE])
        word, run, owner = _hashes(words, known)
        order = np.argsort(owner, kind="stable")
        first = np.searchsorted(owner[order], np.arange(len(words) + 1))
        once = np.unique(np.repeat(np.arange(len(n)), n) << np.int64(32) | at)
        doc, w = once >> 32, once & 0xFFFFFFFF
        size = first[w + 1] - first[w]
        take = np.repeat(first[w] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        for total, owners, buckets in ((out[0], doc, word[w]), (out[1], np.repeat(doc, size), run[order[take]])):
            pair = np.unique(owners << np.int64(32) | buckets)
            np.add.at(total, (group[k + (pair >> 32)], pair & 0xFFFFFFFF), 1)
    return out


def _odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of buckets by the texts of each class that have them, drawn to 0 where they are few."""
    seen = toxic + clean
    found = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return (found * seen / (seen + 4)).astype(np.float32)


class Spelled:
    """Of some words: buckets of the words and of their byte runs, with where each word's runs begin; and what is known of
    them without learning: log odds of the word, the highest and the mean of its runs', and a share of its length."""

    def __init__(self, words: list[bytes], known: WordHashes, odds: tuple[np.ndarray, np.ndarray]):
        self.word, runs, owner = _hashes(words, known)
        order = np.argsort(owner, kind="stable")
        self.runs, owner = runs[order], owner[order]
        self.first = np.searchsorted(owner, np.arange(len(words) + 1))
        self.n = np.maximum(np.diff(self.first), 1)
        self.fixed = np.zeros((len(words), _FIXED), np.float32)
        self.fixed[:, 0] = odds[0][self.word]
        own = odds[1][self.runs]
        np.maximum.at(self.fixed[:, 1], owner, own)
        self.fixed[:, 2] = np.bincount(owner, weights=own, minlength=len(words)) / self.n
        self.fixed[:, 3] = np.minimum([len(w) / 20 for w in words], 2)

    def at(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of some words one after another, and which of these words has each."""
        size = self.first[some + 1] - self.first[some]
        owner = np.repeat(np.arange(len(some)), size)
        return self.runs[np.arange(len(owner)) + np.repeat(self.first[some] - (np.cumsum(size) - size), size)], owner


class Inputs:
    """Inputs of words: what Spelled knows, a learned vector of the word, and the mean of learned vectors of its runs."""

    def __init__(self, odds: tuple[np.ndarray, np.ndarray], word: np.ndarray | None = None, run: np.ndarray | None = None):
        rng = np.random.default_rng(7)
        self.odds = odds
        self.word = np.zeros((1 << WORD_BITS, LEARNED), np.float32) if word is None else word
        self.run = rng.normal(0, 1, (1 << RUN_BITS, LEARNED)).astype(np.float32) if run is None else run

    def of(self, words: list[bytes], known: WordHashes) -> np.ndarray:
        out = np.zeros((len(words), _INPUTS), np.float32)
        for k in range(0, len(words), WORDS_AT_ONCE):
            spelled = Spelled(words[k : k + WORDS_AT_ONCE], known, self.odds)
            out[k : k + WORDS_AT_ONCE] = self.table(spelled, np.arange(len(spelled.word)), spelled.fixed)
        return out

    def table(self, spelled: Spelled, some: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        out = np.zeros((len(some), _INPUTS), np.float32)
        out[:, :_FIXED] = fixed
        out[:, _FIXED : _FIXED + LEARNED] = self.word[spelled.word[some]]
        runs, owner = spelled.at(some)
        for k in range(LEARNED):
            out[:, _FIXED + LEARNED + k] = np.bincount(owner, weights=self.run[runs, k], minlength=len(some)) / spelled.n[some]
        return out

    def learn(self, spelled: Spelled, some: np.ndarray, grad: np.ndarray, rate: float, seen: dict[str, np.ndarray]) -> None:
        """One step against the gradient of some words' inputs, smaller for what has had many."""
        runs, owner = spelled.at(some)
        share = (grad[:, _FIXED + LEARNED :] / spelled.n[some][:, None])[owner]
        for name, table, at, g in (("word", self.word, spelled.word[some], grad[:, _FIXED : _FIXED + LEARNED]), ("run", self.run, runs, share)):
            which, place = np.unique(at, return_inverse=True)
            total = np.stack([np.bincount(place, weights=g[:, k], minlength=len(which)) for k in range(LEARNED)], 1)
            own = seen.setdefault(name, np.zeros(table.shape, np.float32))
            own[which] += (total * total).astype(np.float32)
            table[which] -= (rate * total / (np.sqrt(own[which]) + 1e-4)).astype(np.float32)


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of n words that lie one after another: the first word of each window, its words, and its text. A text
    without words has none; the last window ends with the text."""
    each = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(n)), each)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    begin = np.minimum(k * STRIDE, np.maximum(n[doc] - WINDOW, 0))
    return begin + (np.cumsum(n) - n)[doc], np.minimum(n, WINDOW)[doc], doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two gated recurrent layers that read a window in either direction, attention over their states, one output."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        mat = lambda a, b: (rng.normal(0, 1, (a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {}
        for way in "fb":
            self.p |= {f"x{way}": mat(_INPUTS, 3 * HIDDEN), f"h{way}": mat(HIDDEN, 3 * HIDDEN), f"c{way}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"wa": mat(2 * HIDDEN, ATTENTION), "va": mat(ATTENTION, 1), "out": mat(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}

    def _read(self, way: str, gates: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """gates: inputs' share of the gates, steps by windows. Returns the states of all steps."""
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        states = np.empty((len(gates), *h.shape), np.float32)
        u, last = self.p[f"h{way}"], 2 * HIDDEN
        for s in range(len(gates)) if way == "f" else range(len(gates) - 1, -1, -1):
            g, a = gates[s], h @ u
            zr = _sigmoid(g[:, :last] + a[:, :last])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, last:] + r * a[:, last:])
            new = np.where(mask[s], c + z * (h - c), h)
            if keep is not None:
                keep.append((s, h, z, r, c, a[:, last:]))
            states[s] = h = new
        return states

    def logits(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray, memory: dict | None = None) -> np.ndarray:
        """table: inputs of words; index: steps by windows, rows of the table; mask: which steps have a word."""
        three, both = mask[:, :, None], []
        for way in "fb":
            keep = [] if memory is not None else None
            few = index.size < len(table)
            gates = (table[index] if few else table) @ self.p[f"x{way}"] + self.p[f"c{way}"]
            both.append(self._read(way, gates if few else gates[index], three, keep))
            if memory is not None:
                memory[way] = keep
        h = np.concatenate(both, 2)
        a = np.tanh(h @ self.p["wa"])
        e = np.where(three, a @ self.p["va"], -1e9)
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = (w * h).sum(0)
        if memory is not None:
            memory |= {"h": h, "a": a, "w": w, "pooled": pooled}
        return (pooled @ self.p["out"] + self.p["bias"])[:, 0]

    def gradients(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """By name of the parameter; `table`: of the rows of the table."""
        m: dict = {}
        d = ((_sigmoid(self.logits(table, index, mask, m)) - y) * weight / weight.sum()).astype(np.float32)[:, None]
        grad = {"out": m["pooled"].T @ d, "bias": d.sum(0)}
        d_pool = d @ self.p["out"].T
        h, w, a = m["h"], m["w"], m["a"]
        d_w = (h * d_pool).sum(2, keepdims=True)
        d_e = w * (d_w - (w * d_w).sum(0))
        grad["va"] = np.einsum("sna,snk->ak", a, d_e)
        d_a = (d_e @ self.p["va"].T) * (1 - a * a)
        grad["wa"] = np.einsum("snh,sna->ha", h, d_a)
        d_h = w * d_pool + d_a @ self.p["wa"].T
        x = table[index]
        d_x = np.zeros(x.shape, np.float32)
        for k, way in enumerate("fb"):
            own, u = d_h[:, :, k * HIDDEN : (k + 1) * HIDDEN], self.p[f"h{way}"]
            carry = np.zeros_like(own[0])
            gx, gu, gc = np.zeros_like(self.p[f"x{way}"]), np.zeros_like(u), np.zeros_like(self.p[f"c{way}"])
            for s, before, z, r, c, ac in reversed(m[way]):
                total = own[s] + carry
                live = np.where(mask[s][:, None], total, 0)
                d_c = live * (1 - z) * (1 - c * c)
                d_z = live * (before - c) * z * (1 - z)
                d_r = d_c * ac * r * (1 - r)
                gates, inner = np.concatenate([d_z, d_r, d_c], 1), np.concatenate([d_z, d_r, d_c * r], 1)
                gx += x[s].T @ gates
                d_x[s] += gates @ self.p[f"x{way}"].T
                gu += before.T @ inner
                gc += gates.sum(0)
                carry = total - live + live * z + inner @ u.T
            grad |= {f"x{way}": gx, f"h{way}": gu, f"c{way}": gc}
        flat = index.ravel()
        grad["table"] = np.stack([np.bincount(flat, weights=d_x[:, :, k].ravel(), minlength=len(table)) for k in range(x.shape[2])], 1)
        return grad

    def train(self, inputs: Inputs, spelled: Spelled, fixed: np.ndarray, word: np.ndarray, index: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int, rate: float, seed: int, seen: dict) -> None:
        """fixed: rows of inputs that are not learned, word: the word of each; index: steps by windows, such rows."""
        rng, first, second, step = np.random.default_rng(seed), {}, {}, 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), 256):
                part, step = order[at : at + 256], step + 1
                rows, place = np.unique(index[:, part], return_inverse=True)
                table = inputs.table(spelled, word[rows], fixed[rows])
                grads = self.gradients(table, place.reshape(index[:, part].shape), mask[:, part], y[part], weight[part])
                inputs.learn(spelled, word[rows], grads.pop("table"), LEARN_RATE * rate, seen)
                for name, g in grads.items():
                    first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                    second[name] = 0.99 * second.get(name, 0) + 0.01 * g * g
                    self.p[name] = self.p[name] - np.float32(rate) * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)


def _steps(begin: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps by windows: the place of each word in the table, and whether there is one."""
    k = np.arange(WINDOW)[:, None]
    mask = k < size
    return at[np.minimum(begin + k, len(at) - 1)], mask


def _summary(logits: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Of each text, from its windows: the highest logit, the mean of the three highest, the mean probability and the
    number of windows, as a logarithm. A text without words has the least of all these."""
    out = np.zeros((n_docs, 4))
    out[:, :2] = -10
    if len(doc):
        order = np.lexsort((-logits, doc))
        sorted_doc, value = doc[order], logits[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_doc[1:] != sorted_doc[:-1]]))
        n = np.diff(np.append(first, len(value)))
        who = sorted_doc[first]
        out[who, 0] = value[first]
        out[who, 1] = sum(value[first + np.minimum(k, n - 1)] for k in range(3)) / 3
        out[who, 2] = np.add.reduceat(_sigmoid(value), first) / n
        out[who, 3] = np.log1p(n)
    return np.clip(out, -10, 10)


class Model:
    def __init__(self, inputs: Inputs, network: Network, final: np.ndarray, middle: np.ndarray, scale: np.ndarray):
        self.inputs, self.network, self.final, self.middle, self.scale = inputs, network, final, middle, scale

    def summaries(self, texts: list[bytes], known: WordHashes) -> np.ndarray:
        """Four numbers for each text, from all its windows."""
        words, at, n = _unique(texts)
        begin, size, doc = windows(n)
        logits = np.zeros(len(doc), np.float32)
        if len(doc):
            table = self.inputs.of(words, known)
            for k in range(0, len(doc), WINDOWS_AT_ONCE):
                index, mask = _steps(begin[k : k + WINDOWS_AT_ONCE], size[k : k + WINDOWS_AT_ONCE], at)
                logits[k : k + WINDOWS_AT_ONCE] = self.network.logits(table, index, mask)
        return _summary(logits, doc, len(texts))

    def scores(self, texts: list[bytes], known: WordHashes) -> np.ndarray:
        return _sigmoid((self.summaries(texts, known) - self.middle) / self.scale @ self.final[:-1] + self.final[-1])


def suspects(texts: list[bytes], odds: tuple[np.ndarray, np.ndarray], known: WordHashes, most: int = CANDIDATES) -> list[list[bytes]]:
    """Of each text the windows, as words joined by spaces, whose words have the highest odds; the first of equal ones."""
    words, at, n = _unique(texts)
    begin, size, doc = windows(n)
    out: list[list[bytes]] = [[] for _ in texts]
    if len(doc):
        hint = np.concatenate([[0], np.cumsum(Spelled(words, known, odds).fixed[at, :2].clip(0).sum(1))])
        rank = hint[begin + size] - hint[begin]
        order = np.lexsort((begin, -np.round(rank, 4), doc))
        place = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
        for k in order[place < most].tolist():
            out[doc[k]].append(b" ".join(words[w] for w in at[begin[k] : begin[k] + size[k]]))
    return out


def learn(found: list[bytes], of: np.ndarray, toxic: np.ndarray, half: np.ndarray, odds: list[tuple[np.ndarray, np.ndarray]]) -> tuple[Network, Inputs]:
    """From windows: their words, text, and the label and half of each text. odds: as each half's texts tell them.

    A text's words count for the log odds that other texts see, not for its own: halves give each other's while the
    network learns. Of a text those windows are learned from that look worst: they alone say why it is toxic, and are the
    hardest of a clean one; what looks worst is told by the network itself after the first turn.
    """
    known, place = WordHashes(), {}
    split = [w.split(b" ") for w in found]
    at = np.array([place.setdefault(w, len(place)) for x in split for w in x], np.int64)
    size = np.array([len(x) for x in split], np.int64)
    begin = np.cumsum(size) - size
    words = list(place)
    each = [Spelled(words, known, odds[h]) for h in (1, 0)]
    spelled, fixed = each[0], np.concatenate([x.fixed for x in each])
    word = np.tile(np.arange(len(words)), 2)
    at = at + np.repeat(half[of], size) * len(words)
    inputs, network, seen = Inputs(odds[0]), Network(), {}
    y = toxic[of].astype(np.float32)
    rank = -np.arange(len(found), dtype=np.float64)  # at first, in the order given
    for turn in range(3):
        order = np.lexsort((-rank, of))
        nth = np.arange(len(order)) - np.searchsorted(of[order], of[order])
        chosen = np.sort(order[nth < np.where(y[order] > 0, 2, 4)])
        index, mask = _steps(begin[chosen], size[chosen], at)
        weight = np.where(y[chosen] > 0, 0.5 / max(y[chosen].sum(), 1), 0.5 / max((1 - y[chosen]).sum(), 1)).astype(np.float32)
        network.train(inputs, spelled, fixed, word, index, mask, y[chosen], weight, 6, 0.01 if turn < 2 else 0.003, turn, seen)
        table = inputs.table(spelled, word, fixed)
        rank = np.concatenate([network.logits(table, *_steps(begin[k : k + WINDOWS_AT_ONCE], size[k : k + WINDOWS_AT_ONCE], at)) for k in range(0, len(begin), WINDOWS_AT_ONCE)])
    return network, inputs


def calibrate(x: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A logistic regression on the texts' four numbers: weights, of which the last has the weight of a missed text, and the
    numbers' means and spreads. Without texts of both classes there is nothing to weigh."""
    middle, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(4), np.ones(4))
    x1, final = np.concatenate([(x - middle) / scale, np.ones((len(x), 1))], 1), np.zeros(5)
    for _ in range(300):
        p = _sigmoid(x1 @ final)
        final -= np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + 0.5 * np.eye(5), x1.T @ (p - toxic) + 0.5 * final) * 0.5
    if 0 < toxic.sum() < len(toxic):
        final[-1] += np.log(MISSED)
    return final, middle, scale


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, toxic, half (0 or 1) and text of up to TRAIN_TOXIC and TRAIN_CLEAN labelled texts, the first by a hash of
    their id, of at most TRAIN_BYTES each. An id with several labels is toxic if one says so; of an id's texts that with the
    least hash is taken."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    first = lambda c, n: known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = first(1, TRAIN_TOXIC).union(first(0, TRAIN_CLEAN))
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").filter(F.octet_length("text") <= TRAIN_BYTES)
    one = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return one.select("doc_id", "toxic", F.pmod(F.shiftright(F.xxhash64("doc_id"), 7), F.lit(2)).cast("int").alias("half"), "text")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """labels: doc_id, toxic (0 or 1; null: unlabelled). Learns from training_texts(). Without texts of both classes, all
    scores are the same."""
    rows = stored(training_texts(docs, labels, id_col, text_col), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            toxic, half = (batch.column(k).to_numpy().astype(np.int64) for k in (1, 2))
            for begin, texts in chunks(batch.column(3)):
                group = (2 * half + toxic)[begin : begin + len(texts)]
                parts = _text_counts(texts, group, known)
                size = np.bincount(group, minlength=4)
                packed = zlib.compress(b"".join(x.astype("<u2").tobytes() for x in parts) + size.astype("<u2").tobytes(), 1)  # a chunk has under 65,536 texts
                yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["counts"])

    def added(a: pa.Table) -> pa.Table:
        total = np.zeros(4 * ((1 << WORD_BITS) + (1 << RUN_BITS)) + 4, np.int64)
        for x in a.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(x), "<u2")
        return pa.table([pa.array([zlib.compress(total.astype("<u4").tobytes(), 1)], pa.binary())], ["counts"])

    partial = rows.mapInArrow(count, "counts binary").withColumn("part", F.lit(0))
    summed = partial.groupBy("part").applyInArrow(added, "counts binary").collect()
    total = np.frombuffer(zlib.decompress(summed[0].counts), "<u4").astype(np.int64) if summed else np.zeros(4 * ((1 << WORD_BITS) + (1 << RUN_BITS)) + 4, np.int64)
    word, run, sizes = total[: 4 << WORD_BITS].reshape(4, -1), total[4 << WORD_BITS : -4].reshape(4, -1), total[-4:]

    def odds(halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
        clean, bad = [2 * h for h in halves], [2 * h + 1 for h in halves]
        return tuple(_odds(c[bad].sum(0), c[clean].sum(0), int(sizes[bad].sum()), int(sizes[clean].sum())) for c in (word, run))

    own = [odds([0]), odds([1])]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for h in (0, 1):
                part = batch.filter(pa.array(batch.column(2).to_numpy() == h))
                for begin, texts in chunks(part.column(3)):
                    found = suspects(texts, own[1 - h], known)
                    yield pa.RecordBatch.from_arrays([*[part.column(k).slice(begin, len(texts)) for k in range(3)], pa.array(found, pa.list_(pa.binary()))], ["doc_id", "toxic", "half", "windows"])

    got = sorted(rows.mapInArrow(choose, "doc_id long, toxic int, half int, windows array<binary>").collect(), key=lambda r: r.doc_id)
    toxic, half = np.array([r.toxic for r in got], np.int64), np.array([r.half for r in got], np.int64)
    found, of = [bytes(w) for r in got for w in r.windows], np.repeat(np.arange(len(got)), [len(r.windows) for r in got]).astype(np.int64)
    if not found:
        return Model(Inputs(odds([0, 1])), Network(), np.zeros(5), np.zeros(4), np.ones(4))
    network, inputs = learn(found, of, toxic, half, own)
    halves = [Model(Inputs(own[1 - h], inputs.word, inputs.run), network, np.zeros(5), np.zeros(4), np.ones(4)) for h in (0, 1)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for h in (0, 1):
                part = batch.filter(pa.array(batch.column(2).to_numpy() == h))
                for begin, texts in chunks(part.column(3)):
                    x = halves[h].summaries(texts, known)
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(begin, len(texts)), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "x"])

    x = np.array([r.x for r in sorted(rows.mapInArrow(measure, "doc_id long, x array<double>").collect(), key=lambda r: r.doc_id)])
    return Model(Inputs(odds([0, 1]), inputs.word, inputs.run), network, *calibrate(x, toxic))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, score (0 to 1), predicted, from all windows of the whole text.

    Null and empty texts have no windows and a score like others; ties have equal scores. Null ids and repeated rows are kept; an empty table
    gives an empty result; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for begin, texts in chunks(batch.column(1)):
                found = model.scores(texts, known)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), pa.array(found, pa.float64()), pa.array((found >= PREDICT_AT).astype(np.int32))], ["doc_id", "score", "predicted"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")
