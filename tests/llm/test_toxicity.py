"""The network's gradients, also of its inputs; windows; and that training does not depend on the order of rows."""

import math
import random

import numpy as np
import pytest

from quarrymill.llm import toxicity
from quarrymill.llm.common import WordHashes


def test_gradients_of_the_network():
    rng = np.random.default_rng(2)
    net = toxicity.Network()
    table, index = rng.normal(size=(20, toxicity._INPUTS)), rng.integers(0, 20, (6, 5))
    net.p = {k: v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for k, v in net.p.items()}
    mask, y, weight = np.arange(6)[:, None] < np.array([6, 3, 1, 5, 6]), np.array([1.0, 0, 1, 0, 1]), np.ones(5)

    def loss():
        z = net.logits(table, index, mask).astype(np.float64)
        return float((np.logaddexp(0, z) - y * z).mean())

    grad = net.gradients(table, index, mask, y, weight)
    for name, value in {**net.p, "table": table}.items():
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(4)]:
            value[at] += 1e-3
            high = loss()
            value[at] -= 2e-3
            low = loss()
            value[at] += 1e-3
            assert grad[name][at] == pytest.approx((high - low) / 2e-3, abs=2e-3)


def test_vectors_are_learned_from_the_inputs_gradient():
    known, odds = WordHashes(), (np.zeros(1 << toxicity.WORD_BITS, np.float32), np.zeros(1 << toxicity.RUN_BITS, np.float32))
    inputs, words = toxicity.Inputs(odds), [b"one", b"two", b"", b"one two three"]
    spelled = toxicity.Spelled(words, known, odds)
    some = np.arange(4)
    table = inputs.table(spelled, some, spelled.fixed)
    assert np.array_equal(table, inputs.of(words, known))
    k = toxicity._FIXED + toxicity.LEARNED
    runs, owner = spelled.at(some)
    for w in range(4):
        own = inputs.run[runs[owner == w]]
        assert table[w, k:] == pytest.approx(own.mean(0) if len(own) else np.zeros(toxicity.LEARNED), abs=1e-5)
    grad = np.zeros_like(table)
    grad[0, toxicity._FIXED :] = 1
    inputs.learn(spelled, some, grad, 0.1, {})
    after = inputs.table(spelled, some, spelled.fixed)
    assert (after[0, toxicity._FIXED :] < table[0, toxicity._FIXED :]).all() and np.array_equal(after[1, toxicity._FIXED : k], table[1, toxicity._FIXED : k])


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 1000])
def test_windows_hold_every_word(n):
    begin, size, doc = toxicity.windows(np.array([5, n]))
    own = doc == 1
    held = {p - 5 for b, s in zip(begin[own], size[own], strict=True) for p in range(b, b + s)}
    assert held == set(range(n)) and (size <= toxicity.WINDOW).all()


def rows(n=60):
    rng = random.Random(8)
    calm, rude = [f"calm{k}" for k in range(60)], ["idiot", "trash", "stupid", "moron"]
    out = []
    for k in range(n):
        words = [rng.choice(calm) for _ in range(rng.randint(3, 120))]
        if k % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(rude)
            words[rng.randrange(len(words))] = rng.choice(rude)
        out.append((k, " ".join(words)))
    return out


def test_training_does_not_depend_on_order(spark):
    """Nor on repeated rows; of conflicting labels toxic counts, of an id's texts always the same one."""
    docs, labels = rows(), [(k, int(k % 3 == 0)) for k in range(60)]
    kind, kind2 = "doc_id long, text string", "doc_id long, toxic int"
    model = toxicity.fit(spark.createDataFrame(docs, kind), spark.createDataFrame(labels, kind2))
    again = toxicity.fit(spark.createDataFrame(docs[::-1] + docs[:9], kind).repartition(7), spark.createDataFrame(labels[::-1] + [(0, 0), (3, 0), (None, 1), (5, None)], kind2).repartition(5))
    known = WordHashes()
    texts = [t.encode() for _, t in docs] + [b"", b"idiot"]
    assert model.scores(texts, known) == pytest.approx(again.scores(texts, known), abs=1e-6)
    two = toxicity.training_texts(spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], kind).repartition(3), spark.createDataFrame([(1, 0), (1, 1), (2, 0)], kind2)).collect()
    other = toxicity.training_texts(spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], kind), spark.createDataFrame([(1, 1), (1, 0), (2, 0)], kind2)).collect()
    assert sorted(map(str, two)) == sorted(map(str, other)) and [r.toxic for r in two] == [1]
    got = model.scores(texts, known)
    assert ((got >= 0) & (got <= 1)).all() and got[0] > got[1]


def test_windows_that_look_worst_come_first():
    known, odds = WordHashes(), (np.zeros(1 << toxicity.WORD_BITS, np.float32), np.zeros(1 << toxicity.RUN_BITS, np.float32))
    word, _, _ = toxicity._hashes([b"bad"], known)
    odds[0][word[0]] = 3
    words = [f"w{k}" for k in range(200)]
    words[100] = "bad"
    found = toxicity.suspects([" ".join(words).encode(), b""], odds, known, 3)
    assert len(found[0]) == 3 and b"bad" in found[0][0] and b"bad" in found[0][1] and b"bad" not in found[0][2] and found[1] == []


def test_forward_pass_like_a_plain_one():
    """Word by word and number by number, for windows of different lengths."""
    rng, net = np.random.default_rng(3), toxicity.Network(4)
    table = rng.normal(0, 1, (9, net.p["xf"].shape[0])).astype(np.float32)
    windows = [[1, 2, 3, 4, 5], [8], [0, 0, 7], [6, 5, 4, 3]]
    index, mask = np.zeros((5, len(windows)), np.int64), np.zeros((5, len(windows)), np.bool_)
    for k, w in enumerate(windows):
        index[: len(w), k], mask[: len(w), k] = w, True
    n = toxicity.HIDDEN
    sig = lambda x: 1 / (1 + math.exp(-x))

    def read(way, words):
        h, out = [0.0] * n, []
        for w in words:
            g = [sum(float(table[w][i]) * float(net.p[f"x{way}"][i][j]) for i in range(table.shape[1])) + float(net.p[f"c{way}"][j]) for j in range(3 * n)]
            a = [sum(h[i] * float(net.p[f"h{way}"][i][j]) for i in range(n)) for j in range(3 * n)]
            z, r = [sig(g[j] + a[j]) for j in range(n)], [sig(g[n + j] + a[n + j]) for j in range(n)]
            c = [math.tanh(g[2 * n + j] + r[j] * a[2 * n + j]) for j in range(n)]
            h = [c[j] + z[j] * (h[j] - c[j]) for j in range(n)]
            out.append(h)
        return out

    want = []
    for words in windows:
        states = [f + b for f, b in zip(read("f", words), read("b", words[::-1])[::-1], strict=True)]
        scores = []
        for h in states:
            a = [math.tanh(sum(h[i] * float(net.p["wa"][i][j]) for i in range(2 * n))) for j in range(net.p["wa"].shape[1])]
            scores.append(math.exp(sum(x * float(v) for x, v in zip(a, net.p["va"][:, 0], strict=True))))
        pooled = [sum(s * h[i] for s, h in zip(scores, states, strict=True)) / sum(scores) for i in range(2 * n)]
        want.append(sum(x * float(o) for x, o in zip(pooled, net.p["out"][:, 0], strict=True)) + float(net.p["bias"][0]))
    assert net.logits(table, index, mask) == pytest.approx(want, abs=1e-4)


def test_a_missed_text_weighs_more():
    rng = np.random.default_rng(1)
    toxic = np.repeat([0.0, 1.0], 200)
    x = rng.normal(0, 1, (400, 4)) + toxic[:, None] * 0.7
    final, middle, scale = toxicity.calibrate(x, toxic)
    p = 1 / (1 + np.exp(-((x - middle) / scale @ final[:-1] + final[-1] - np.log(toxicity.MISSED))))
    assert p.mean() == pytest.approx(0.5, abs=0.02)
    assert (toxicity.calibrate(np.zeros((0, 4)), np.zeros(0))[0] == 0).all() and toxicity.calibrate(x, toxic * 0)[0][-1] < 0
