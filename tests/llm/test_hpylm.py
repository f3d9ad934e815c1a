"""The language model's sampler against the law of seatings, a plain sampler, and any way of dealing words out."""

import collections
import random

import numpy as np
import pytest

from quarrymill.llm import hpylm


def law(c, strength, parent, d):
    """Of one dish's tables, by adding up all ways of sitting down one by one."""
    ways = {0: 1.0}
    for k in range(c):
        new = collections.defaultdict(float)
        for t, w in ways.items():
            if k:
                new[t] += w * (k - d * t)
            new[t + 1] += w * (strength + d * t) * parent
        most = max(new.values())
        ways = {t: w / most for t, w in new.items()}
    total = sum(ways.values())
    return {t: w / total for t, w in ways.items()}


@pytest.mark.parametrize(("c", "strength", "parent"), [(2, 3.0, 0.1), (3, 20.0, 0.01), (7, 500.0, 0.02), (40, 5.0, 0.5), (200, 3000.0, 0.01)])
def test_seating_has_its_law(c, strength, parent):
    n = 20_000
    want = law(c, strength, parent, 0.8)
    got = np.bincount(hpylm.seat(np.full(n, c), np.full(n, strength), np.full(n, parent), 0.8, np.arange(n).astype(np.uint64), 3), minlength=c + 1) / n
    assert np.abs(got - [want.get(t, 0) for t in range(c + 1)]).sum() < 0.06


@pytest.mark.parametrize(("strength", "parent"), [(3.0, 0.01), (50.0, 0.2), (2000.0, 0.05), (5000.0, 0.2)])
def test_seating_of_many_goes_on_where_the_exact_law_ends(strength, parent, monkeypatch):
    n, c = 4000, hpylm.EXACT
    args = np.full(n, strength), np.full(n, parent), 0.8, np.arange(n).astype(np.uint64), 1
    exact = hpylm.seat(np.full(n, c), *args).mean()
    monkeypatch.setattr(hpylm, "EXACT", c - 1)
    assert hpylm.seat(np.full(n, c), *args).mean() == pytest.approx(exact, rel=0.12, abs=0.3)


def test_seating_keeps_its_bounds():
    customers = np.array([0, 1, 2, 5, 100, 5000, 10**9])
    tables = hpylm.seat(customers, np.full(7, 40.0), np.full(7, 0.5), 0.5, np.arange(7).astype(np.uint64), 0)
    assert tables[0] == 0 and tables[1] == 1 and (tables[2:] >= 1).all() and (tables <= customers).all()


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["the"] * 30 + [f"w{k}{'abc'[k % 3]}" for k in range(20) for _ in range(1 + 20 // (k + 1))]
    return [[rng.choice(words) for _ in range(25)] for _ in range(n)]


def words_of(texts):
    """Numbers of the words of each text, and the vocabulary that the texts make."""
    known = hpylm.WordHashes()
    numbers = [known.of([w.encode() for w in text]) for text in texts]
    count = collections.Counter(w for own in numbers for w in own.tolist())
    count[hpylm._START] = len(texts)
    return numbers, hpylm.Vocabulary(np.array(list(count), np.uint64), np.array(list(count.values())))


def pairs_of(texts):
    numbers, words = words_of(texts)
    count = collections.Counter()
    for own in numbers:
        before = words.contexts(np.append(np.uint64(hpylm._START), own))
        count.update(zip(np.append(own, np.uint64(hpylm._END)).tolist(), before.tolist(), strict=True))
    keys = sorted(count)
    return np.array([k[0] for k in keys], np.uint64), np.array([k[1] for k in keys], np.uint32), np.array([count[k] for k in keys]), words.places


def run(bucket, places, sweeps, n_hot=0):
    known = []
    for k in range(sweeps + 1):
        added = hpylm.Sums(places, n_hot)
        added.add(bucket, *bucket.states(known, k))
        known.append(hpylm.totals(added.rows(), places, n_hot))
    return known


class Plain:
    """One customer after another, with every table by itself. Restaurants by context; parents by name."""

    def __init__(self, up, base, seed):
        self.rng, self.up, self.base, self.tables = random.Random(seed), up, base, collections.defaultdict(lambda: collections.defaultdict(list))

    def p(self, at, w):
        if at is None:
            return self.base
        level = at[0]
        own = self.tables[at]
        c, t = sum(sum(x) for x in own.values()), sum(len(x) for x in own.values())
        d, s = hpylm.DISCOUNTS[level], hpylm.STRENGTHS[level]
        return (sum(own[w]) - d * len(own[w]) + (s + d * t) * self.p(self.up(at), w)) / (s + c)

    def add(self, at, w):
        if at is None:
            return
        d, s = hpylm.DISCOUNTS[at[0]], hpylm.STRENGTHS[at[0]]
        own = self.tables[at]
        t = sum(len(x) for x in own.values())
        new = (s + d * t) * self.p(self.up(at), w)
        r = self.rng.random() * (sum(own[w]) - d * len(own[w]) + new)
        for k, n in enumerate(own[w]):
            r -= n - d
            if r < 0:
                own[w][k] += 1
                return
        own[w].append(1)
        self.add(self.up(at), w)

    def remove(self, at, w):
        if at is None:
            return
        sizes = self.tables[at][w]
        k = self.rng.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        if not sizes[k]:
            del sizes[k]
            self.remove(self.up(at), w)


def test_against_a_plain_sampler(monkeypatch):
    """Mean probabilities of a small corpus, as a sampler finds them that reseats one customer after another."""
    word, context, count, places = pairs_of(corpus(1))
    up = lambda at: {1: (0, 0), 0: None}[at[0]]
    plain = Plain(up, 1 / (len(set(word.tolist())) + 1), 5)
    customers = [(u, w) for w, u, n in zip(word.tolist(), context.tolist(), count.tolist(), strict=True) for _ in range(n)]
    for u, w in customers:
        plain.add((1, u), w)
    want = np.zeros(len(word))
    for sweep in range(30):
        for u, w in customers:
            plain.remove((1, u), w)
            plain.add((1, u), w)
        if sweep >= 10:
            want += [plain.p((1, u), w) / 20 for w, u in zip(word.tolist(), context.tolist(), strict=True)]
    monkeypatch.setattr(hpylm, "BURN_IN", 5)
    bucket = hpylm.Bucket(word, context, count, places)
    known = run(bucket, places, 25)
    got = np.zeros(len(word))
    for k, state in enumerate(bucket.chain(known, 25)):
        if k > 5:
            got += bucket.predicted(known[k], *state) / 20
    # total, and word by word
    assert (count * np.log(got)).sum() == pytest.approx((count * np.log(want)).sum(), rel=0.01)
    assert np.abs(np.log(got) - np.log(want)).mean() < 0.08


def test_probabilities_sum_to_one():
    word, context, count, places = pairs_of([*corpus(2), ["once", "the"], ["only", "w0a"]])
    words, every = np.unique(word), np.append(np.unique(context), np.uint32(0))
    assert (every >= places - 1).sum() >= 2
    of = {k: n for *k, n in zip(word.tolist(), context.tolist(), count.tolist(), strict=True) for k in [tuple(k)]}
    grid = [(w, u) for w in words.tolist() for u in sorted(every.tolist())]
    bucket = hpylm.Bucket(np.array([w for w, _ in grid], np.uint64), np.array([u for _, u in grid], np.uint32), np.array([of.get(k, 0) for k in grid]), places)
    known = run(bucket, places, 3)
    contexts = np.array([u for _, u in grid])
    for k, (c, t) in enumerate(bucket.chain(known, 3)):
        at = known[k]
        assert (t[1] <= c[1]).all() and (t[1][c[1] > 0] >= 1).all()
        p = bucket.predicted(at, c, t)
        unknown = at.at_root(np.zeros(1), np.zeros(1))
        for u in every.tolist():
            rest = at.in_context(np.array([min(u, places - 1)]), np.zeros(1), np.zeros(1), unknown)
            assert p[contexts == u].sum() + rest[0] == pytest.approx(1)


def test_each_word_has_a_restaurant_of_its_own(spark):
    """No two words of the training texts share one, however rare; and what the texts lack has none."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("cast(text as binary) as text", "doc_id % 5 = 1 as held_out")
    texts = [(r.text or b"").lower().split() for r in docs.filter("not held_out").collect()]
    count = collections.Counter(w for t in texts for w in t)
    found = hpylm.vocabulary(hpylm.counted_words(docs))
    words = hpylm.WordHashes().of(sorted(count))
    got = found.contexts(words)
    assert len(set(got.tolist())) == len(count) > 5000 and 0 not in got
    n = np.array([count[w] for w in sorted(count)])
    assert ((got >= found.places - 1) == (n == 1)).all()
    assert (found.contexts(hpylm.WordHashes().of([b"not there", b"nor there"])) == 0).all()
    assert found.contexts(np.array([hpylm._START], np.uint64))[0] > 0 and found.places == 2 + (n > 1).sum() + 1


def test_more_words_than_places(spark, monkeypatch):
    """The most frequent keep their own; the rest share, and lose nothing: probabilities still follow their totals."""
    monkeypatch.setattr(hpylm, "MOST_WORDS", 8)
    monkeypatch.setattr(hpylm, "SHARED", 4)
    rows = [(k, " ".join(x), k % 5 == 1) for k, x in enumerate(corpus(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    found = hpylm.vocabulary(hpylm.counted_words(docs.selectExpr("cast(text as binary) as text", "held as held_out")))
    assert len(found.own) <= 8 and found.places == 2 + len(found.own) + 4 and not len(found.single)
    got = hpylm.score(docs, "held").collect()
    assert len(got) == len(rows) and all(r.score > 1.3 * r.base_score for r in got)


def test_scores_hold_for_any_number_of_partitions(spark, monkeypatch):
    """Also where words are parted over buckets, and where several blocks share pairs."""
    rows = [(k, " ".join(x)) for k, x in enumerate(corpus(3, 200))] + [(500, None), (501, ""), (501, ""), (None, "the w0a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), {}
    try:
        for n, block, share in ((1, 1 << 30, 0.25), (4, 2000, 0.25), (64, 3000, 0.25), (64, 1000, 1e9)):
            monkeypatch.setattr(hpylm, "BLOCK_BYTES", block)
            monkeypatch.setattr(hpylm, "HOT_SHARE", share)
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got[n, block] = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in hpylm.score_folds(docs.repartition(3)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    first, *rest = got.values()
    assert len(first) == len(rows)
    for other in rest:
        assert [x[:5] for x in other] == [x[:5] for x in first]
        assert np.array([x[5:] for x in other]) == pytest.approx(np.array([x[5:] for x in first]), abs=1e-5)


def test_scores_do_not_depend_on_the_number_of_places(spark, monkeypatch):
    """Words beyond MOST_WORDS have restaurants of their own too, with the same seats."""
    rows = [(k, " ".join([*x, f"twice{k // 2}", "the", f"once{k}"]), k % 5 == 1) for k, x in enumerate(corpus(5, 120))] + [(500, None, False), (501, "", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = {}
    for most in (hpylm.MOST_WORDS, 150, 8):
        monkeypatch.setattr(hpylm, "MOST_WORDS", most)
        got[most] = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in hpylm.score(docs, "held").collect())
    first, *rest = got.values()
    for other in rest:
        assert [x[:4] for x in other] == [x[:4] for x in first]
        assert np.array([x[4:] for x in other]) == pytest.approx(np.array([x[4:] for x in first]), abs=1e-5)
