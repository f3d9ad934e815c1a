"""Each operator against a plain version, and on null, empty, long, equal and repeated rows and clashing columns."""

import collections
import random
import zlib

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarrymill.llm import components, decontaminate, hpylm, langid, packing, pii, quality, queries, simhash, substrings, toxicity

WORDS = [f"w{k}" for k in range(400)]


def make_text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, a long one, repeated rows, and columns that operators use inside."""
    rng = random.Random(3)
    base = make_text(rng, 300)
    rows = [
        (1, base, "en", 1.0, "a"), (2, base, "en", 2.0, "b"), (2, base, "en", 2.0, "b"), (3, base + " more words here", "en", None, "c"), (4, None, None, None, None), (5, "", "de", 0.0, ""),
        (None, base, "fr", 1.0, "x"), (6, make_text(rng, 20_000), "en", 1.0, "x"), (7, "...\n\t !", None, 1.0, "x"), (8, "ein Wort", "de", 1.0, "x"), (9, make_text(rng, 49), "en", 1.0, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, key string").withColumns({"fp": F.lit(1), "mark": F.lit("m"), "spans": F.lit("s"), "rank": F.lit(0), "_held": F.lit(True)})


def ids(rows):
    return sorted((r.doc_id is None, r.doc_id) for r in rows)


def test_every_operator_keeps_rows(spark, odd):
    want = ids(odd.collect())
    labels = spark.createDataFrame([(1, 1, 1), (8, 1, 0), (8, 1, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "w1 w2"), (None, "w3"), (2, None)], "item_id long, text string")
    runs = {
        "langid": lambda d: langid.identify(d, langid.fit(odd)),
        "simhash": simhash.near_duplicates,
        "quality": lambda d: quality.quality(d, labels),
        "packing": packing.pack,
        "substrings": substrings.deduplicate,
        "pii": pii.report,
        "decontaminate": lambda d: decontaminate.contamination(d, items),
        "hpylm": lambda d: hpylm.score_folds(d),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(odd, labels)),
    }
    for name, run in runs.items():
        got = run(odd).collect()
        kept = [r for r in got if getattr(r, "piece", 0) == 0]
        assert ids(kept) == want, name
        assert run(odd.limit(0)).collect() == [], name


def test_simhash_fingerprint_and_components(spark):
    rng = random.Random(5)
    texts = [make_text(rng, n) for n in (0, 1, 2, 3, 4, 60, 500)]
    for text in texts:
        words = text.lower().split()
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
        assert simhash.fingerprint(text.encode()) == want


@pytest.mark.parametrize("heavy", [50_000, 3])
def test_simhash_links_all_within_budget(spark, monkeypatch, heavy):
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    rng = random.Random(1)
    values = set()
    for _ in range(40):
        b = rng.getrandbits(64)
        for _ in range(25):
            x = b
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    up = {v: v for v in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 2:
                x, y = find(signed[i]), find(signed[j])
                up[max(x, y)] = min(x, y)
    got = dict(components.components(simhash.linked_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect())
    assert got == {v: find(v) for v in signed if find(v) != v}


def test_components_of_a_long_path(spark):
    n = 40
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(3, 3), (100, 101)], "u long, v long")
    assert dict(components.components(edges).collect()) == {**{k: 0 for k in range(1, n + 1)}, 101: 100}
    assert components.components(edges.limit(0)).collect() == []


def test_pii_base_spans(spark):
    texts = [
        "a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 001.2.3.0004", "4111 1111 1111 1111 and 4111-1111-1111-1112 3 4", "+1 (555) 123-4567 +49 30 1234567 +123", None, "",
        "é@é.com ñandú foo@bar.co.uk. +34 600 600 600.", " ".join(f"+1 555 0{k:06d} a{k}@b.co 4111111111111111" for k in range(600)), "a" * 20_000 + " 1" * 9_000 + "@", "𝔘 a@b.c",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(docs).collect():
        want = brute.base_spans(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.told(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in ("email", "ip", "card", "phone")]
    for r in pii.mask(docs).collect():
        assert not brute.base_spans(r.text)


def test_pii_method_spans(spark):
    docs = spark.createDataFrame([(1, "my iban GB82 WEST 1234 5698 7654 32."), (2, "iban GB82 WEST 1234 5698 7654 33"), (3, "ssn 123-45-6789"), (4, "lot 123-45-6789")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert got == {1: "iban:8:35", 2: "", 3: "ssn:4:15", 4: ""}


def test_decontamination_short_items_and_repeats(spark):
    docs = spark.createDataFrame([(1, "A b c d e f g h i j k"), (1, "A b c d e f g h i j k"), (2, "x y Z w x y"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a B c d e f g h i j"), (8, "y z"), (9, ""), (8, "y z")], "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, items).collect())
    assert got == [(1, 11, 10, 1, True), (1, 11, 10, 1, True), (2, 6, 2, 1, True), (3, 0, 0, 0, False)]
    again = decontaminate.contamination(docs, items)
    decontaminate.MOST_BROADCAST, most = 0, decontaminate.MOST_BROADCAST
    try:
        assert sorted(map(str, decontaminate.contamination(docs, items).collect())) == sorted(map(str, again.collect()))
    finally:
        decontaminate.MOST_BROADCAST = most


def plain_removal(texts, width):
    first, gone = {}, collections.defaultdict(set)
    split = {k: (t or "").split() for k, t in texts}
    for k in sorted(split):
        for p in range(len(split[k]) - width + 1):
            first.setdefault(tuple(split[k][p : p + width]), k)
    for k, words in split.items():
        for p in range(len(words) - width + 1):
            if first[tuple(words[p : p + width])] < k:
                gone[k] |= set(range(p, p + width))
    return {k: " ".join(w for p, w in enumerate(words) if p not in gone[k]) for k, words in split.items()}


def passages(rng):
    passage, texts = make_text(rng, 70), []
    for k in range(60):
        text = make_text(rng, rng.randint(0, 120))
        if k % 2:
            text += " " + passage
        if k % 7 == 0 and texts:
            text += " " + (texts[-1][1] or "") + " end"
        texts.append((k, text if k != 11 else None))
    texts.append((60, "as " * 200))
    texts.append((61, "as " * 120 + passage))
    # copies of texts with and without a window, also before and after what they are copies of
    return texts + [(62, texts[1][1]), (63, texts[1][1]), (-1, texts[3][1]), (64, "few words"), (65, "few words"), (66, ""), (67, None)]


@pytest.mark.parametrize("most", [20_000, 20, 3])
def test_substrings_against_all_windows(spark, monkeypatch, most):
    """Also with prefixes lengthened once and twice."""
    monkeypatch.setattr(substrings, "MOST_LEAVES", most)
    texts = passages(random.Random(9))
    want = plain_removal(texts, 50)
    got = {r.doc_id: r for r in substrings.deduplicate(spark.createDataFrame(texts, "doc_id long, text string"), with_text=True).collect()}
    for k, text in want.items():
        assert got[k].kept == text and got[k].kept_sha256 == brute.sha(text)


def test_substrings_joined_by_shuffles(spark, monkeypatch):
    docs = spark.createDataFrame(passages(random.Random(5)), "doc_id long, text string")
    monkeypatch.setattr(substrings, "MOST_LEAVES", 20)
    want = sorted(map(str, substrings.deduplicate(docs).collect()))
    monkeypatch.setattr(substrings, "MOST_KEYS", 0)
    assert sorted(map(str, substrings.deduplicate(docs).collect())) == want


@pytest.mark.parametrize(("width", "prefix"), [(10, 3), (10, 5), (12, 4)])
def test_subtrees_give_the_repeats(width, prefix):
    """Runs of windows from common prefixes are those of comparing all windows."""
    rng = random.Random(width * prefix)
    words = [f"w{k}".encode() for k in range(60)]
    for _ in range(40):
        passage, docs = [rng.choice(words) for _ in range(25)], []
        for k in range(8):
            a = rng.randint(0, 10)
            text = [rng.choice(words) for _ in range(rng.randint(0, 30))] + passage[a : rng.randint(a, 25)] + [rng.choice(words) for _ in range(rng.randint(0, 5))] + passage[5:20]
            docs.append(text + [b"as"] * (rng.randint(0, 30) if k % 3 == 0 else 0))
        first = {}
        for k, text in enumerate(docs):
            for p in range(len(text) - width + 1):
                first.setdefault(tuple(text[p : p + width]), k)
        want = {(k, p) for k, text in enumerate(docs) for p in range(len(text) - width + 1) if first[tuple(text[p : p + width])] < k}
        _, hashes, doc = substrings._hashed([b" ".join(x) for x in docs], substrings.WordHashes())
        begin, flat = np.cumsum([0, *map(len, docs)]), [w for x in docs for w in x]
        start, n, place, _ = substrings.leaves(hashes, doc, width, prefix)
        texts = [b" ".join(flat[s : s + k + width - 1]) for s, k in zip(start, n, strict=True)]
        leaf, window, found = substrings.repeats(doc[start], n, place - start, texts, width)
        got = [(int(doc[start[x]]), int(start[x] - begin[doc[start[x]]] + w + j)) for x, w, k in zip(leaf, window, found, strict=True) for j in range(k)]
        assert set(got) == want and len(got) == len(want)


def test_packing_is_a_round_trip(spark):
    tokenizers = pytest.importorskip("tokenizers")
    tokens = pytest.importorskip("public_tokenizers")
    rng = random.Random(4)
    texts = [(k, make_text(rng, 4000 if k % 20 == 7 else rng.randint(0, 300))) for k in range(80)] + [(80, "a  b\n\n\tc é 𝔘 don't"), (81, None)]
    own = tokenizers.Tokenizer.from_file(tokens.path("byte_bpe_50k.json"))
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for k, text in texts:
        found = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[k], key=lambda r: r.piece)
        assert [r.start for r in parts] == [sum(p.length for p in parts[:i]) for i in range(len(parts))]
        assert sum(r.length for r in parts) == len(found) and all(r.length == 2048 for r in parts[1:])
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(np.array(found[r.start : r.start + r.length], "<u4").tobytes())
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:i]) for i in range(len(parts))]
        assert sum(r.length for r in parts) <= 2048
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 2048) + 1


def least_bins(lengths, capacity):
    """By trying all partial packings, largest first."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for room in {b for b in bins if b >= lengths[k]}:
            rest = list(bins)
            rest.remove(room)
            go(k + 1, [*rest, room - lengths[k]])
        go(k + 1, [*bins, capacity - lengths[k]])

    go(0, [])
    return best


def test_plan_is_best_on_small_cases():
    rng = random.Random(2)
    for _ in range(40):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        plan = packing.plan(np.bincount(lengths, minlength=21), 20)
        held = collections.Counter(a for fill, times in plan for a in fill for _ in range(times))
        assert held == collections.Counter(lengths) and all(sum(fill) <= 20 for fill, _ in plan)
        assert sum(times for _, times in plan) == least_bins(lengths, 20)


def test_quality_base_counts(spark):
    rng = random.Random(8)
    texts = ["", None, "a # b\nx\n\nx\n x\nx", "as " * 40, make_text(rng, 30), make_text(rng, 20) + "\n" + " ".join(WORDS[:12] * 3), "é|é " * 25]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(4, 1)], "doc_id long, quality int")
    for r in quality.quality(docs, labels).collect():
        text = texts[r.doc_id] or ""
        words = text.split()
        lines = [x for x in text.split("\n") if x.strip()]
        seen = collections.Counter(tuple(words[p : p + 8]) for p in range(len(words) - 7))
        cover = {q for p in range(len(words) - 7) if seen[tuple(words[p : p + 8])] > 1 for q in range(p, p + 8)}
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        assert r.n_repeat_words == len(cover)
        assert r.base_failed == (len(words) < 20 or 100 * len(cover) > 30 * len(words))
        assert not (r.base_failed and r.kept)


def test_language_model_base_and_gain(spark):
    rng = random.Random(6)
    nouns, verbs = [f"n{k}a" for k in range(40)], [f"v{k}b" for k in range(40)]
    texts = [(k, " ".join(rng.choice(nouns) + " " + rng.choice(verbs) for _ in range(60))) for k in range(120)] + [(120, "Unknown W0rds only"), (121, None)]
    rows = hpylm.score_folds(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in texts}
    tokens = {k: [*(t or "").lower().split(), None] for k, t in texts}
    counts = collections.Counter(w for k in tokens if not held[k] for w in tokens[k])
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(w in counts for w in own), n)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
    out = [r for r in rows if r.held_out and r.n_tokens > 50]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 50


SMALL = "/root/testdata/sf0.01"


def test_held_out_toxicity_and_language(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = [r for r in queries.op8_toxicity(spark, SMALL).collect() if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in rows]
    assert sum(right) / len(right) > 0.93
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op5_langid(spark, SMALL).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) > 0.98


def test_quality_of_ids_with_both_labels(spark):
    """An id that is labelled good and bad is trusted, once."""
    docs = spark.createDataFrame([(k, f"word{k} and more words of the text number {k} " * 5) for k in range(6)], "doc_id long, text string")
    told = lambda rows: sorted((r.doc_id, round(r.log_ratio, 9)) for r in quality.quality(docs, spark.createDataFrame(rows, "doc_id long, quality int")).collect())
    assert told([(4, 1), (4, 0), (4, 1), (2, 0)]) == told([(4, 1)]) != told([(2, 1)])
