"""Whole queries on the smallest tables against plain versions of what they compute."""

import collections
import zlib

import brute
import numpy as np
import pytest
import xxhash

from quarrymill.llm import html, langid, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def test_op1(spark):
    """Templates counted in Python, page by page."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    host = {p.page_id: p.url.split("/")[2].split(":")[0].lower() for p in pages}
    seen, counts = collections.defaultdict(set), collections.defaultdict(collections.Counter)
    for p in pages:
        own, signs = html.signatures(p.html or "")
        if own not in seen[host[p.page_id]]:
            seen[host[p.page_id]].add(own)
            counts[host[p.page_id]].update(signs)
    template = {h: {s for s, n in c.items() if n >= html.LEAST_PAGES and n >= html.LEAST_SHARE * len(seen[h])} for h, c in counts.items()}
    got = {r.page_id: r for r in queries.op1_html(spark, DATA).collect()}
    assert len(got) == len(pages)
    for p in pages:
        text, deleted = html.main_text(p.html or "", template[host[p.page_id]])
        assert (got[p.page_id].text, got[p.page_id].n_template, got[p.page_id].n_chars, got[p.page_id].url) == (text, deleted, len(text), p.url)


def test_op2(spark, docs):
    got = {r.doc_id: r for r in queries.op2_pii(spark, DATA).collect()}
    for k, text in docs:
        want = brute.base_spans(text)
        assert got[k].base_sha256 == brute.sha(brute.told(want))
        assert [got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone] == [sum(s[0] == x for s in want) for x in ("email", "ip", "card", "phone")]
        assert set(brute.told(want).split(",")) <= set(got[k].spans.split(","))


def test_op5(spark, docs):
    """Each text by the model alone, learned from the right rows."""
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    some = [r.doc_id for r in table.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    model = langid.fit(table.filter(table.doc_id.isin(some)))
    got = {r.doc_id: r for r in queries.op5_langid(spark, DATA).collect()}
    for k, text in docs:
        lang, score = model.predict(text)
        assert (got[k].lang_pred, got[k].held_out) == (lang, zlib.crc32(str(k).encode()) % 4 == 2) and got[k].score == pytest.approx(score)


def test_op7(spark, docs):
    """Tokens by the other library, sequences without gaps, as many as the lengths need at least."""
    tokenizers = pytest.importorskip("tokenizers")
    own = tokenizers.Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    rows = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in queries.op7_packing(spark, DATA).collect():
        rows[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for k, text in docs:
        ids = [*own.encode(text, add_special_tokens=False).ids, 0]
        parts = sorted(rows[k], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in parts] == [(a, b) for a, b in zip(np.cumsum([0, *[r.length for r in parts]])[:-1].tolist(), [r.length for r in parts], strict=True)]
        assert sum(r.length for r in parts) == len(ids) and all(r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in parts)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *[r.length for r in parts]])[:-1].tolist() and sum(r.length for r in parts) <= 2048


def test_op10(spark, docs):
    """All pairs of fingerprints."""
    prints = {}
    for k, text in docs:
        words = [w.decode() for w in text.encode().lower().split()]
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    up = {k: k for k in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, DATA).collect()}
    assert got == {k: (f"{prints[k]:016x}", find(k)) for k in ids}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.sql(queries.oracle_sql()[name])
    assert cols == sorted(want.columns)
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, want.select(*[f'"{c}"' for c in cols]).fetchall()))
