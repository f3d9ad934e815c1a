"""Stages of the pipeline on rows with repeated and null ids."""

import random

import corpus_pipeline

KIND = "doc_id long, text string, lang string, source string, n_chars long, mark string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "m") for i, t in rows], KIND)


def texts(n):
    rng = random.Random(11)
    return [" ".join(f"w{rng.randrange(400)}" for _ in range(80)) for _ in range(n)]


def key(row):
    return (row[0] is None, row)


def told(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=key)


def test_near_duplicates_judges_rows_not_ids(spark):
    a, b, c, d, e = texts(5)
    # 3 is there twice and a copy of 1 once; 5 has two texts and one of them twice; without an id are a copy of 1 and c twice
    rows = [(1, a), (3, a), (3, b), (5, d), (5, e), (5, e), (None, a), (None, c), (None, c), (6, e)]
    got = told(corpus_pipeline.near_duplicates(spark, frame(spark, rows), ""))
    assert got == sorted([(1, a), (3, b), (5, d), (5, e), (None, c)], key=key)
    alone = corpus_pipeline.near_duplicates(spark, frame(spark, [(3, a), (3, b), (None, c)]), "")
    assert told(alone) == sorted([(3, a), (3, b), (None, c)], key=key) and alone.columns == frame(spark, []).columns


def test_decontaminated_judges_rows_not_ids(spark, tmp_path):
    a, b, c, d = texts(4)
    bad = " ".join(a.split()[20:40])
    spark.createDataFrame([("i", bad)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, a), (None, b), (4, a), (4, c), (7, d), (7, d), (8, a)]
    got = told(corpus_pipeline.decontaminated(spark, frame(spark, rows), str(tmp_path)))
    assert got == sorted([(None, b), (4, c), (7, d), (7, d)], key=key)


ODD = [(1, None), (1, ""), (2, "..."), (None, None), (3, "ein Satz mit Worten"), (3, "ein Satz mit Worten"), (4, "a sentence with words, a@b.co")]


def test_every_stage_on_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, clashing columns and empty tables; filters keep the columns of documents."""
    spark.createDataFrame([("i", "b " * 12), (None, "a"), ("j", None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, ODD)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        got[name] = out.collect()
        assert name == "packed" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    assert sorted(r.doc_id for r in got["language"]) == [3, 3, 4]
    # of the texts without words one stays, of equal rows one
    assert sorted(r.doc_id for r in got["near_duplicates"]) == [1, 2, 3, 4]
    assert len(got["decontaminated"]) == len(got["without_pii"]) == len(got["packed"]) == len(ODD)
    masked = {r.doc_id: r for r in got["without_pii"]}
    assert masked[4].text == "a sentence with words, [EMAIL]" and masked[4].n_chars == len(masked[4].text)


def test_stages_without_n_chars(spark, tmp_path):
    docs = frame(spark, ODD).drop("n_chars")
    assert corpus_pipeline.without_pii(spark, docs, str(tmp_path)).columns == docs.columns


def test_shuffles_give_the_same(spark, tmp_path, monkeypatch):
    a, b, c, d = texts(4)
    spark.createDataFrame([("i", " ".join(a.split()[20:40]))], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(1, a), (2, a), (None, b), (3, b), (4, c), (4, c), (5, d)])
    want = [told(stage(spark, docs, str(tmp_path))) for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontaminated)]
    monkeypatch.setattr(corpus_pipeline, "MOST_KEYS", 0)
    assert [told(stage(spark, docs, str(tmp_path))) for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontaminated)] == want


def test_run_is_its_stages(spark):
    """The whole pipeline on the smallest tables: what each stage keeps, by plain versions of the last two."""
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = {r.doc_id for r in docs.collect()}
    assert got and {r.doc_id for r in got} <= known
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:i]) for i in range(len(parts))]
