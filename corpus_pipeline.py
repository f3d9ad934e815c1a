"""The corpus pipeline: stages over documents, each of which works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import decontaminate, langid, packing, pii, simhash
from quarrymill.llm.common import MOST_IDS, counted, stored, table

#: Not expressible in SQL: stages learn a model, hash by XXH64 and search for a packing.
ORACLE_SQL = None
#: Pairs of id and mark that are broadcast at most; hashed, they take about three times the room of ids alone.
MOST_KEYS = MOST_IDS // 3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is found; those without a letter go, so null and empty texts do. The model
    learns from documents' lang; without any, all documents are rejected. Rows are judged one by one: repeated ones and
    those without an id stay or go like others. Other columns are not looked at, and stay."""
    return langid.accepted(docs, langid.fit(docs))


def _with(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of docs whose id and text are (left_semi) or are not (left_anti) among keys: id and mark, of rows judged."""
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["id"]) & (F.xxhash64(docs["text"]) == keys["mark"]), how)


def _keys(found: DataFrame) -> DataFrame:
    return found.select(F.col("doc_id").alias("id"), "mark")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies one row: that of the least doc_id, then of the least hash of its text. Rows
    without an id are compared like others, and stay only where no row of their group has an id. Null and empty texts are
    one group. Groups are op10's: 64-bit fingerprints of three-word shingles that differ in two bits at most; two texts
    with a tenth of their words changed differ in more, and stay."""
    found = stored(simhash.copies(docs), "groups")
    repeated = stored(_keys(found.filter("not copy")).groupBy("id", "mark").count().filter("count > 1").select("id", "mark"), "repeated")
    out = _with(docs, counted(_keys(found.filter("copy")).union(repeated), "gone", MOST_KEYS), "left_anti")
    if not repeated.isEmpty():
        again = _with(docs, repeated, "left_semi").withColumn("_mark", F.xxhash64("text"))
        out = out.union(again.dropDuplicates(["doc_id", "_mark"]).drop("_mark"))
    return out


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that share no window with a benchmark item. Rows are judged each by its own text, whatever others
    have its id; null and empty texts stay, as do repeated rows. Without a benchmark all stay."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), marks=True).filter("contaminated")
    return _with(docs, counted(_keys(found).distinct(), "hit", MOST_KEYS), "left_anti")


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of personal data; n_chars, where there is one, follows the text. All rows stay; null and
    empty texts, and those without personal data, stay as they are."""
    out = pii.mask(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences. Null and empty texts are one id; repeated rows and rows
    without an id are packed each; an empty table gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("without_pii", without_pii),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
