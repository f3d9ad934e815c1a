"""Benchmark decontamination by winnowing, with DataFrame functions only.

Of each window of consecutive k-gram hashes the least is kept, in documents as in benchmark items, so two texts that
share `width` words share a kept hash at the same place. Kept hashes are joined, and each hit is extended to the windows
around it by comparing the words' hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import let

WIDTH = 10
#: Words of a hashed gram; the windows over their hashes have WIDTH - GRAM + 1 places.
GRAM = 5
#: So many kept hashes of the benchmark are broadcast at most (about 200 bytes each); more are joined by a shuffle.
MOST_BROADCAST = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text, not lower-cased. Null: none. Splitting is cheaper than matching: Java copies a match's state."""

    def inner(parts: Column) -> Column:
        # a text that begins or ends with a separator has an empty part there
        begin = (F.get(parts, F.lit(0)) == "").cast("int")
        end = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
        return F.slice(parts, begin + 1, F.size(parts) - begin - end)

    return let(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1), inner)


def _hashed(found: Column) -> Column:
    """64-bit hashes of words with A-Z lower-cased; lower() does the same to words that are ASCII throughout, and faster."""
    return F.transform(found, lambda w: F.xxhash64(F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _LOWER))))


def _kept(hashes: Column, fill: int, width: int, gram: int) -> Column:
    """array<struct<pos, key, around, n>>: the kept grams of a text of at least `width` words, each with the hashes of the
    words from width - gram before it to width after its start; places outside the text have the hash `fill`."""
    span = width - gram + 1
    grams = F.transform(F.sequence(F.lit(0), F.size(hashes) - gram), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(gram)]))
    edge = F.array_repeat(F.lit(fill).cast("long"), span - 1)

    def places(g: Column) -> Column:
        least = lambda i: let(F.slice(g, i + 1, F.lit(span)), lambda s: i + F.array_position(s, F.array_min(s)).cast("int") - 1)
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(g) - span), least))

    rows = let(
        grams,
        lambda g: let(
            F.concat(edge, hashes, edge),
            lambda wide: F.transform(places(g), lambda p: F.struct(p.alias("pos"), F.get(g, p).alias("key"), F.slice(wide, p + 1, F.lit(width + span - 1)).alias("around"), F.lit(0).alias("n"))),
        ),
    )
    return F.when(F.size(hashes) >= width, rows)


def _whole(hashes: Column, length: int) -> Column:
    """array<struct<pos, key, around, n>>: all runs of `length` words, keyed by all of them."""

    def run(i: Column) -> Column:
        return let(F.slice(hashes, i + 1, F.lit(length)), lambda s: F.struct(i.alias("pos"), F.xxhash64(s).alias("key"), s.alias("around"), F.lit(length).alias("n")))

    return F.when(F.size(hashes) >= length, F.transform(F.sequence(F.lit(0), F.size(hashes) - length), run))


def _joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    few = right.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    return left.join(F.broadcast(right) if few else right, ["key", "n"], how)


def hits(docs: DataFrame, items: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """docs: doc_id, mark, text; items: item_id, text. Returns doc_id, mark, n_words, item_id, pos, len.

    One row for each row of docs, with n_words alone; and, without it, one for each place where a window of an item
    occurs in a document. So the texts are read and cut into words once. Rows with n_words have the text's mark as key,
    and a length that no window has, so that a shuffle deals them out like others.
    """
    doc = docs.select("doc_id", "mark", _hashed(words(F.col("text"))).alias("h"))
    item = items.select("item_id", _hashed(words(F.col("text"))).alias("h")).withColumn("n", F.size("h"))
    # items of fewer words are one window each; there are at most width - 1 lengths
    lengths = sorted(r.n for r in item.filter((F.col("n") > 0) & (F.col("n") < width)).select("n").distinct().collect())

    def rows(h: Column) -> Column:
        own = F.struct(F.size(h).alias("pos"), F.xxhash64("doc_id", "mark").alias("key"), F.lit(None).cast("array<bigint>").alias("around"), F.lit(-1).alias("n"))
        return F.concat(*[F.coalesce(x, F.array()) for x in (_kept(h, 0, width, gram), *[_whole(h, n) for n in lengths])], F.array(own))

    left = doc.select("doc_id", "mark", F.explode(let(F.col("h"), rows)).alias("x")).select("doc_id", "mark", "x.*")
    long = item.filter(F.col("n") >= width).select("item_id", F.explode(let(F.col("h"), lambda h: _kept(h, 1, width, gram))).alias("x")).select("item_id", "x.key", "x.n", F.col("x.around").alias("other"))
    short = item.filter((F.col("n") > 0) & (F.col("n") < width)).select("item_id", F.xxhash64("h").alias("key"), "n", F.col("h").alias("other"))
    right = long.union(short).distinct()
    windows = F.filter(F.sequence(F.lit(0), F.lit(width - gram)), lambda s: F.slice("around", s + 1, F.lit(width)) == F.slice("other", s + 1, F.lit(width)))
    places = F.when(F.col("n") < 0, F.array(F.lit(0))).when(F.col("n") == 0, windows).when(F.col("around") == F.col("other"), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    joined = _joined(left, right, "left").filter((F.col("n") < 0) | F.col("item_id").isNotNull())
    found = joined.select("doc_id", "mark", "item_id", "pos", "n", F.explode(places).alias("s"))
    return found.select(
        "doc_id", "mark", F.when(F.col("n") < 0, F.col("pos")).alias("n_words"), "item_id",
        F.when(F.col("n") == 0, F.col("pos") + F.col("s") - (width - gram)).when(F.col("n") > 0, F.col("pos")).alias("pos"), F.when(F.col("n") == 0, width).otherwise(F.col("n")).alias("len"),
    )


def _covered(spans: Column) -> Column:
    """Number of words in a sorted array of struct<pos, len>."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def add(a: Column, x: Column) -> Column:
        end = x["pos"] + x["len"]
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["total"] + F.greatest(F.lit(0), end - F.greatest(a["end"], x["pos"]))).alias("total"))

    return F.aggregate(spans, start, add, lambda a: a["total"])


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", marks: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; with marks, also mark,
    the text's xxhash64, which tells rows of one id or of none apart.

    A window is `width` consecutive words of an item, or all words of an item of fewer; a document's word is hit inside
    any occurrence of one. Null and empty texts have no words and no hits, as have items without words; items without
    an id are left out, repeated items count once. Null ids and repeated rows of docs are kept: results belong to an id
    with its text. Empty tables give empty results or no hits. Other columns are not looked at.
    """
    only = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("mark", F.xxhash64("text"))
    known = items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    by_doc = hits(only, known, width, gram).groupBy("doc_id", "mark").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("times"),
        F.array_sort(F.collect_set(F.when(F.col("pos").isNotNull(), F.struct("pos", "len")))).alias("at"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    told = by_doc.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), _covered(F.col("at")).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("at") > 0).alias("contaminated"), *(["mark"] if marks else []), "times",
    )
    # equal rows were counted together
    return told.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times", "again")
