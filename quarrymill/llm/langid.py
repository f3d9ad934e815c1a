"""Language identification in two steps: a language family, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarrymill.llm.common import chunks, id_and_text

#: Hashed byte trigrams, as a power of two.
BITS = 12
#: Labelled texts of each language, about, from which the machines are fitted.
PER_LANGUAGE = 500

#: Families of language codes; a code that is not here is a family of its own. Fixed values.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa sa si ur",
    "turkic": "az kk ky tr tt uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "celtic": "br cy ga gd",
    "baltic": "lt lv",
    "sinitic": "yue zh",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
#: ASCII bytes other than letters become spaces.
_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
_MAYBE = re.compile(r"[^\W\d_]")


def family(lang: str) -> str:
    return _FAMILY.get(re.split(r"[-_]", lang.lower())[0], lang)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _MAYBE.finditer(text))


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Square roots of the counts of hashed byte trigrams of the lower-cased words of a whole text, scaled to length 1."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    x = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(1 << bits, np.float32)
    mixed = (x[:-2] * np.uint32(0x10001) + x[1:-1] * np.uint32(0x101) + x[2:]) * np.uint32(0x9E3779B1)
    found = np.sqrt(np.bincount(mixed >> np.uint32(32 - bits), minlength=1 << bits)).astype(np.float32)
    return found / max(np.linalg.norm(found), 1e-9)


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, both classes weighing the same, by accelerated gradient descent. y: 1 or -1."""
    x1 = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = look = np.zeros(x1.shape[1], np.float32)
    step = np.float32(1 / (2 * 2 + penalty))  # rows have squared length 2
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ look))
        grad = penalty * look - 2 * x1.T @ (weight * y * slack)
        new = look - step * grad
        look, w = new + np.float32(k / (k + 3)) * (new - w), new
    return w[:-1], float(w[-1])


class Model:
    """One-versus-one machines between families, and between the languages of each family."""

    def __init__(self, langs: list[str], x: np.ndarray):
        kinds = [family(a) for a in langs]
        self.names = {"": sorted(set(kinds))} | {f: sorted({a for a, k in zip(langs, kinds, strict=True) if k == f}) for f in set(kinds)}
        rows, self.bias, self.place = [], [], {}
        for group, names in self.names.items():
            of = np.array(kinds if group == "" else [a if k == group else "" for a, k in zip(langs, kinds, strict=True)])
            self.place[group] = len(rows)
            for a, b in combinations(names, 2):
                take = (of == a) | (of == b)
                w, c = fit_machine(x[take], np.where(of[take] == a, 1, -1).astype(np.float32))
                rows.append(w)
                self.bias.append(c)
        self.w = np.array(rows, np.float32).reshape(-1, x.shape[1])
        self.bias = np.array(self.bias, np.float32)

    def _choose(self, group: str, margin: np.ndarray) -> tuple[str, float]:
        """By votes, then by the sum of margins; the score falls with the winner's least margin."""
        names, at = self.names[group], self.place[group]
        votes = [[0, 0.0, np.inf] for _ in names]
        for k, (a, b) in enumerate(combinations(range(len(names)), 2)):
            m = float(margin[at + k])
            for who, sign in ((a, m), (b, -m)):
                votes[who] = [votes[who][0] + (sign > 0), votes[who][1] + sign, min(votes[who][2], sign)]
        best = max(range(len(names)), key=lambda k: (votes[k][:2], -k))
        return names[best], 1 / (1 + float(np.exp(-4 * min(votes[best][2], 20))))

    def predict(self, text: str) -> tuple[str, float]:
        if not self.names[""] or not has_letter(text):
            return "und", 0.0
        margin = self.w @ features(text) + self.bias
        kind, sure = self._choose("", margin)
        lang, more = self._choose(kind, margin)
        return lang, sure * more


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = PER_LANGUAGE, id_col: str = "doc_id") -> Model:
    """From about `per_language` texts of each language, chosen by a hash of the id; null texts and languages are left out."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return Model([], np.zeros((0, 1 << BITS), np.float32))
    rates = F.create_map(*[F.lit(v) for lang, n in counts for v in (lang, min(1.0, per_language / n))])
    chosen = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.element_at(rates, F.col("lang")) * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            keep = [has_letter(t) for t in texts]
            found = [features(t).astype(np.float16).tobytes() for t, k in zip(texts, keep, strict=True) if k]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), pa.array(found, pa.binary())], ["lang", "x"])

    rows = sorted(chosen.select("lang", "text").mapInArrow(run, "lang string, x binary").collect())
    x = np.frombuffer(b"".join(r.x for r in rows), np.float16).astype(np.float32).reshape(-1, 1 << BITS)
    return Model([r.lang for r in rows], x)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", langs: set[str] | None = None) -> DataFrame:
    """The rows of docs, whole, whose text is in one of the languages (None: in any); `und` is none. All columns stay."""
    if not isinstance(docs.schema[text_col].dataType, StringType):
        raise ValueError(f"{text_col} is no string")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py() or "")[0] for t in batch.column(at)]
            yield batch.filter(pa.array([lang != "und" and (langs is None or lang in langs) for lang in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, lang_pred, score (0 to 1), from the whole text alone.

    lang_pred is `und`, with score 0, if the text is null or has no letter, or if nothing was learned. Null ids and
    repeated rows are kept; an empty table gives an empty result; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in chunks(batch.column(1)):
                lang, score = zip(*(model.predict(t.decode("utf-8", "replace")) for t in texts), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
