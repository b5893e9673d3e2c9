"""Language identification by hierarchical discrimination.

A text is a vector of hashed letter n-grams (1 to 3 letters of words in lower case, with word edges), as shares of the whole
text. The family of its language is told first, by one linear support vector machine a family against the rest; within the family
one machine for each pair of languages votes for one of the two, so close languages are told apart by what differs between
just these. All machines are fitted on a bounded sample of documents whose language is known.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.store import materialize

SAMPLE = 1_000  # documents of each language that the machines are fitted on, about: a share by hash
MOST_LANGUAGES = 200  # the most frequent ones are learned
BITS = 11  # hashed n-grams
PIECE = 1 << 18  # letters worked on at a time

# Families of languages, by code.
FAMILIES = {
    "germanic": "en de nl af da sv no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk",
    "indic": "hi bn mr ne ur pa gu",
    "semitic": "ar he mt am",
    "sinitic": "zh yue wuu",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
LETTERS = re.compile(r"[^\W\d_]+")


def family(lang: str) -> str:
    """The family of a language; one that is in no family is a family of its own."""
    return FAMILY.get(lang.lower().split("-")[0], lang)


def grams(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams, scaled to length 1; None if the text has no letters."""
    words = LETTERS.findall(text.lower()) if text else None
    if not words:
        return None
    counts = np.zeros(1 << BITS)
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    for low in range(0, len(codes), PIECE):
        c = codes[max(0, low - 2) : low + PIECE].astype(np.uint64)
        skip = min(low, 2)
        counts += np.bincount(_slot(c[skip:]), minlength=1 << BITS)
        counts += np.bincount(_slot(c[max(skip - 1, 0) : -1] * np.uint64(0x1F123BB5) + c[max(skip - 1, 0) + 1 :]), minlength=1 << BITS)
        counts += np.bincount(_slot((c[:-2] * np.uint64(0x1F123BB5) + c[1:-1]) * np.uint64(0x1F123BB5) + c[2:]), minlength=1 << BITS)
    counts = np.sqrt(counts)
    return counts / np.linalg.norm(counts)


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


class Machines:
    """Weights of one machine for each class of a choice; a choice with one class needs none."""

    def __init__(self, names, weights, offsets):
        self.names, self.weights, self.offsets = names, weights, offsets

    def choose(self, x: np.ndarray) -> tuple[str, float]:
        """The class with the largest margin, ties by name, and the share of its odds among all."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = self.weights @ x + self.offsets
        odds = 1 / (1 + np.exp(-np.clip(4 * margins, -30, 30)))
        best = int(margins.argmax())
        return self.names[best], float(odds[best] / odds.sum())


class Pairs:
    """Weights of one machine for each pair of classes, for the first of the two where its margin is positive."""

    def __init__(self, names, pairs, weights, offsets):
        self.names, self.pairs, self.weights, self.offsets = names, pairs, weights, offsets

    def choose(self, x: np.ndarray) -> tuple[str, float]:
        """The class with most votes, ties by the sum of margins and then by name; its odds against the closest other."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        votes, margins = np.zeros((2, len(self.names)))
        odds = np.ones(len(self.names))
        for (a, b), m in zip(self.pairs, self.weights @ x + self.offsets, strict=True):
            votes[a if m >= 0 else b] += 1
            margins[a] += m
            margins[b] -= m
            sure = 1 / (1 + np.exp(-np.clip(4 * m, -30, 30)))
            odds[a], odds[b] = min(odds[a], sure), min(odds[b], 1 - sure)
        best = max(range(len(self.names)), key=lambda i: (votes[i], margins[i], -i))
        return self.names[best], float(odds[best])


def _with_grams(batches):
    for batch in batches:
        rows = [(g, lang) for g, lang in ((grams(t), lang) for t, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True)) if g is not None]
        yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows], pa.list_(pa.float64())), pa.array([lang for _, lang in rows], pa.string())], ["grams", "lang"])


def _svm(rows: DataFrame, label):
    svm = LinearSVC(maxIter=25, regParam=1e-4, standardization=False).fit(rows.select("features", label.cast("double").alias("label")))
    return svm.coefficients.toArray(), svm.intercept


def _machines(rows: DataFrame, column: str, names: list[str]) -> Machines:
    if len(names) == 1:
        return Machines(names, None, None)
    fitted = [_svm(rows, F.col(column) == name) for name in (names if len(names) > 2 else names[:1])]
    if len(names) == 2:  # one against one other
        fitted.append((-fitted[0][0], -fitted[0][1]))
    return Machines(names, np.array([w for w, _ in fitted]), np.array([b for _, b in fitted]))


def _pairs(rows: DataFrame, names: list[str]) -> Pairs:
    """A machine for each pair of languages, fitted on the rows of the two."""
    pairs = list(combinations(range(len(names)), 2))
    fitted = [_svm(rows.where(F.col("lang").isin(names[a], names[b])), F.col("lang") == names[a]) for a, b in pairs]
    return Pairs(names, pairs, np.array([w for w, _ in fitted]), np.array([b for _, b in fitted]))


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Model:
    def __init__(self, families: Machines | None, languages: dict[str, Pairs]):
        self.families, self.languages = families, languages

    def tell(self, text: str | None) -> tuple[str, float]:
        x = grams(text)
        if x is None or self.families is None:
            return "und", 0.0
        of, sure = self.families.choose(x)
        lang, close = self.languages[of].choose(x)
        return lang, sure * close


def fit(docs: DataFrame, limit: int = SAMPLE) -> Model:
    """Machines from about ``limit`` documents of each language (a share of them by a hash of the id), held-out ones excepted.

    Beyond MOST_LANGUAGES values of ``lang`` the rarer ones are not learned.
    """
    known = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return Model(None, {})
    share = F.create_map(*(F.lit(x) for r in counts for x in (r.lang, min(1.0, limit / r["count"]))))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    rows = materialize(picked.select("lang", "text").mapInArrow(_with_grams, "grams array<double>, lang string"), "grams").coalesce(4)
    families = {}
    for lang in sorted(r.lang for r in rows.select("lang").distinct().collect()):
        families.setdefault(family(lang), []).append(lang)
    if not families:
        return Model(None, {})
    told = F.create_map(*(F.lit(x) for f, langs in families.items() for lang in langs for x in (lang, f)))
    rows = rows.select(array_to_vector("grams").alias("features"), "lang", told[F.col("lang")].alias("family")).cache()
    model = Model(_machines(rows, "family", sorted(families)), {f: _pairs(rows, langs) for f, langs in families.items()})
    rows.unpersist()
    return model


def identify(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1) of every row of ``docs(doc_id, text, lang)``.

    ``lang_pred`` is a language of the sample, or ``und`` with score 0 where the text is null or has no letters, or where
    there is nothing to learn from. ``lang`` and ``doc_id`` serve to choose the sample only. A null doc_id is not held out.
    Other columns are not looked at; repeated rows are told alike; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, limit))

    @F.arrow_udf("struct<lang: string, score: double>")
    def told(texts: pa.Array) -> pa.Array:
        found = [shared.value.tell(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    rows = docs.select("doc_id", told("text").alias("told"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), F.col("told.lang").alias("lang_pred"), F.col("told.score").alias("score"))
