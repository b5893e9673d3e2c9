"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features (whole text): hits of a lexicon, their density, hits that appear only once letters written as signs are read
back, nearness of a hit to a second-person pronoun, rates of capitals, of words in capitals, of exclamation and question
marks, of other punctuation, of obfuscated words and of repeated letters, and the length. The lexicon is a fixed list of
words; a second one is learned from the labelled rows: beginnings of words and whole words, each with the share of a
text's words from which on it marks toxic texts. One entry covers all inflected and compound forms of a stem. Entries are
chosen one by one for the toxic texts that none before explains, so a language or class with few of them gets its own.

The labelled rows are parted by a hash of the text, so that copies fall together: eight of ten parts fit the trees (six
of these choose the learned entries), the rest the calibration.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.store import materialize

SAMPLE = 20_000  # labelled rows that the model is fitted on, at most

# Insults and slurs of abuse in English, German, French and Spanish, as plain words.
LEXICON = frozenset(
    """idiot idiots moron morons stupid dumb fool fools loser losers scum trash garbage pathetic worthless disgusting
    clown clowns jerk imbecile cretin vermin filth filthy crap damn bastard bitch asshole shit fuck fucking hate kill ugly
    dummkopf arschloch scheiße scheisse blöd depp trottel abschaum widerlich wertlos erbärmlich hurensohn drecksau
    imbécile connard salaud ordure dégoûtant minable abruti crétin merde pourriture
    idiota estúpido imbécil basura asqueroso patético escoria inútil tonto mierda gilipollas cabrón payaso""".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr tu toi te ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestra".split()
)
# Signs that stand for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i", "*": "", ".": "", "-": "", "_": ""})
LETTERS = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"[^\W\d_][\d@$*!|._-]+[^\W\d_]")
BREAK = re.compile(r"\s")
SHOUTED = re.compile(r"(?<![A-Z])[A-Z]{2,}(?![A-Za-z])")
DRAWN = re.compile(r"([^\W\d_])\1\1")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"
NAMES = ["hits", "density", "masked_hits", "near", "capitals", "shouted", "exclaimed", "asked", "marks", "masked", "drawn", "length", "stem_hits", "stem_density", "stem_ratio"]
END = " "  # closes an entry that is a whole word
BEGINNINGS = (3, 4, 5, 6, 8)  # letters
SHARES = (0.001, 0.0025, 0.005, 0.01)  # of a text's words
LEAST_GAIN = 0.01  # of the toxic texts not yet explained, that an entry must add
CONTRAST = 10  # times as common in toxic texts as in others
EVIDENCE = 14.0  # nats by which chance is excluded, more than the logarithm of the number of entries tried
MOST_STEMS = 200


def _masked_words(low: str) -> list[str]:
    """Runs without white space in which signs or digits stand between letters."""
    found, end = [], 0
    for m in MASKED.finditer(low):
        if m.start() >= end:
            start = m.start()
            while start > end and not low[start - 1].isspace():
                start -= 1
            stop = BREAK.search(low, m.end())
            end = stop.start() if stop else len(low)
            found.append(low[start:end])
    return found


def subwords(words: Counter) -> Counter:
    """Occurrences of the beginnings of the words, and of whole words (with END)."""
    found: Counter = Counter()
    for w, n in words.items():
        found[w + END] += n
        for k in BEGINNINGS:
            if len(w) < k:
                break
            found[w[:k]] += n
    return found


class Lexicon:
    """Marking words, and marking subwords with the share of a text's words that each needs."""

    def __init__(self, words=LEXICON, stems: dict[str, float] | None = None):
        self.words, self.stems = frozenset(words), dict(stems or {})
        self.lengths = sorted({len(s) for s in self.stems if not s.endswith(END)})

    def hits(self, words: list[str]) -> Counter:
        found: Counter = Counter()
        for w, n in Counter(words).items():
            if w + END in self.stems:
                found[w + END] += n
            for k in self.lengths:
                if len(w) >= k and w[:k] in self.stems:
                    found[w[:k]] += n
        return found


def measure(text: str | None, lexicon: Lexicon) -> list[float]:
    """The features of one text, all 0 if it is null or empty."""
    if not text:
        return [0.0] * len(NAMES)
    low = text.lower()
    words = LETTERS.findall(low)
    at = [i for i, w in enumerate(words) if w in lexicon.words]
    near = 0.0
    for i in at:
        around = [abs(i - j) for j in range(max(0, i - 8), min(len(words), i + 9)) if j != i and words[j] in SECOND_PERSON]
        near = max(near, 1 / min(around)) if around else near
    masked = _masked_words(low)
    plain = [LETTERS.findall(m.translate(SIGNS)) for m in masked]
    found = sum(any(w in lexicon.words for w in p) and not any(w in lexicon.words for w in LETTERS.findall(m)) for m, p in zip(masked, plain, strict=True))
    raw = text.encode("utf-8", "surrogatepass")
    size, count = len(raw), max(1, len(words))
    capitals = size - len(raw.translate(None, CAPITALS))
    marks = size - len(raw.translate(None, MARKS))
    stems = lexicon.hits(words)
    most = max(stems.values(), default=0)
    ratio = max((n / count / lexicon.stems[s] for s, n in stems.items()), default=0.0)
    return [
        float(len(at)), len(at) / count, float(found), near, capitals / size, len(SHOUTED.findall(text)) / count,
        text.count("!") / count, text.count("?") / count, marks / size, len(masked) / count, len(DRAWN.findall(low)) / count, math.log1p(count),
        float(most), most / count, min(ratio, 8.0),
    ]


def features(lexicon: Lexicon):
    """Function of a text column that gives its features as an array."""

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([measure(t.as_py(), lexicon) for t in texts], pa.list_(pa.float64()))

    return measured


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labelled rows for learning, ``text`` and ``label``; contradicting labels of one doc_id count as toxic."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    known = known.where(~held_out("labelled")).orderBy(F.xxhash64("labelled"), "labelled").limit(limit)
    few = F.broadcast(known)  # at most `limit` rows of two numbers
    rows = docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("labelled")).select("text", F.col("label").cast("double").alias("label"))
    return rows.select("*", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(10)).alias("part"))


def _marks(batches, wanted=None):
    """``entry``, ``share`` (its place in SHARES) and the numbers of texts of both classes that hold the entry to that share."""
    for batch in batches:
        seen: dict[tuple[str, int], list[int]] = {}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            for key in _entries(text, wanted):
                seen.setdefault(key, [0, 0])[int(label)] += 1
        columns = [[k[0] for k in seen], [k[1] for k in seen], [v[0] for v in seen.values()], [v[1] for v in seen.values()]]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["entry", "share", "mild", "toxic"])


def _entries(text: str | None, wanted) -> list[tuple[str, int]]:
    words = LETTERS.findall((text or "").lower())
    total = max(1, len(words))
    found = subwords(Counter(words))
    kept = found.items() if wanted is None else ((e, found[e]) for e in wanted.keys() & found.keys())
    return [(e, i) for e, n in kept for i, share in enumerate(SHARES) if n >= share * total]


def _counted(rows: DataFrame, wanted=None) -> DataFrame:
    counted = rows.select("text", "label").mapInArrow(lambda batches: _marks(batches, wanted), "entry string, share int, mild long, toxic long")
    return counted.groupBy("entry", "share").agg(F.sum("mild").alias("mild"), F.sum("toxic").alias("toxic"))


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Marking subwords of ``rows(text, label)``, a bounded sample, and the share of a text's words that each needs.

    Candidates are in LEAST_GAIN of the toxic texts, CONTRAST times as common there as in the others, and beyond chance:
    the divergence of their texts' share of toxic ones from that of all is EVIDENCE or more. The one that explains most toxic texts no earlier one explains is taken next, with ties to the better contrast, the shorter and
    the first by code point, until none adds LEAST_GAIN of those left. No class or no candidate: none.
    """
    mild, toxic = (rows.where(f"label = {x}").count() for x in (0, 1))
    if not mild or not toxic:
        return {}
    often = _counted(rows.where("label = 1")).where(F.col("toxic") >= max(3, LEAST_GAIN * toxic)).select("entry").distinct()
    wanted = dict.fromkeys(r.entry for r in often.collect())  # each is in LEAST_GAIN of the toxic texts of a bounded sample
    contrast = (F.col("toxic") / toxic) / ((F.col("mild") + 0.5) / mild)
    base, held = toxic / (mild + toxic), F.col("toxic") + F.col("mild")
    diverges = F.col("toxic") * F.log(F.col("toxic") / held / base) + F.when(F.col("mild") > 0, F.col("mild") * F.log(F.col("mild") / held / (1 - base))).otherwise(0.0)
    marked = _counted(rows, wanted).where((F.col("toxic") >= max(3, LEAST_GAIN * toxic)) & (contrast >= CONTRAST) & (diverges >= EVIDENCE))
    scored = {(r.entry, r.share): r.contrast for r in marked.select("entry", "share", contrast.alias("contrast")).collect()}
    names = dict.fromkeys(e for e, _ in scored)

    def explained(batches):
        for batch in batches:
            lists = [[[e, i] for e, i in _entries(t, names) if (e, i) in scored] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[f"{i}{e}" for e, i in x] for x in lists], pa.list_(pa.string()))], ["held"])

    texts = rows.where("label = 1").select("text").mapInArrow(explained, "held array<string>").collect()  # of a bounded sample
    holders: dict[tuple[str, int], set[int]] = {}
    for number, row in enumerate(texts):
        for h in row.held:
            holders.setdefault((h[1:], int(h[0])), set()).add(number)
    left, stems = set(range(len(texts))), {}
    while holders and len(stems) < MOST_STEMS:
        gains = {key: len(held & left) for key, held in holders.items()}
        best = min(holders, key=lambda key: (-gains[key], -scored[key], len(key[0]), key))
        if gains[best] < max(3, LEAST_GAIN * len(left)):
            break
        stems[best[0]] = min(SHARES[best[1]], stems.get(best[0], 1.0))
        left -= holders.pop(best)
    return stems


class Model:
    """A fitted lexicon, trees and calibration; ``base`` where the labels give no two classes to tell apart."""

    def __init__(self, lexicon=None, trees=None, calibration=None, base=0.0):
        self.lexicon, self.trees, self.calibration, self.base = lexicon or Lexicon(), trees, calibration, base

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc`` (the row of docs as a struct) and ``score``."""
        rows = docs.select(F.struct("*").alias("doc"))
        if self.trees is None:
            return rows.select("doc", F.lit(float(self.base)).alias("score"))
        rows = rows.select("doc", array_to_vector(features(self.lexicon)(F.col("doc.text"))).alias("features"))
        rows = self.trees.transform(rows).select("doc", vector_to_array("probability")[1].alias("raw"))
        if self.calibration is None:
            return rows.select("doc", F.col("raw").alias("score"))
        rows = self.calibration.transform(rows)
        return rows.select("doc", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, words=LEXICON) -> Model:
    rows = materialize(_sample(docs, labels, limit), "labelled").coalesce(4)
    classes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(classes) < 2:
        return Model(base=1.0 if classes.get(1.0) else 0.0)
    lexicon = Lexicon(words, learn_stems(rows.where("part < 6")))
    dense = materialize(rows.select("label", "part", array_to_vector(features(lexicon)(F.col("text"))).alias("features")), "features").coalesce(2)
    fitted = dense.where("part < 8")
    if fitted.select("label").distinct().count() < 2:
        fitted = dense
    least = max(3, fitted.count() // 50)  # a leaf of fewer rows would learn wrong labels
    trees = GBTClassifier(maxDepth=3, maxIter=15, stepSize=0.2, minInstancesPerNode=least, seed=7).fit(fitted)
    checked = trees.transform(dense.where("part >= 8")).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = None
    if checked.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(materialize(checked, "checked").coalesce(1))
    return Model(lexicon, trees, calibration)


def score(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every row of ``docs(doc_id, text)``.

    ``labels(doc_id, toxic)`` give the classes of at most ``limit`` rows that are not held out; ids and labels are no
    inputs of a score. Null and empty texts have all features 0 and the score of such a text. Labels with null are
    skipped; without labels of both classes every score is 0, or 1 if all are toxic. A null doc_id is not held out.
    Repeated rows score alike; other columns are not looked at; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = fit(docs, labels, limit).score(docs)
    return scored.select(F.col("doc.doc_id").alias("doc_id"), held_out("doc.doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with the columns of ``docs``."""
    return fit(docs, labels, limit).score(docs).where("score < 0.5").select("doc.*")
