"""Quality rules: base rules on repetition and length, then an n-gram log-likelihood ratio of trusted text to raw text.

Words and pairs of words are hashed to ``SLOTS`` counters. One multinomial is counted over all documents, the other over
all trusted ones; a document's score is the mean log ratio of the two over its n-grams. A document is kept if its score
reaches a threshold, which is set from the scores of all labelled documents, each by counts that it is not in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm import text as T
from kerbside.llm.store import materialize

SLOTS = 1 << 14
BINS = 4096  # ranges of scores, in each of which the cuts are weighed by themselves
PRIOR = 0.05  # weight of the raw multinomial in the trusted one
SPREAD = 4.0  # a document may fall below the trusted median by so many spreads, where none is labelled as rejected
COST = 10  # a trusted document lost weighs as much as so many rejected ones kept, as shares of their classes
WINDOW = 8  # words
LEAST_WORDS, MOST_REPEATED = 20, 30  # words; words in repeated windows, per cent

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _again(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value occurs twice or more in its text, and whether it is not the first of them."""
    order = np.lexsort((h, doc))
    a, d = h[order], doc[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
    often, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    often[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return often, later


def base_counts(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The base counts of each text, and hash and text of each word."""
    rows = len(texts)
    buf, offsets = T.flat(texts)
    prefix = T.prefix_hash(buf)
    start, end, doc = T.words(buf, offsets)
    word = T.span_hash(prefix, start, end)
    n_words = np.bincount(doc, minlength=rows)

    grams, of = T.shingles(word, doc, WINDOW)
    begin = np.flatnonzero(doc[: len(word) - WINDOW + 1] == doc[WINDOW - 1 :]) if len(word) >= WINDOW else np.zeros(0, np.int64)
    at = begin[_again(grams, of)[0]]
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0

    breaks = np.flatnonzero(buf == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_of = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.sort(np.concatenate([breaks, offsets[1:]]))  # each line has one start and one end, in the same order
    inside = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(~T.SPACE[buf], out=inside[1:])
    full = inside[line_end] > inside[line_start]
    line_start, line_end, line_of = line_start[full], line_end[full], line_of[full]
    later = _again(T.span_hash(prefix, line_start, line_end), line_of)[1]

    counts = {
        "n_words": n_words,
        "word_chars": _sums(((buf & 0xC0) != 0x80) & ~T.SPACE[buf], offsets),
        "n_symbols": _sums(SYMBOL[buf], offsets),
        "n_dup_lines": np.bincount(line_of[later], minlength=rows),
        "n_repeat_words": np.bincount(doc[repeated], minlength=rows),
    }
    return counts, word, doc


def _slots(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text of each word and each pair of words."""
    pairs, of = T.shingles(word, doc, 2)
    h = np.concatenate([word, pairs])
    return (T.mix(h) & T.u64(SLOTS - 1)).astype(np.int64), np.concatenate([doc, of])


def _slot_counts(batches):
    counts = np.zeros(SLOTS, np.int64)
    for piece in T.pieces(batches):
        counts += np.bincount(_slots(*T.word_hashes(piece.column("text"), lower=False))[0], minlength=SLOTS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["slot", "seen"])


def _half_counts(batches):
    """The same for each half of the texts; slots of the second half come after those of the first."""
    counts = np.zeros(2 * SLOTS, np.int64)
    for piece in T.pieces(batches):
        slot, of = _slots(*T.word_hashes(piece.column("text"), lower=False))
        second = ~piece.column("half").to_numpy(zero_copy_only=False).astype(bool)
        counts += np.bincount(slot + SLOTS * second[of], minlength=2 * SLOTS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["slot", "seen"])


def _added(counted: DataFrame, slots: int) -> np.ndarray:
    rows = counted.groupBy("slot").agg(F.sum("seen").alias("seen")).toArrow()  # as many rows as slots at most
    counts = np.zeros(slots)
    counts[rows.column("slot").to_numpy()] = rows.column("seen").to_numpy()
    return counts


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of trusted to raw shares of the slots. Raw counts have one added; the trusted shares have the raw ones as
    their prior, with a weight of ``PRIOR``, so that the amount of trusted text shifts no ratio."""
    raw = (raw + 1) / (raw + 1).sum()
    return np.log((trusted / max(1, trusted.sum()) + PRIOR * raw) / ((1 + PRIOR) * raw))


def ratios(word: np.ndarray, doc: np.ndarray, rows: int, weights: np.ndarray) -> np.ndarray:
    """Mean log ratio over each text's n-grams; 0 for a text without words."""
    slot, of = _slots(word, doc)
    return np.bincount(of, weights[slot], minlength=rows) / np.maximum(1, np.bincount(of, minlength=rows))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows with a label. The join goes by doc_id at every size, so that no list of labels is held whole."""
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg((F.min("quality") > 0).alias("trusted"))
    rows = docs.join(good.hint("merge"), docs["doc_id"] == good["labelled"])
    return rows.select("text", "trusted", (F.pmod(F.xxhash64("text", F.lit(3)), F.lit(2)) == 0).alias("half"))


def threshold(trusted: np.ndarray, rejected: np.ndarray, spread: float = SPREAD) -> float:
    """The score from which a document is kept, given all scores of labelled documents that pass the base rules.

    Of all cuts the one of the least share of rejected documents kept plus ``COST`` times that of trusted ones lost; the
    middle of the gap it lies in, and of equal ones the lowest. Without rejected documents, the trusted median less
    ``spread`` times its distance to the tenth percentile; without trusted ones everything is kept.
    """
    if not len(trusted):
        return float("-inf")
    if not len(rejected):
        middle, low = np.percentile(trusted, [50, 10])
        return float(middle - spread * (middle - low))
    at = np.unique(np.concatenate([trusted, rejected]))
    cuts = np.concatenate([[-np.inf], (at[1:] + at[:-1]) / 2])
    lost = np.searchsorted(np.sort(trusted), cuts) / len(trusted)
    left = 1 - np.searchsorted(np.sort(rejected), cuts) / len(rejected)
    return float(cuts[np.argmin(left + COST * lost)])


def _counted(scores: DataFrame) -> tuple[DataFrame, list]:
    """Each distinct score with the trusted and rejected rows that have it and those up to it, and the score after it;
    and the totals. Running sums go by ranges of scores, whose totals alone (``BINS`` rows at most) come to the driver."""
    each = materialize(scores.groupBy("score").agg(F.count_if("trusted").alias("good"), F.count_if(~F.col("trusted")).alias("bad")), "scores")
    low, high = each.agg(F.min("score"), F.max("score")).first()
    if low is None:
        return each, [0, 0]
    place = F.floor((F.col("score") - low) / (high - low) * BINS) if high > low else F.lit(0)
    each = each.withColumn("bin", F.least(place.cast("int"), F.lit(BINS - 1)))
    bins = each.groupBy("bin").agg(F.sum("good"), F.sum("bad"), F.min("score")).orderBy("bin").collect()
    before, total = [], [0, 0]
    for i, (number, good, bad, _) in enumerate(bins):
        before.append((number, *total, bins[i + 1][3] if i + 1 < len(bins) else None))
        total = [total[0] + good, total[1] + bad]
    ahead = scores.sparkSession.createDataFrame(before, "bin int, good_before long, bad_before long, first_after double")
    inside = Window.partitionBy("bin").orderBy("score")
    each = each.join(F.broadcast(ahead), "bin")
    return each.select(
        "score",
        "good",
        "bad",
        *((F.sum(side).over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col(f"{side}_before")).alias(f"{side}_to") for side in ("good", "bad")),
        F.coalesce(F.lead("score").over(inside), "first_after").alias("next"),
    ), total


def threshold_of(scores: DataFrame, spread: float = SPREAD) -> float:
    """``threshold`` of the rows of ``scores(trusted, score)``, weighed where they are."""
    each, (trusted, rejected) = _counted(scores)
    if not trusted:
        return float("-inf")
    if not rejected:
        ranks = [q * (trusted - 1) / 100 for q in (50, 10)]
        at = [int(r) for r in ranks] + [min(int(r) + 1, trusted - 1) for r in ranks]
        found = each.agg(*(F.min(F.when(F.col("good_to") > k, F.col("score"))).alias(f"at_{i}") for i, k in enumerate(at))).first()
        middle, low = (float(np.interp(r - int(r), [0, 1], [found[i], found[i + 2]])) for i, r in enumerate(ranks))
        return middle - spread * (middle - low)
    cut = (F.col("score") + F.col("next")) / 2

    def under(side: str, total: int) -> Column:  # the middle of two scores without a number between may be the lower one
        return F.when(cut > F.col("score"), F.col(f"{side}_to")).otherwise(F.col(f"{side}_to") - F.col(side)) / F.lit(float(total))

    price = (1 - under("bad", rejected)) + COST * under("good", trusted)
    best = each.where("next IS NOT NULL").agg(F.min(F.struct(price.alias("price"), cut.alias("cut")))).first()[0]
    return best["cut"] if best and best["price"] < 1 else float("-inf")  # 1: the price of keeping everything


def judge(docs: DataFrame, labels: DataFrame, spread: float = SPREAD) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``score`` of every row of ``docs(doc_id, text)``.

    The trusted documents are all those with ``labels(doc_id, quality)`` above 0, the rejected ones all others with a
    label (of contradicting labels the lowest counts, labels with null are skipped). All trusted ones give the
    multinomial. For the threshold they are scored by the half, by a hash of the text, that they are not in, and the
    rejected ones by both halves in turn. Without trusted documents every document that passes the base rules is kept.
    Null and empty texts have counts of 0 and fail.
    Repeated rows are judged alike; other columns are not looked at; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = materialize(_labelled(docs, labels), "labelled", "zstd")  # texts, beside those of the shuffle
    seen = "slot int, seen long"
    halves = _added(labelled.where("trusted").select("text", "half").mapInArrow(_half_counts, seen), 2 * SLOTS).reshape(2, SLOTS)
    failed = f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"
    if halves.any():
        raw = _added(docs.select("text").mapInArrow(_slot_counts, seen), SLOTS)
        sides = [log_ratio(half, raw) if half.any() else None for half in halves]
        rows = _scored(labelled, [w for w in sides if w is not None], "trusted boolean, half boolean").where(f"NOT ({failed})")
        # Each half's counts score the other half of the trusted rows, and all rejected ones.
        names = iter(["score", "score_1"])
        by = [(side, F.col(next(names))) for side, w in zip((True, False), sides, strict=True) if w is not None]
        found = [F.when(~F.col("trusted") | (F.col("half") != side), score) for side, score in by]
        cut = threshold_of(rows.select("trusted", F.explode(F.array(*found)).alias("score")).where("score IS NOT NULL"), spread)
        weights = log_ratio(halves.sum(axis=0), raw)
    else:
        cut, weights = float("-inf"), np.zeros(SLOTS)
    rows = _scored(docs, [weights], "doc_id long").withColumn("base_failed", F.expr(failed))
    kept = ~F.col("base_failed") & (F.col("score") >= cut)
    return rows.select("doc_id", *BASE, "base_failed", kept.alias("kept"), "score")


def _scored(rows: DataFrame, weights: list[np.ndarray], carried: str) -> DataFrame:
    """The columns ``carried``, the base counts and the scores (``score``, ``score_1``) of each row's text."""
    shared, names = rows.sparkSession.sparkContext.broadcast(weights), [c.split()[0] for c in carried.split(", ")]
    scores = ["score", "score_1"][: len(weights)]

    def scored(batches):
        for piece in T.pieces(batches):
            counts, word, doc = base_counts(piece.column("text"))
            columns = {name: piece.column(name) for name in names} | {c: pa.array(counts[c].astype(np.int64)) for c in BASE}
            yield pa.RecordBatch.from_pydict(columns | {c: pa.array(ratios(word, doc, piece.num_rows, w)) for c, w in zip(scores, shared.value, strict=True)})

    return rows.select(*names, "text").mapInArrow(scored, f"{carried}, {', '.join(f'{c} long' for c in BASE)}, {', '.join(f'{c} double' for c in scores)}")
