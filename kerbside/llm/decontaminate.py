"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Seeds are the word n-grams of the test items that would rarely arise by chance: the product of the shares of their words
in the whole corpus is below a bound. (How often a seed itself occurs says nothing: a leaked item may be in a third of
all documents.) Leaks also make an item's own words frequent, so an item of whose n-grams too few are rare gives all of
them, and one shorter than a seed its whole sequence of words. A document that has a seed is joined to its item, and a window of the document around each group of
seeds is aligned with the item word by word. Edited, cut or paraphrased copies keep some seed and a high score.

Items are few against the corpus; they and their seeds are broadcast once their size has been checked, and a benchmark
beyond ``MOST_CHARS`` characters is refused.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm import text as T
from kerbside.llm.store import materialize

N = 3  # words in a seed
CHANCE = 1e-8  # most expected occurrences of a seed for each word of text
RARE = 0.5  # least share of an item's n-grams that are rare for the others to be left out
SCORE = 0.5  # least alignment score, as a share of that of a whole copy
MATCH, OTHER, GAP = 2, -1, -1  # scores of a pair of equal words, of unequal words, and of a word alone
MOST_CHARS = 16_000_000  # of all items
PAIRS = "doc_id long, item_id long, score double, matched int, first_word int, last_word int"


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each word with at least one letter or digit, A-Z in lower case, without ASCII punctuation at its ends."""
    buf, offsets = T.flat(column)
    buf = T.LOWER[buf]
    start, end, doc = T.words(buf, offsets)
    plain = np.ones(len(buf) + 1, bool)
    plain[:-1] = ~PUNCTUATION[buf]
    after = np.minimum.accumulate(np.where(plain, np.arange(len(plain)), len(plain))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(plain, np.arange(len(plain)), -1))
    first = after[start]
    last = before[end - 1] + 1 if len(end) else end
    keep = (first < end) & (last > start)
    return T.span_hash(T.prefix_hash(buf), first[keep], last[keep]), doc[keep]


PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def _word_counts(vocabulary):
    """Occurrences of the words of ``vocabulary`` (ascending hashes) and of all words, one row for each word and task."""

    def run(batches):
        counts, total = np.zeros(len(vocabulary.value), np.int64), 0
        for piece in T.pieces(batches):
            h, _ = _tokens(piece.column("text"))
            total += len(h)
            counts += _hits(vocabulary.value, h)[1]
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(vocabulary.value[at], 0).view(np.int64)), pa.array(np.append(counts[at], 0)), pa.array(np.append(np.zeros(len(at), np.int64), total))],
            ["word", "seen", "total"],
        )

    return run


def _hits(known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values of ``h`` are in ``known`` (ascending), and how often each of ``known`` is met."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.flatnonzero(_filter(known)[(h >> T.u64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
    same = known[at] == h[maybe]
    return maybe[same], np.bincount(at[same], minlength=len(known))


_filters: list[tuple[np.ndarray, np.ndarray]] = []  # of the last few tables, each with the table it is of


def _filter(known: np.ndarray) -> np.ndarray:
    """A bit for each value of the first 20 bits that occurs."""
    for table, bits in _filters:
        if table is known:
            return bits
    bits = np.zeros(1 << 20, bool)
    bits[(known >> T.u64(44)).astype(np.int64)] = True
    _filters[:] = [(known, bits), *_filters[:3]]
    return bits


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int, int]:
    """Smith-Waterman: best local score as a share of the item's, number of equal words, first and last word in ``passage``."""
    n, m = len(item), len(passage)
    if not n or not m:
        return 0.0, 0, 0, 0
    score = np.zeros((n + 1, m + 1), np.int32)
    steps = np.arange(m + 1, dtype=np.int32) * -GAP
    for i in range(1, n + 1):
        row = np.zeros(m + 1, np.int32)
        row[1:] = np.maximum(score[i - 1, :-1] + np.where(passage == item[i - 1], MATCH, OTHER), score[i - 1, 1:] + GAP)
        score[i] = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + steps) - steps, 0)  # runs of gaps along the row
    i, j = divmod(int(score.argmax()), m + 1)
    best, last, equal = int(score[i, j]), j - 1, 0
    while i and j and score[i, j] > 0:
        same = passage[j - 1] == item[i - 1]
        if score[i, j] == score[i - 1, j - 1] + (MATCH if same else OTHER):
            i, j, equal = i - 1, j - 1, equal + same
        elif score[i, j] == score[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best / (MATCH * n), int(equal), j, last


def _best(item, words, at, least):
    """Best alignment of an item with a document's ``words`` around the positions ``at`` of seeds, in windows that overlap
    by more than an item, so that none is cut and a long run of seeds is not one large table. A score of ``least`` takes
    as large a share of equal words, so windows with fewer of the item's words are passed over."""
    reach = 2 * len(item)
    best = (0.0, 0, 0, 0)
    at = np.unique(at)
    while len(at):
        low = max(0, int(at[0]) - reach)
        high = min(len(words), int(at[0]) + 2 * reach)
        if np.isin(item, words[low:high]).sum() >= least * len(item):
            got, equal, first, last = align(item, words[low:high])
            best = max(best, (got, equal, -(low + first), low + last))
        at = at[at > at[0] + reach // 2]
    got, equal, first, last = best
    return got, equal, -first, last


class _Items:
    """The test items by number: ids, word hashes, and for each length and seed of it the items that have it."""

    def __init__(self, ids, hashes, seeds):
        self.ids, self.hashes, self.seeds = ids, hashes, []
        for n, of in sorted(seeds.items()):
            seed = np.array(sorted(of), np.uint64)
            self.seeds.append((n, seed, [of[int(s)] for s in seed]))


def _aligned(items, least):
    def run(batches):
        for piece in T.pieces(batches):
            h, doc = _tokens(piece.column("text"))
            known = items.value
            begin = np.searchsorted(doc, np.arange(piece.num_rows + 1))
            ids = piece.column("doc_id").to_pylist()
            found: dict[tuple[int, int], list[int]] = {}
            for n, known_seeds, having in known.seeds:
                seeds, of = T.shingles(h, doc, n)
                place = np.flatnonzero(doc[: len(h) - n + 1] == doc[n - 1 :]) if len(h) >= n else np.zeros(0, np.int64)
                hit, _ = _hits(known_seeds, seeds)
                for p, d, s in zip(place[hit].tolist(), of[hit].tolist(), np.searchsorted(known_seeds, seeds[hit]).tolist(), strict=True):
                    for item in having[s]:
                        found.setdefault((d, item), []).append(p - int(begin[d]))
            rows = []
            for (d, item), at in found.items():
                score, equal, first, last = _best(known.hashes[item], h[begin[d] : begin[d + 1]], np.array(at), least)
                if score >= least:
                    rows.append((ids[d], known.ids[item], score, equal, first, last))
            yield pa.RecordBatch.from_pylist([dict(zip(FIELDS, r, strict=True)) for r in rows], pa.schema(SCHEMA))

    return run


FIELDS = ["doc_id", "item_id", "score", "matched", "first_word", "last_word"]
SCHEMA = [(f, pa.int64() if f.endswith("_id") else pa.float64() if f == "score" else pa.int32()) for f in FIELDS]


def _items(items: DataFrame) -> tuple[list[int], list[np.ndarray]]:
    """Test items with words; the benchmark table must fit on the driver, which its number of words is checked for."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > MOST_CHARS:
        raise ValueError(f"a benchmark of {size} characters is too large to broadcast; give it in parts")
    rows = items.dropDuplicates().orderBy("item_id", "text").toArrow()
    h, doc = _tokens(rows.column("text"))
    begin = np.searchsorted(doc, np.arange(rows.num_rows + 1))
    hashes = [h[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]
    keep = [i for i, x in enumerate(hashes) if len(x)]
    ids = rows.column("item_id").to_pylist()
    return [ids[i] for i in keep], [hashes[i] for i in keep]


def _seeds(docs: DataFrame, hashes: list[np.ndarray], n: int, chance: float) -> dict[int, dict[int, list[int]]]:
    """By length, the items of each seed: rare n-grams, all n-grams of an item where less than ``RARE`` of them are rare,
    and the whole of an item shorter than ``n``."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
    counted = docs.mapInArrow(_word_counts(spark.sparkContext.broadcast(vocabulary)), "word long, seen long, total long")
    counted = counted.groupBy("word").agg(F.sum("seen").alias("seen"), F.sum("total").alias("total")).toArrow()  # a row for each word of the items
    seen = dict(zip(counted.column("word").to_numpy().view(np.uint64).tolist(), counted.column("seen").to_pylist(), strict=True))
    total = max(1, pc.sum(counted.column("total")).as_py() or 0)
    seeds: dict[int, dict[int, list[int]]] = {}
    for item, h in enumerate(hashes):
        share = np.array([math.log(max(1, seen.get(int(x), 0)) / total) for x in h])
        size = min(n, len(h))
        grams, _ = T.shingles(h, np.zeros(len(h), np.int64), size)
        rare = sum(share[j : len(share) - size + 1 + j] for j in range(size)) <= math.log(chance)
        for g in set((grams[rare] if rare.mean() >= RARE else grams).tolist()):
            seeds.setdefault(size, {}).setdefault(g, []).append(item)
    return seeds


def find_leaks(docs: DataFrame, items: DataFrame, n: int = N, chance: float = CHANCE, least: float = SCORE) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``matched``, ``first_word``, ``last_word`` of every contaminated pair.

    ``docs(doc_id, text)``, ``items(item_id, text)``. A pair is contaminated if its best local alignment has at least
    ``least`` of the score of a whole copy; ``matched`` counts equal words, the span is in words of the document that have
    a letter or a digit. Null and empty texts, items without words and null item ids give no pair, items of fewer
    than ``n`` words only where they occur whole; a null doc_id gives pairs with a null doc_id. Repeated rows of ``docs`` repeat their pairs, repeated items do not. Ties
    between alignments go to the one with most equal words, then to the first. Other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids, hashes = _items(items)
    known = _Items(ids, hashes, _seeds(docs, hashes, n, chance) if ids else {})
    return docs.mapInArrow(_aligned(docs.sparkSession.sparkContext.broadcast(known), least), PAIRS)


def drop_leaks(docs: DataFrame, items: DataFrame, n: int = N, chance: float = CHANCE, least: float = SCORE) -> DataFrame:
    """``docs`` without the rows of contaminated documents; rows with a null doc_id all stay. Columns are those of ``docs``."""
    leaks = materialize(find_leaks(docs, items, n, chance, least).select(F.col("doc_id").alias("leaked")).where("leaked IS NOT NULL").distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"] == leaks["leaked"], "left_anti")
