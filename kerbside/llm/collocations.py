"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

The stripes of one-word prefixes hold the counts of all two-word phrases; their totals are the counts of the words, as the
end of a piece counts as a following word of its own. The stripes of longer prefixes hold the longer phrases, and the
greatest count in a stripe is what subsumes its prefix from the right. Tasks count pieces of the input into stripes, and
stripes of one key are merged elementwise after the shuffle.

A phrase that is frequent has frequent parts only. So for prefixes of two words and more a task looks only at places where
both parts may be frequent, by a bit map of hashes of the frequent phrases one word shorter. Its size has a fixed bound;
where there are more phrases it lets more through, and nothing frequent is ever lost. A prefix of more than STRIPE words
is cut into parts by a hash of the following word; only prefixes that are one word in SHARE are, so there is a bounded
number of them, known from a count of those of each piece of the input.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.store import materialize
from kerbside.llm.text import LOWER, chain, flat, mix, pieces, prefix_hash, span_hash

PIECE = 1 << 21  # bytes of text counted at a time, in about fifty times the memory
LEAST = 10  # occurrences of a phrase
STRIPE = 1 << 20  # words that one stripe counts, about, where its prefix is frequent
SHARE = 200_000
BITS = 28  # of the bit map's size at most: 32 MB
SALTS = 16  # parts of a language in the first step of the ranking
END = ""  # follows the last word of a piece; no word is empty
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09]] = True


class Words:
    """The words of many texts, with numbers for equal ones; ``piece`` differs between words that no phrase may join."""

    def __init__(self, texts: pa.Array, langs: list[str]):
        data, offsets = flat(texts)
        data = LOWER[data]
        inside = ~(BREAKS[data] | BLANKS[data])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        cut = edge[:-1].copy() if len(data) else np.zeros(0, bool)
        cut |= BREAKS[data]
        self.piece = np.cumsum(cut)[start] if len(start) else np.zeros(0, np.int64)
        text = np.searchsorted(offsets, start, "right") - 1
        self.langs = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(self.langs)}
        self.lang = np.array([number[lang] for lang in langs], np.int64)[text] if len(start) else np.zeros(0, np.int64)
        spans = np.empty(2 * len(start) + 1, np.int64)  # words and what is between them, in turn
        spans[0:-1:2], spans[1::2] = start, end
        spans[-1] = len(data)
        runs = pa.LargeStringArray.from_buffers(2 * len(start), pa.py_buffer(spans), pa.py_buffer(data.tobytes())) if len(start) else pa.array([], pa.large_string())
        coded = runs.take(pa.array(np.arange(0, 2 * len(start), 2))).dictionary_encode()
        names = coded.dictionary.cast(pa.large_string())
        self.names = pa.concat_arrays([names, pa.array([END], pa.large_string())])
        of_names, limits = flat(names)
        self.name_hash = np.append(span_hash(prefix_hash(of_names), limits[:-1], limits[1:]), np.uint64(0))  # of distinct words only
        self.id = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.end = len(self.names) - 1  # the number of END

    @property
    def hash(self) -> np.ndarray:
        return self.name_hash[self.id]

    def joined(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words that begin at these words."""
        parts = [self.names.take(pa.array(self.id[at + j])) for j in range(size)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]


def _words(batch: pa.RecordBatch) -> Words:
    return Words(batch.column("text"), batch.column("lang").to_pylist())


def phrase_hash(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    found = mix(hashes[at])
    for j in range(1, size):
        found = chain(found, hashes[at + j])
    return found


def _heavy_words(batches):
    """Words that are one in SHARE of a piece of the input or more, with their counts, and the number of all its words."""
    for batch in pieces(batches, limit=PIECE):
        words = _words(batch)
        if not len(words.id):
            continue
        key, at, count = np.unique(words.lang * len(words.names) + words.id, return_index=True, return_counts=True)
        few = count * SHARE >= len(words.id)  # a word that is one in SHARE of all is so in some piece
        at = at[few]
        langs, names = [words.langs[i] for i in words.lang[at]], words.joined(at, 1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([*langs, None], pa.string()), pa.array([*names, None], pa.string()), pa.array([*count[few], len(words.id)], pa.int64())], ["lang", "prefix", "n"])


class BitMap:
    """Places of hashes in a bit map; what was put in is always found."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def holds(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for place in places(h, self.bits):
            found &= (self.data[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return found


def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    again = mix(h ^ np.uint64(0x5851F42D4C957F2D))
    return [(x >> np.uint64(64 - bits)).astype(np.int64) for x in (h, again)]


def bit_map(phrases: DataFrame, size: int) -> BitMap:
    """The bit map of ``phrases(phrase)`` of ``size`` words each; 16 bits for each and 32 MB at most."""
    bits = int(min(BITS, max(13, (16 * phrases.count()).bit_length())))

    def set_bits(batches):
        for batch in batches:
            if batch.num_rows:
                words = Words(batch.column("phrase"), [""] * batch.num_rows)
                h = phrase_hash(words.hash, np.arange(0, len(words.id), size), size)
                for place in places(h, bits):
                    yield pa.RecordBatch.from_arrays([pa.array(place >> 13), pa.array((place & 8191).astype(np.int16))], ["page", "bit"])

    def pages(batches):
        # One row per page of 1 KB: a page's bits arrive as a set of at most 8192.
        for batch in batches:
            rows = []
            for bits_of in batch.column("bits").to_pylist():
                page = np.zeros(8192, np.uint8)
                page[bits_of] = 1
                rows.append(np.packbits(page, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(rows, pa.binary())], ["page", "data"])

    found = phrases.select("phrase").mapInArrow(set_bits, "page long, bit short").groupBy("page").agg(F.collect_set("bit").alias("bits")).mapInArrow(pages, "page long, data binary")
    data = np.zeros(1 << bits >> 3, np.uint8)
    for row in found.collect():  # 32 MB at most
        data[row.page << 10 : (row.page + 1) << 10] = np.frombuffer(row.data, np.uint8)
    return BitMap(bits, data)


def _counted(batches, size: int, heavy: dict[tuple[str, str], int], frequent: BitMap | None):
    """Stripes of prefixes of ``size`` words in a piece of the input: following words in a row, joined, and their counts."""
    for batch in pieces(batches, limit=PIECE):
        words = _words(batch)
        n = len(words.id)
        if size == 1:
            at = np.arange(n)
            follow = np.full(n, words.end)
            follow[:-1] = np.where(words.piece[1:] == words.piece[:-1], words.id[1:], words.end)
        else:
            at = np.arange(max(0, n - size))
            at = at[words.piece[at] == words.piece[at + size]]
            tried = np.zeros(n + 1, bool)
            tried[at] = tried[at + 1] = True
            tried = np.flatnonzero(tried)
            whole = np.zeros(n + 1, bool)  # places where a phrase of `size` words may be frequent
            whole[tried] = frequent.holds(phrase_hash(words.hash, tried, size))
            at = at[whole[at] & whole[at + 1]]
            follow = words.id[at + size]
        if not len(at):
            continue
        prefix = words.lang[at] * len(words.names) + words.id[at]
        for j in range(1, size):
            _, prefix = np.unique(prefix, return_inverse=True)
            prefix = prefix * len(words.names) + words.id[at + j]
        _, example, prefix = np.unique(prefix, return_index=True, return_inverse=True)
        names = words.joined(at[example], size)
        langs = [words.langs[i] for i in words.lang[at[example]]]
        parts = np.array([heavy.get(name, 0) for name in zip(langs, names.to_pylist(), strict=True)] if heavy else [0] * len(langs), np.int64)
        part = np.where(parts[prefix] > 0, 1 + (words.name_hash[follow] % np.maximum(parts[prefix], 1).astype(np.uint64)).astype(np.int64), 0)
        most = int(parts.max()) + 1
        key, count = np.unique((prefix * most + part) * len(words.names) + follow, return_counts=True)
        stripe, follow = key // len(words.names), key % len(words.names)
        first = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]])
        bounds = np.r_[first, len(stripe)]
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), words.names.take(pa.array(follow)))
        of = stripe[first] // most
        counts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(count.astype("<u4").tobytes())])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()).take(pa.array(of)),
                names.take(pa.array(of)).cast(pa.string()),
                pa.array((stripe[first] % most).astype(np.int32)),
                pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                counts.cast(pa.binary()),
            ],
            ["lang", "prefix", "part", "follow", "counts"],
        )


class _Stripe:
    """A counter of following words, added up elementwise."""

    def __init__(self, follow: str, counts: bytes):
        self.lone, self.total = (follow, counts), None

    def add(self, follow: str, counts: bytes) -> None:
        if self.total is None:
            self.total, self.lone = dict(zip(*self._read(*self.lone), strict=True)), None
        get = self.total.get
        for name, n in zip(*self._read(follow, counts), strict=True):
            self.total[name] = get(name, 0) + n

    @staticmethod
    def _read(follow, counts):
        return follow.split(" "), np.frombuffer(counts, "<u4").tolist()

    def row(self, least: int) -> tuple[int, list[str], list[int]]:
        names, counts = self._read(*self.lone) if self.total is None else (self.total.keys(), self.total.values())
        few = [x for x in zip(names, counts, strict=True) if x[1] >= least]
        return sum(counts), [x[0] for x in few], [x[1] for x in few]


def _flat_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All counts in a row, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    counts = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view("<u4").astype(np.int64)
    return counts, np.diff(offsets) // 4


def _whole_stripes(batch: pa.RecordBatch, least: int, rare: dict[str, int]) -> pa.RecordBatch:
    """Rows of ``_merged`` of a batch that has all rows of its keys."""
    n = batch.num_rows
    change = np.zeros(n, bool)
    change[0] = True
    for c in ("lang", "prefix", "part"):
        column = batch.column(c)
        change[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    counts, sizes = _flat_counts(batch.column("counts"))
    first = np.flatnonzero(change)
    total = np.add.reduceat(counts, (np.cumsum(sizes) - sizes)[first])
    kept = (total >= least) | (batch.column("part").to_numpy()[first] > 0)
    for lang, x in zip(batch.column("lang").take(pa.array(first[~kept])).to_pylist(), total[~kept].tolist(), strict=True):
        rare[lang] = rare.get(lang, 0) + x
    key = np.cumsum(change) - 1
    rows = kept[key]
    key, counts = np.repeat((np.cumsum(kept) - 1)[key][rows], sizes[rows]), counts[np.repeat(rows, sizes)]
    names = pc.split_pattern(batch.column("follow").filter(pa.array(rows)), " ").flatten().dictionary_encode()
    name = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pair = key * max(1, len(names.dictionary)) + name
    order = np.argsort(pair, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(pair[order]) != 0]) if len(order) else order
    added = np.add.reduceat(counts[order], start) if len(start) else counts
    few = np.flatnonzero(added >= least)
    at = order[start[few]]
    offsets = pa.array(np.r_[0, np.cumsum(np.bincount(key[at], minlength=int(kept.sum())))].astype(np.int32))
    of = pa.array(first[kept])
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (names.dictionary.take(pa.array(name[at])), pa.array(added[few]))]
    return pa.RecordBatch.from_arrays([batch.column("lang").take(of), batch.column("prefix").take(of), pa.array(total[kept]), *lists], MERGED)


MERGED = ["lang", "prefix", "total", "follow", "counts"]


def _merged(batches, least: int):
    """Of stripes sorted by key, those of one key added up: total, and the following words of ``least`` or more.

    Words (prefixes) that are rarer themselves are added up in a row without a prefix. The last key of a batch may go on
    in the next one, so it is added to row by row; all others of a batch are added up at once.
    """
    key, stripe, rare = None, None, {}

    def closed():
        total, *frequent = stripe.row(least)
        if key[2] or total >= least:
            return [(*key[:2], total, *frequent)]
        rare[key[0]] = rare.get(key[0], 0) + total
        return []

    def batch_of(rows):
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], MERGED)

    def same(batch, name):
        found = [pc.equal(batch.column(c), pa.scalar(x, batch.column(c).type)).to_numpy(zero_copy_only=False) for c, x in zip(("lang", "prefix", "part"), name, strict=True)]
        return np.logical_and.reduce(found)

    for batch in batches:
        low = 0
        if key is not None:
            low = int(same(batch, key).sum())  # at the batch's start, as the rows are sorted
            for follow, counts in zip(*(batch.column(c).slice(0, low).to_pylist() for c in ("follow", "counts")), strict=True):
                stripe.add(follow, counts)
        if low == batch.num_rows:
            continue
        if key is not None:
            yield batch_of(closed())
        key = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("lang", "prefix", "part")]
        high = batch.num_rows - int(same(batch, key).sum())
        if high > low:
            yield _whole_stripes(batch.slice(low, high - low), least, rare)
        (follow, counts), *more = zip(*(batch.column(c).slice(high).to_pylist() for c in ("follow", "counts")), strict=True)
        stripe = _Stripe(follow, counts)
        for follow, counts in more:
            stripe.add(follow, counts)
    rows = closed() if key is not None else []
    yield batch_of(rows + [(lang, None, total, [], []) for lang, total in rare.items()])


def _stripes(docs: DataFrame, size: int, heavy: dict, frequent: DataFrame | None, least: int) -> DataFrame:
    """``lang, prefix, total, follow, counts`` of all prefixes of ``size`` words; ``frequent``: phrases of as many words."""
    context = docs.sparkSession.sparkContext
    split, filtered = context.broadcast(heavy), context.broadcast(None if frequent is None else bit_map(frequent, size))
    counted = docs.mapInArrow(lambda batches: _counted(batches, size, split.value, filtered.value), "lang string, prefix string, part int, follow string, counts binary")
    key = ["lang", "prefix", "part"]
    merged = counted.repartition(*key).sortWithinPartitions(*key).mapInArrow(lambda batches: _merged(batches, least), "lang string, prefix string, total long, follow array<string>, counts array<long>")
    return materialize(merged, f"stripes{size}")


def _split(counts: DataFrame, words: int) -> dict[tuple[str, str], int]:
    """Number of parts of the prefixes in ``counts(lang, prefix, n)`` that have more than a stripe's words."""
    rows = counts.where((F.col("n") > STRIPE) & (F.col("n") * SHARE >= words)).collect()  # at most SHARE times the words of a prefix
    return {(r.lang, r.prefix): -(-r.n // STRIPE) for r in rows}


def mine(docs: DataFrame, longest: int = 3, least: int = LEAST, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language of ``docs(text, lang)``.

    Texts with A-Z in lower case are cut at ``[.,;:!?]`` and signs 0x0A to 0x0D into pieces, these at blanks and tabs into words. A
    phrase has 2 to ``longest`` words of one piece and occurs ``a >= least`` times, overlaps counted. Cut after its first
    words it has parts with l and r occurrences and the score floor(1000000 a a / (l r)); the lowest counts, of the earliest
    cut. A phrase is left out if a longer one (left out or not) that holds it has half of its occurrences or more. Order:
    score, a (falling), phrase (bytes). ``n``: all words of the language. Exact for up to 10^16 occurrences.

    Null texts count as empty, a null language is ``und``; rows count as often as they occur; other columns are not looked
    at. No phrase: no rows.
    """
    docs = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    often = materialize(docs.mapInArrow(_heavy_words, "lang string, prefix string, n long").groupBy("lang", "prefix").agg(F.sum("n").alias("n")), "often")
    words = (often.where("prefix IS NULL").agg(F.sum("n")).first()[0]) or 0
    stripes = _stripes(docs, 1, _split(often.where("prefix IS NOT NULL"), words), None, least)
    n = stripes.groupBy("lang").agg(F.sum("total").alias("n"))
    known = {1: stripes.where("prefix IS NOT NULL").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("total").alias("f")).where(F.col("f") >= least)}
    for size in range(2, longest + 1):
        pairs = stripes.select("lang", "prefix", F.explode(F.arrays_zip("follow", "counts")).alias("next")).where(F.col("next.follow") != END)
        known[size] = materialize(pairs.select("lang", F.concat_ws(" ", "prefix", "next.follow").alias("phrase"), F.col("next.counts").alias("f")), f"phrases{size}")
        if size < longest:
            stripes = _stripes(docs, size, _split(known[size].select("lang", F.col("phrase").alias("prefix"), F.col("f").alias("n")), words), known[size], least)
    scored = [_scored(size, known, longest) for size in range(2, longest + 1)]
    if not scored:
        raise ValueError("phrases have two words at least")
    found = reduce(DataFrame.union, scored)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    for by in (["lang", salt], ["lang"]):  # first the top of each part, so that no task ranks a whole language
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return found.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(size: int, known: dict[int, DataFrame], longest: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases of ``size`` words that no longer one subsumes."""
    rows = known[size].withColumnRenamed("f", "a")
    if size < longest:
        longer = known[size + 1].withColumn("_words", F.split("phrase", " "))
        held = [longer.select("lang", F.array_join(F.slice("_words", at, size), " ").alias("phrase"), "f") for at in (1, 2)]
        most = held[0].union(held[1]).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        rows = rows.join(most, ["lang", "phrase"], "left").where("most IS NULL OR 100 * most < 50 * a").drop("most")
    rows = rows.withColumn("_words", F.split("phrase", " "))
    cuts = []
    for k in range(1, size):
        for name, at, length in ((f"l{k}", 1, k), (f"r{k}", k + 1, size - k)):
            part = known[length].select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
            rows = rows.join(part, (F.col("lang") == F.col("_lang")) & (F.array_join(F.slice("_words", at, length), " ") == F.col("_part"))).drop("_lang", "_part")
        wide = {x: F.col(x).cast("decimal(19,0)") for x in ("a", f"l{k}", f"r{k}")}
        rows = rows.withColumn(f"_up{k}", (F.lit(1_000_000).cast("decimal(7,0)") * wide["a"]).cast("decimal(38,0)") * wide["a"]).withColumn(f"_down{k}", (wide[f"l{k}"] * wide[f"r{k}"]).cast("decimal(38,0)"))
        cuts.append(F.struct(F.expr(f"_up{k} div _down{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*cuts)).alias("best")
    return rows.select("lang", "phrase", "a", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations_sql(table: str = "documents", least: int = LEAST, top: int = 2000) -> str:
    """The same for phrases of two and three words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    score = "(1000000::HUGEINT * a * a) // (l::HUGEINT * r)"
    return rf"""
        WITH cut AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM {table}),
        pieces AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM cut),
        w AS (SELECT lang, id, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM pieces),
        g AS (SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM w WINDOW p AS (PARTITION BY id ORDER BY i)),
        f1 AS (SELECT lang, x, count(*) AS f FROM g GROUP BY ALL),
        f2 AS (SELECT lang, x, y, count(*) AS f FROM g WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}),
        f3 AS (SELECT lang, x, y, z, count(*) AS f FROM g WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}),
        held AS (SELECT lang, x, y, max(f) AS most FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
        cuts AS (
            SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, 1 AS k, p.f AS l, q.f AS r
            FROM f2 c JOIN f1 p ON p.lang = c.lang AND p.x = c.x JOIN f1 q ON q.lang = c.lang AND q.x = c.y
            LEFT JOIN held h ON h.lang = c.lang AND h.x = c.x AND h.y = c.y WHERE h.most IS NULL OR 100 * h.most < 50 * c.f
            UNION ALL
            SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 1, p.f, q.f
            FROM f3 c JOIN f1 p ON p.lang = c.lang AND p.x = c.x JOIN f2 q ON q.lang = c.lang AND q.x = c.y AND q.y = c.z
            UNION ALL
            SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 2, p.f, q.f
            FROM f3 c JOIN f2 p ON p.lang = c.lang AND p.x = c.x AND p.y = c.y JOIN f1 q ON q.lang = c.lang AND q.x = c.z),
        scored AS (SELECT *, CAST({score} AS BIGINT) AS score FROM cuts),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank FROM best)
        SELECT ranked.lang, rank, phrase, a, l, r, n.n, score
        FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang) n ON n.lang = ranked.lang WHERE rank <= {top}"""
