"""Byte-pair encoding and decoding with a public vocabulary, in rounds of merges over many words at once.

A text is cut where the vocabulary's special tokens stand, then into words by runs of letters, numbers, other signs and
white space. The distinct words of a piece of the input are laid out as symbols in one flat array. In each round every
word that is not finished merges its pair of lowest rank, wherever that stands in it; ranks are found by binary search
over the sorted keys of all pairs, and only again for pairs that a merge has changed. A round takes a rank above the one
before, so a word of any length ends after as many rounds as the vocabulary has merges, in memory of its own size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.text import flat

PIECE = 1 << 21  # bytes of text that one round of work takes; a longer text is a piece of its own
NONE = np.iinfo(np.int32).max  # rank of a pair that does not merge
SPACE, LETTER, NUMBER, OTHER = range(4)
# Code points that are white space (property White_Space).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def kinds() -> np.ndarray:
    """Kind of each code point."""
    first = {"L": LETTER, "N": NUMBER}
    table = np.array([first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[WHITE] = SPACE
    return table


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next free one."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges and tokens as arrays; small (tens of thousands of entries) and broadcast."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int, int]], special: dict[bytes, int]):
        """``tokens``: bytes by id. ``merges``: (left, right, merged) by falling precedence. ``special``: id by bytes."""
        self.special = special
        self.size = max([*tokens, *special.values()], default=-1) + 1
        parts = [b""] * self.size
        for i, b in {**tokens, **{i: b for b, i in special.items()}}.items():
            parts[i] = b
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        of = {b: i for i, b in tokens.items() if len(b) == 1}
        if len(of) != 256:
            raise ValueError("the vocabulary lacks a token for some byte")
        self.of_byte = np.array([of[bytes([b])] for b in range(256)], np.int32)
        pairs = np.array(merges, np.int64).reshape(-1, 3)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int32)
        self.merged = pairs[:, 2].astype(np.int32)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From the JSON file of a byte-level BPE without prefix space, normalizer or post-processing; read by the driver."""
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, before = stored["model"], stored["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or stored.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = byte_letters()
        tokens = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = model["vocab"]
        special = {t["content"].encode(): t["id"] for t in stored.get("added_tokens", [])}
        return cls(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(len(key), NONE, np.int32)
        return np.where(self.keys[at] == key, self.rank_of[at], NONE)


def word_starts(codes: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """True where a word begins. ``codes``: code points of many texts, ``edge``: True where nothing may reach across.

    A word is a run of one kind with the one blank before it, or an apostrophe with s, t, m, d, re, ve or ll. White space
    before a word leaves its last sign to the word, or alone if that is no blank; white space at the end stays whole.
    """
    n = len(codes)
    kind = kinds()[codes]
    run = edge.copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    after = np.flatnonzero(run[1:] & ~edge[1:] & (kind[:-1] == SPACE)) + 1  # words right after white space
    start[after - 1] = True
    start[after] = codes[after - 1] != 0x20
    quote = np.flatnonzero((codes == 0x27) & start)
    quote = quote[quote + 1 < n]
    quote = quote[~edge[quote + 1] & (kind[quote + 1] == LETTER)]
    follow = codes[quote + 1]
    one = quote[np.isin(follow, [ord(c) for c in "stmd"])]
    start[one + 1] = False
    start[one[one + 2 < n] + 2] = True
    two = quote[quote + 2 < n]
    two = two[~edge[two + 2]]
    pair = codes[two + 1].astype(np.int64) << 32 | codes[two + 2]
    two = two[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    start[two + 1] = False
    start[two[two + 3 < n] + 3] = True
    return start


def merge(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each word and where they begin; words are not empty. ``offsets``: len + 1 byte positions."""
    symbol = vocabulary.of_byte[data]
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    rank = _ranks_within(vocabulary, symbol, word, np.arange(len(symbol)))
    done_symbols, done_words = [], []
    while len(symbol):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[first, len(word)])
        least = np.repeat(np.minimum.reduceat(rank, first), size)
        finished = least == NONE
        done_symbols.append(symbol[finished])
        done_words.append(word[finished])
        active = ~finished
        symbol, word, rank, least = symbol[active], word[active], rank[active], least[active]
        hit = np.flatnonzero(rank == least)
        # Hits in a row overlap (one symbol repeated): every second one merges, from the left.
        begins = np.r_[True, np.diff(hit) != 1] if len(hit) else np.zeros(0, bool)
        in_row = np.arange(len(hit)) - np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
        hit = hit[in_row % 2 == 0]
        symbol[hit] = vocabulary.merged[rank[hit]]
        kept = np.ones(len(symbol), bool)
        kept[hit + 1] = False
        place = np.cumsum(kept) - 1
        symbol, word, rank = symbol[kept], word[kept], rank[kept]
        at = place[hit]
        touched = np.zeros(len(symbol), bool)
        touched[at] = touched[at[at > 0] - 1] = True
        changed = np.flatnonzero(touched)
        rank[changed] = _ranks_within(vocabulary, symbol, word, changed)
    symbols = np.concatenate(done_symbols) if done_symbols else symbol
    words = np.concatenate(done_words) if done_words else word
    order = np.argsort(words, kind="stable")
    return symbols[order], np.searchsorted(words[order], np.arange(len(offsets)))


def _ranks_within(vocabulary: Vocabulary, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the pairs that begin ``at`` these places; NONE for the last symbol of a word."""
    found = np.full(len(at), NONE, np.int32)
    inner = np.flatnonzero(at + 1 < len(symbol))
    inner = inner[word[at[inner]] == word[at[inner] + 1]]
    found[inner] = vocabulary.ranks(symbol[at[inner]], symbol[at[inner] + 1])
    return found


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of many runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


def _special_places(vocabulary: Vocabulary, data: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """Begin, end and id of the special tokens' bytes, leftmost and longest first, within single texts."""
    if not any(s in data for s in vocabulary.special):
        return []
    pattern = re.compile(b"|".join(re.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)))
    places = []
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        places += [(m.start(), m.end(), vocabulary.special[m[0]]) for m in pattern.finditer(data, low, high)]
    return places


def encode_texts(vocabulary: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in a row, and len + 1 offsets; null counts as empty."""
    data, offsets = flat(texts)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    raw = data.tobytes()
    codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.flatnonzero((data & 0xC0) != 0x80)  # byte at which each code point begins
    places = _special_places(vocabulary, raw, offsets)
    cuts = np.array([p for low, high, _ in places for p in (low, high)], np.int64)
    edge = np.zeros(len(codes) + 1, bool)
    edge[np.searchsorted(begins, np.concatenate([offsets, cuts]))] = True
    edge = edge[:-1]
    edge[0] = True
    start = word_starts(codes, edge)
    for low, high, _ in places:
        a, b = np.searchsorted(begins, [low, high])
        start[a + 1 : b] = False
    bounds = np.r_[begins[start], len(data)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
    coded = words.dictionary_encode()
    distinct, entry = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    limits = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    ids, first = merge(vocabulary, np.frombuffer(distinct.buffers()[2], np.uint8)[limits[0] : limits[-1]], limits - limits[0])
    if places:  # an entry of their own, behind those of the words
        ids = np.concatenate([ids, np.array([i for _, _, i in places], np.int32)])
        first = np.concatenate([first, first[-1] + 1 + np.arange(len(places))])
        entry[np.searchsorted(bounds, [low for low, _, _ in places])] = len(distinct) + np.arange(len(places))
    sizes = np.diff(first)[entry]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return ids[gather(first[entry], sizes)], ends[np.searchsorted(bounds, offsets)]


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts of rows of token ids; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
    known = ids < vocabulary.size
    inside = ids[known].astype(np.int64)
    sizes = vocabulary.lengths[inside]
    data = vocabulary.bytes[gather(vocabulary.starts[inside], sizes)].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(known)])[offsets]]
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _parts(lengths: np.ndarray, limit: int):
    """Ranges of rows of about ``limit`` bytes."""
    ends, row, last = np.cumsum(lengths), 0, 0
    while row < len(lengths):
        to = max(row + 1, int(np.searchsorted(ends, last + limit, "right")))
        yield row, to
        row, last = to, int(ends[to - 1])


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(values.astype("<u4").tobytes())]).cast(pa.binary())


def _lengths(column: pa.Array) -> np.ndarray:
    return np.maximum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), 1)


class Codec:
    """Encoding and decoding of columns with one vocabulary, sent to the executors once."""

    def __init__(self, spark, path: str):
        """``path``: the vocabulary's file, which only the driver reads."""
        self.shared = spark.sparkContext.broadcast(Vocabulary.read(path))

    def encode(self, text: Column) -> Column:
        """Token ids of a text column as little-endian unsigned 32-bit integers in a row; null and empty texts: none."""
        shared = self.shared

        @F.arrow_udf("binary")
        def encoded(texts: pa.Array) -> pa.Array:
            found = [_binary(*encode_texts(shared.value, texts.slice(a, b - a))) for a, b in _parts(_lengths(texts), PIECE)]
            return pa.concat_arrays(found) if found else pa.array([], pa.binary())

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """Texts of a column as ``encode`` gives it, special tokens included; null: empty. A last part of under 4 bytes is left out."""
        shared = self.shared

        @F.arrow_udf("string")
        def decoded(column: pa.Array) -> pa.Array:
            texts: list[str] = []
            for a, b in _parts(_lengths(column), PIECE):
                rows = [(r or b"")[: len(r or b"") // 4 * 4] for r in column.slice(a, b - a).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int64)
                texts += decode_ids(shared.value, np.frombuffer(b"".join(rows), "<u4"), offsets)
            return pa.array(texts, pa.string())

        return decoded(ids)


def numbers(ids: Column) -> Column:
    """The ids of ``Codec.encode`` as an array of long."""

    @F.arrow_udf("array<bigint>")
    def unpacked(column: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(r, "<u4").astype(np.int64) if r is not None else None for r in column.to_pylist()], pa.list_(pa.int64()))

    return unpacked(ids)


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """``docs(text)`` with ``n_tokens`` (long), ``ids`` (binary) and ``decoded`` (the text read back from the ids).

    These replace columns of the same names; all other columns and all rows, repeated ones too, are passed on. Null and
    empty texts give no token and an empty text. No shuffle; an empty table gives no rows.
    """
    codec = Codec(docs.sparkSession, path)
    names = [c for c in docs.columns if c not in ("n_tokens", "ids", "decoded")]
    rows = docs.select(F.struct("*").alias("row")).select("row", codec.encode(F.col("row.text").cast("string")).alias("_ids"))
    rows = rows.select("row", "_ids", codec.decode(F.col("_ids")).alias("_text"))
    size = (F.octet_length("_ids") / 4).cast("long")
    return rows.select(*(F.col("row")[c].alias(c) for c in names), size.alias("n_tokens"), F.col("_ids").alias("ids"), F.col("_text").alias("decoded"))
