"""Words, shingles and their 64-bit fingerprints for whole columns of texts, on arrays of bytes.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D; all of these are ASCII, so words of UTF-8 bytes are the words
``[^\\x20\\x09-\\x0D]+`` of the text. All functions take the joined bytes of many texts and the offsets that part them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
PIECE = 1 << 20  # bytes of text worked on at a time

_powers: list[np.ndarray] = []


def u64(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit of the result depends on every bit of ``h``."""
    h = h ^ (h >> u64(30))
    h *= u64(0xBF58476D1CE4E5B9)
    h ^= h >> u64(27)
    h *= u64(0x94D049BB133111EB)
    h ^= h >> u64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n at least."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, PIECE + 1)
        _powers[:] = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers[0], _powers[1]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, joined, and len + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about ``limit`` bytes of text; a longer text is a part of its own."""
    for batch in batches:
        ends = np.cumsum(np.maximum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), 1))
        row, last = 0, 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(ends, last + limit, "right")))
            yield batch.slice(row, to - row)
            row, last = to, int(ends[to - 1])


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of the text of each word."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """len + 1 values; the difference of two, scaled, is the hash of the bytes between."""
    up, _ = powers(len(buf))
    h = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + u64(1)) * up[: len(buf)], out=h[1:])
    return h


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + mix((end - start).astype(np.uint64)))


def window_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of every span of ``size`` bytes, by position."""
    n = len(prefix) - size
    _, down = powers(len(prefix))
    return mix((prefix[size:] - prefix[:n]) * down[:n] + mix(np.array([size], np.uint64)))


def chain(h: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a sequence with one more element."""
    return mix(h * u64(0xD6E8FEB86659FD93) + following)


def shingles(word: np.ndarray, doc: np.ndarray, k: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each run of ``k`` words; ``whole``: texts with 1 to k - 1 words give all of them as one run."""
    n = len(word)
    if n >= k:
        at = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
        h = word[at]
        for j in range(1, k):
            h = chain(h, word[at + j])
        of = doc[at]
    else:
        h, of = word[:0], doc[:0]
    if whole and n:
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        sizes = np.diff(np.r_[starts, n])
        few = starts[sizes < k]
        size = sizes[sizes < k]
        short = mix(word[few] + u64(0x51ED270B))
        for j in range(1, k - 1):
            more = size > j
            short[more] = chain(short[more], word[few[more] + j])
        h, of = np.concatenate([h, mix(short + size.astype(np.uint64))]), np.concatenate([of, doc[few]])
        order = np.argsort(of, kind="stable")
        h, of = h[order], of[order]
    return h, of


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each word, in order."""
    buf, offsets = flat(texts)
    if lower:
        buf = LOWER[buf]
    start, end, doc = words(buf, offsets)
    return span_hash(prefix_hash(buf), start, end), doc


def distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes once, ascending."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]
