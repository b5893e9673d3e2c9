"""Removal of long byte strings that an earlier document has, by rounds of ranking as in prefix doubling.

Prefix doubling ranks the positions of a text by growing prefixes of their suffixes, and leaves out positions whose rank
has become unique. Ranking every position of the corpus would shuffle many times its size, so three things differ:

* ranks are 64-bit hashes of the prefixes, which equal prefixes share, and Spark deals them out by range of hash for the
  comparison (a rank's order does not matter here, only who shares it);
* the first round ranks, by ``KEY`` bytes, only positions that are a minimum of their neighbourhood (minimizers): every
  ``LENGTH``-byte string has one, at a place that depends on its bytes alone, so equal strings meet there;
* the offset grows at once past the threshold: a rank is paired with that of its whole neighbourhood (all strings that
  have this minimizer). A pair met in a smaller doc_id settles all its strings. Where one rank has several
  neighbourhoods, and only there, the last round ranks the ``LENGTH``-byte strings one by one.

Texts travel in compressed chunks and ranks in packed arrays, one row for a chunk and a bucket of hashes. A chunk names a
rank once, however often it has it, so a string of a third of all documents is no hot key. What a rank is found to be
comes back to the chunk as a bit or two.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm import text as T
from kerbside.llm.store import materialize

LENGTH = 50  # bytes of a string that is removed
KEY = 20  # bytes of a first rank
BUCKET = 4 << 20  # bytes of text for each bucket of hashes
NAMELESS = (1 << 63) - 1  # a null doc_id comes after all others
LOW48 = (1 << 48) - 1
PACKED = "bucket long, chunk long, kind int, data binary"


# --- positions -----------------------------------------------------------------------------------------------------


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, key: int):
    """Minimizers: position, first and last start of the strings they stand for, key rank and neighbourhood rank, and the
    prefix hashes of ``buf``."""
    prefix = T.prefix_hash(buf)
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), prefix
    at = np.arange(len(buf) - key + 1)
    rank = T.window_hash(prefix, key)
    least = (rank >> T.u64(28) << T.u64(28)) | at.astype(np.uint64)  # of equal ranks the leftmost
    wide, size = length - key + 1, 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if wide > size:
        least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
    starts = np.arange(len(buf) - length + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))  # of the text that each byte is in
    starts = starts[ends[: len(starts)] - starts >= length]
    position = (least[starts] & T.u64((1 << 28) - 1)).astype(np.int64)
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = position[1:] != position[:-1]
    edge = np.flatnonzero(new)
    low, high = starts[edge[:-1]], starts[edge[1:] - 1]
    position = position[edge[:-1]]
    around = T.mix(T.span_hash(prefix, low, high + length) + (position - low).astype(np.uint64))
    return position, low, high, rank[position], around, prefix


class Chunk:
    """Some texts with their anchors, and the distinct pairs of ranks among these, sorted by bucket."""

    def __init__(self, buf, offsets, ids, buckets, length, key):
        self.buf, self.offsets, self.ids, self.length = buf, offsets, ids, length
        self.position, self.low, self.high, rank, around, self.prefix = anchors(buf, offsets, length, key)
        self.doc = ids[np.searchsorted(offsets, self.position, "right") - 1]
        bucket = ((rank >> T.u64(32)) % T.u64(buckets)).astype(np.int64)
        rank, around = rank & T.u64(LOW48), around & T.u64(LOW48)
        order = np.lexsort((self.doc, around, rank, bucket))
        b, r, a = bucket[order], rank[order], around[order]
        new = np.ones(len(order), bool)
        new[1:] = (b[1:] != b[:-1]) | (r[1:] != r[:-1]) | (a[1:] != a[:-1])
        self.entry = np.zeros(len(order), np.int64)  # of each anchor
        self.entry[order] = np.cumsum(new) - 1
        self.first = order[new]  # an anchor of each entry, of its smallest document
        self.rank, self.around, self.least = r[new], a[new], self.doc[self.first]
        self.buckets, self.begin = np.unique(b[new], return_index=True)
        self.end = np.append(self.begin[1:], new.sum())


def _name(prefix: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> int:
    """The same for the same texts and ids; chunks of equal content may share it, as they share all answers."""
    h = T.mix(T.span_hash(prefix, offsets[:-1], offsets[1:]) + T.mix(ids.view(np.uint64)))
    total = T.mix(np.array([len(h)], np.uint64))
    for x in (h, T.mix(h ^ np.arange(len(h), dtype=np.uint64))):
        total = T.mix(total + np.add.reduce(x))
    return int(total.view(np.int64)[0])


def _pieces(batches):
    for piece in T.pieces(batches):
        yield piece, *T.flat(piece.column("text")), piece.column("doc_id").fill_null(NAMELESS).to_numpy(zero_copy_only=False).astype(np.int64)


# --- packing -------------------------------------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays, each as its type, number of bytes and bytes."""
    out = []
    for a in arrays:
        out += [struct.pack("<cQ", a.dtype.char.encode(), a.nbytes), a.tobytes()]
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, size = struct.unpack_from("<cQ", data, at)
        out.append(np.frombuffer(data, kind.decode(), size // np.dtype(kind.decode()).itemsize, at + 9))
        at += 9 + size
    return out


def _pack48(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def _unpack48(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = x.reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def _pack_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    base = ids.min(keepdims=True)
    apart = (ids - base).view(np.uint64)
    return base, apart.astype(next(t for t in (np.uint16, np.uint32, np.uint64) if not len(apart) or int(apart.max()) <= np.iinfo(t).max))


def _rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["bucket", "chunk", "kind", "data"]
    )


def _grouped(batches, column):
    """Rows in runs of equal ``column``, one row at a time in memory beside the run."""
    run, value = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if run and row[column] != value:
                yield value, run
                run = []
            value = row[column]
            run.append(row)
    if run:
        yield value, run


# --- rounds --------------------------------------------------------------------------------------------------------


def _first_ranks(buckets, length, key):
    def run(batches):
        for _, buf, offsets, ids in _pieces(batches):
            c = Chunk(buf, offsets, ids, buckets, length, key)
            name = _name(c.prefix, offsets, ids)
            rows = [
                (int(b), name, 0, _pack(_pack48(c.rank[i:j]), _pack48(c.around[i:j]), *_pack_ids(c.least[i:j])))
                for b, i, j in zip(c.buckets, c.begin, c.end, strict=True)
            ]
            if rows:
                yield _rows(rows)

    return run


def _shared(values: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that agree in all ``values``: their smallest id; and the order that sorts the rows by these and id."""
    order = np.lexsort((ids, *reversed(values)))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([v[order][1:] != v[order][:-1] for v in values])
    least = np.empty_like(ids)
    least[order] = ids[order][new][np.cumsum(new) - 1]
    return least, order


def _settle(batches):
    """Of each pair of ranks: is it in a smaller document; if not, does its rank have other neighbourhoods."""
    for bucket, rows in _grouped(batches, "bucket"):
        parts = [_unpack(r["data"]) for r in rows]
        rank = np.concatenate([_unpack48(p[0]) for p in parts])
        around = np.concatenate([_unpack48(p[1]) for p in parts])
        ids = np.concatenate([p[2] + p[3].astype(np.int64) for p in parts])
        least, order = _shared([rank, around], ids)
        r, a = rank[order], around[order]
        group = np.cumsum(np.r_[False, r[1:] != r[:-1]])
        several = np.zeros(group[-1] + 1, bool)
        several[group[1:][(r[1:] == r[:-1]) & (a[1:] != a[:-1])]] = True
        unsettled = np.zeros(len(rank), bool)
        unsettled[order] = several[group]
        copied = ids > least
        unsettled &= ~copied
        ends = np.cumsum([len(p[3]) for p in parts])
        for row, low, high in zip(rows, np.r_[0, ends[:-1]], ends, strict=True):
            yield _rows([(bucket, row["chunk"], 0, _pack(np.packbits(copied[low:high]), np.packbits(unsettled[low:high])))])


def _texts(batches):
    """The chunks' own rows, which the answers meet. Ranks are not needed for these."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for piece, buf, offsets, ids in _pieces(batches):
        null = piece.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        name = _name(T.prefix_hash(buf), offsets, ids)
        yield _rows([(0, name, 2, _pack(np.frombuffer(squeeze.compress(buf.tobytes()), np.uint8), np.diff(offsets), ids, null))])


def _answered(batches, buckets, length, key):
    """Each chunk again, with what was found of its pairs of ranks, and further answers by bucket."""
    for _, rows in _grouped(batches, "chunk"):
        settled = {r["bucket"]: r["data"] for r in rows if r["kind"] == 0}
        strings = {r["bucket"]: r["data"] for r in rows if r["kind"] == 1}
        for row in rows:
            if row["kind"] != 2:
                continue
            data, sizes, ids, null = _unpack(row["data"])
            buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(data.tobytes()), np.uint8)
            c = Chunk(buf, np.r_[0, np.cumsum(sizes)], ids, buckets, length, key)
            if set(c.buckets.tolist()) - settled.keys():
                raise RuntimeError("the documents read differ from those read before")
            copied, unsettled = np.zeros(len(c.first), bool), np.zeros(len(c.first), bool)
            for b, i, j in zip(c.buckets.tolist(), c.begin, c.end, strict=True):
                copied[i:j], unsettled[i:j] = (np.unpackbits(x, count=j - i).astype(bool) for x in _unpack(settled[b]))
            yield row["chunk"], c, copied, unsettled, strings, null


def _string_ranks(buckets, length, key):
    """All strings of the neighbourhoods that are not settled, as their bytes."""

    def run(batches):
        for name, c, _, unsettled, _, _ in _answered(batches, buckets, length, key):
            rows = []
            for b, i, j in zip(c.buckets.tolist(), c.begin, c.end, strict=True):
                at = c.first[i:j][unsettled[i:j]]
                if len(at):
                    sizes = c.high[at] + length - c.low[at]
                    start = np.cumsum(sizes) - sizes
                    take = np.arange(sizes.sum()) + np.repeat(c.low[at] - start, sizes)
                    rows.append((b, name, 1, _pack(c.buf[take], sizes.astype(np.uint16), *_pack_ids(c.doc[at]))))
            if rows:
                yield _rows(rows)

    return run


def _settle_strings(length):
    def run(batches):
        for bucket, rows in _grouped(batches, "bucket"):
            hashes, ids, counts = [], [], []
            for row in rows:
                buf, sizes, base, apart = _unpack(row["data"])
                sizes = sizes.astype(np.int64)
                n = sizes - length + 1
                start = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n) + np.arange(n.sum())
                hashes.append(T.span_hash(T.prefix_hash(buf), start, start + length))
                ids.append(np.repeat(base + apart.astype(np.int64), n))
                counts.append(n.sum())
            flat = np.concatenate(ids)
            copied = flat > _shared([np.concatenate(hashes)], flat)[0]
            ends = np.cumsum(counts)
            for row, low, high in zip(rows, np.r_[0, ends[:-1]], ends, strict=True):
                yield _rows([(bucket, row["chunk"], 1, _pack(np.packbits(copied[low:high])))])

    return run


def _removed(buckets, length, key):
    def run(batches):
        for _, c, copied, unsettled, strings, null in _answered(batches, buckets, length, key):
            cover = np.zeros(len(c.buf) + 1, np.int64)
            whole = copied[c.entry] | (c.doc > c.least[c.entry])
            np.add.at(cover, c.low[whole], 1)
            np.add.at(cover, c.high[whole] + length, -1)
            order = np.argsort(c.entry, kind="stable")
            begin = np.searchsorted(c.entry[order], np.arange(len(c.first) + 1))
            for b, i, j in zip(c.buckets.tolist(), c.begin, c.end, strict=True):
                entries = np.arange(i, j)[unsettled[i:j]]
                if not len(entries):
                    continue
                n = c.high[c.first[entries]] - c.low[c.first[entries]] + 1
                bits = np.unpackbits(_unpack(strings[b])[0], count=int(n.sum())).astype(bool)
                for e, low, count in zip(entries.tolist(), (np.cumsum(n) - n).tolist(), n.tolist(), strict=True):
                    found = np.flatnonzero(bits[low : low + count])
                    if len(found):
                        for x in order[begin[e] : begin[e + 1]]:
                            if not whole[x]:
                                np.add.at(cover, c.low[x] + found, 1)
                                np.add.at(cover, c.low[x] + found + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            edge = c.offsets[:-1][np.diff(c.offsets) > 0]
            first[edge] |= gone[edge]
            sums = [np.r_[0, np.cumsum(x)] for x in (gone, first)]
            per = [s[c.offsets[1:]] - s[c.offsets[:-1]] for s in sums]
            kept = [c.buf[i:j][~gone[i:j]].tobytes() for i, j in zip(c.offsets[:-1], c.offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.ids, mask=null.astype(bool)), pa.array(np.diff(c.offsets)), *map(pa.array, per), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def _together(df: DataFrame, buckets: int, column: str, *then: str) -> DataFrame:
    """Rows dealt out by ``column``, to more partitions than the session names where 8 buckets each need more."""
    wanted = buckets // 8 + 1
    few = wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartition(column) if few else df.repartition(wanted, column)).sortWithinPartitions(column, *then)


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: int = KEY, bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (bytes) of every row of ``docs(doc_id, text)``.

    Removed is each byte covered by a ``length``-byte string that also starts in a document of a smaller doc_id, judged on
    the input; texts are UTF-8 bytes, a null text is empty, and what is kept need not be UTF-8. Rows of one doc_id do not
    touch each other. A null doc_id counts as larger than all others. ``docs`` is read three times and must give the same
    rows in the same order, as stored tables do; if not, the job fails. Other columns are not looked at; an empty
    table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // bucket + 1
    setting = (buckets, length, key)
    ranks = _together(docs.mapInArrow(_first_ranks(*setting), PACKED), buckets, "bucket")
    settled = materialize(ranks.mapInArrow(_settle, PACKED), "settled")
    texts = docs.mapInArrow(_texts, PACKED)
    strings = _together(settled.union(texts), buckets, "chunk", "kind").mapInArrow(_string_ranks(*setting), PACKED)
    answers = materialize(_together(strings, buckets, "bucket").mapInArrow(_settle_strings(length), PACKED), "strings")
    whole = _together(settled.union(answers).union(texts), buckets, "chunk", "kind")
    return whole.mapInArrow(_removed(*setting), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
