"""N-gram Jaccard join: groups of documents linked by the Jaccard similarity of their sets of word shingles.

Equal sets form a class, and classes stand for their documents from then on. The join is a prefix-filtered index join
made cheaper by the relations between sets:

* the shingles of all sets have one global order, those found to be frequent last, and an index list holds the classes
  that have its shingle among the first ``n - ceil(t n) + 1`` of their ``n``; any two similar classes share such a list;
* a list is cut into blocks by set size, and a probe skips all blocks but its own and the next; a pair is skipped if
  the positions of its first shared shingle, the number of lists it shares or the bits in which 512-bit maps of the two
  sets differ leave the threshold out of reach;
* a set takes its answers from a highly similar set: first each class is compared only with its predecessor in each
  list, and linked classes become one component. What a component has found holds for all its members, so the second
  join probes only entries of different components. Every link between different components is found there.

Only groups (components) are wanted, so no list is ever expanded into all its pairs: a group of thousands of near copies
costs one link a member.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm import graph, text
from kerbside.llm.store import materialize

COUNTERS = 1 << 18  # hashed counters that tell frequent shingles; their number does not depend on the data
MAP = [f"m{i}" for i in range(8)]  # 512 bits of a set: each is the parity of the shingles hashed to it
HASHED = f"doc_id long, n long, cid long, {', '.join(f'{m} long' for m in MAP)}"
POSTED = "token long, cid long, n int, pos int"
LINKED = "a long, b long"


def _sets(batches, k):
    """Pieces of documents with their distinct shingle hashes."""
    for piece in text.pieces(batches):
        h, doc = text.word_hashes(piece.column("text"), lower=True)
        h, doc = text.distinct(*text.shingles(h, doc, k, whole=True))
        yield piece, h, doc


def _class_ids(h, doc, rows):
    """Size and class of each document; equal sets have equal ids."""
    n = np.bincount(doc, minlength=rows).astype(np.int64)
    sums = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(text.mix(h ^ text.u64(seed)), out=total[1:])
        ends = np.concatenate([[0], np.cumsum(n)])
        sums.append(total[ends[1:]] - total[ends[:-1]])
    return n, text.mix(sums[0] ^ text.mix(sums[1] + n.astype(np.uint64))).view(np.int64)


def _maps(h, doc, rows):
    """The 8 words of each set's bit map. Bits in which two maps differ are no more than shingles in which the sets do."""
    slot = (text.mix(h ^ text.u64(0xA4093822299F31D0)) & text.u64(511)).astype(np.int64)
    odd = (np.bincount(doc * 512 + slot, minlength=rows * 512) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, 512), axis=1, bitorder="little").view(np.int64)


def _heavy(k):
    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for _, h, _ in _sets(batches, k):
            counts += np.bincount((h & text.u64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        mean = counts.mean()
        at = np.flatnonzero(counts > mean + 4 * math.sqrt(mean) + 4)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["slot", "seen"])

    return run


def _hashed(k):
    def run(batches):
        for piece, h, doc in _sets(batches, k):
            n, cid = _class_ids(h, doc, piece.num_rows)
            maps = _maps(h, doc, piece.num_rows)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n), pa.array(cid), *map(pa.array, maps.T.copy())], ["doc_id", "n", "cid", *MAP])

    return run


def _posted(k, percent, weights):
    def run(batches):
        seen: set[int] = set()
        heavy = weights.value
        for piece, h, doc in _sets(batches, k):
            n, cid = _class_ids(h, doc, piece.num_rows)
            fresh = np.zeros(piece.num_rows, bool)
            for row, c in enumerate(cid.tolist()):
                if n[row] and c not in seen:
                    seen.add(c)
                    fresh[row] = True
            take = fresh[doc]
            h, doc = h[take], doc[take]
            order = np.lexsort((h, heavy[(h & text.u64(COUNTERS - 1)).astype(np.int64)], doc))
            h, doc = h[order], doc[order]
            sizes = np.bincount(doc, minlength=piece.num_rows)
            pos = np.arange(len(h)) - (np.cumsum(sizes) - sizes)[doc]
            keep = pos < n[doc] - (percent * n[doc] + 99) // 100 + 1
            h, doc, pos = h[keep], doc[keep], pos[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(cid[doc]), pa.array(n[doc].astype(np.int32)), pa.array(pos.astype(np.int32))],
                ["token", "cid", "n", "pos"],
            )

    return run


def _compared(k, percent):
    """Pairs ``a, cid_a, text_a, b, cid_b, text_b`` that are similar; sets are made again from the texts."""

    def run(batches):
        for batch in text.pieces(text.pieces(batches, "text_a"), "text_b"):
            rows = batch.num_rows
            found = []
            for side in "ab":
                h, doc = text.word_hashes(batch.column(f"text_{side}"), lower=True)
                h, doc = text.distinct(*text.shingles(h, doc, k, whole=True))
                n, cid = _class_ids(h, doc, rows)
                found.append((h, doc, n, cid == batch.column(f"cid_{side}").to_numpy()))
            (ha, da, na, same_a), (hb, db, nb, same_b) = found
            h, doc = np.concatenate([ha, hb]), np.concatenate([da, db])
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            both = doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])]
            shared = np.bincount(both, minlength=rows)
            ok = pa.array(same_a & same_b & (shared > 0) & (100 * shared >= percent * (na + nb - shared)))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

    return run


def _weights(docs, k):
    """Broadcast array of COUNTERS counts, 0 for what is not frequent. Any weights give the same links."""
    rows = docs.mapInArrow(_heavy(k), "slot long, seen long").groupBy("slot").agg(F.sum("seen").alias("seen")).toArrow()
    weights = np.zeros(COUNTERS, np.int64)
    weights[rows.column("slot").to_numpy()] = rows.column("seen").to_numpy()
    return docs.sparkSession.sparkContext.broadcast(weights)


def _least_lists(percent):
    """Number of lists that a pair of ``na`` and ``nb`` shingles must share at least to be similar.

    What the sets share is in both prefixes or, beyond that of the set whose prefix ends first, among the rest of it.
    """
    shared = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    rest = [F.floor((percent * F.col(n) + 99) / 100) - 1 for n in ("na", "nb")]
    return F.greatest(F.lit(1), shared - F.greatest(*rest))


def _met(entries, classes, percent):
    """Neighbours in an order of each list of its own, so that members of a large group meet many others, if maps allow.

    Like the first neighbours these only make components early, which spares the second join; what is left out here (sets
    of more than 3000 shingles, whose maps tell little) is found there.
    """
    shuffled = Window.partitionBy("token").orderBy(F.xxhash64("token", "cid"), "cid")
    met = entries.select("cid", "n", F.lag("cid").over(shuffled).alias("other"), F.lag("n").over(shuffled).alias("n_other"))
    met = met.where(f"cid <> other AND n <= 3000 AND 100 * least(n, n_other) >= {percent} * greatest(n, n_other)")
    pairs = met.select(F.least("cid", "other").alias("ca"), F.greatest("cid", "other").alias("cb"), (F.col("n") + F.col("n_other")).alias("both")).distinct()
    first = classes.select(F.col("cid").alias("ca"), *MAP)
    second = classes.select(F.col("cid").alias("cb"), *(F.col(m).alias(f"{m}_b") for m in MAP))
    return materialize(pairs, "met").join(first, "ca").join(second, "cb").where((100 + percent) * _differ() <= (100 - percent) * F.col("both")).select("ca", "cb")


def _differ():
    return sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}_b"))) for m in MAP), F.lit(0))


def _similar(docs, classes, pairs, k, percent):
    """Links among the written ``pairs(ca, cb)`` of classes, as representatives' ids."""
    wanted = pairs.select(F.col("ca").alias("cid")).union(pairs.select("cb")).distinct().join(classes, "cid").where("rep IS NOT NULL")
    texts = docs.withColumnRenamed("doc_id", "rep").join(wanted.hint("shuffle_hash"), "rep").select("cid", "rep", "text")
    texts = materialize(texts, "texts")
    side = lambda s: texts.select(F.col("cid").alias(f"cid_{s}"), F.col("rep").alias(s), F.col("text").alias(f"text_{s}"))
    a, b = side("a"), side("b")
    joined = pairs.join(a, pairs["ca"] == a["cid_a"]).join(b, pairs["cb"] == b["cid_b"])
    return joined.select("a", "cid_a", "text_a", "b", "cid_b", "text_b").mapInArrow(_compared(k, percent), LINKED)


def join_groups(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs(doc_id, text)``.

    Two rows link when 100 * intersection >= percent * union of their sets of distinct ``k``-word shingles (A-Z in lower
    case); ``component_id`` is the smallest doc_id reachable. Null and empty texts have an empty set and stand alone, and
    so do texts without words. A row with a null doc_id links with equal sets only and never names a group; if it
    stands alone its component_id is null. Repeated rows come out as often as they came in, in one group. Other columns
    are not looked at. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = materialize(docs.mapInArrow(_hashed(k), HASHED), "hashed")
    classes = materialize(hashed.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("rep"), *(F.max(m).alias(m) for m in MAP)), "classes")

    posted = docs.mapInArrow(_posted(k, percent, _weights(docs, k)), POSTED)
    listed = Window.partitionBy("token").orderBy("n", "cid")
    entries = posted.select(
        "*", F.lag("cid").over(listed).alias("before"), F.lag("n").over(listed).alias("n_before"), F.lead("cid").over(listed).alias("after")
    ).where("before <> cid OR after <> cid")
    entries = materialize(entries, "entries")

    near = entries.where(f"before <> cid AND 100 * n_before >= {percent} * n").groupBy(F.col("before").alias("ca"), F.col("cid").alias("cb"))
    near = near.agg(F.count("*").alias("lists"), F.first("n_before").alias("na"), F.first("n").alias("nb"))
    near = near.where(4 * F.col("lists") >= _least_lists(percent)).select("ca", "cb").union(_met(entries, classes, percent)).distinct()
    links = materialize(_similar(docs, classes, materialize(near, "near"), k, percent), "links")
    first = graph.components(links)

    links = links.union(_across(docs, entries, classes, first, k, percent))
    return _labelled(hashed, classes, graph.components(links))


def _across(docs, entries, classes, first, k, percent):
    """Links between classes of different components: the second probe of the index."""
    component = materialize(
        classes.where("rep IS NOT NULL").join(first, F.col("rep") == F.col("node"), "left").select("cid", F.coalesce("component", "rep").alias("component"), *MAP), "component"
    )
    known = entries.select("token", "cid", "n", "pos").join(component, "cid")
    mixed = known.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    known = materialize(known, "known")
    block = F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100)).cast("int")
    left = materialize(known.join(mixed, "token", "left_semi").withColumn("block", block), "mixed")
    right = left.select(
        "token",
        F.explode(F.array(F.col("block") - 1, F.col("block"))).alias("block"),
        *(F.col(c).alias(f"{c}_b") for c in ("cid", "n", "pos", "component", *MAP)),
    )
    alike = (100 * F.col("n") >= percent * F.col("n_b")) & ((F.col("n") < F.col("n_b")) | ((F.col("n") == F.col("n_b")) & (F.col("cid") < F.col("cid_b"))))
    alike &= (100 + percent) * _differ() <= (100 - percent) * (F.col("n") + F.col("n_b"))
    pairs = left.join(right, ["token", "block"]).where((F.col("component") != F.col("component_b")) & alike)
    pairs = pairs.groupBy(F.col("cid").alias("ca"), F.col("cid_b").alias("cb")).agg(
        F.count("*").alias("lists"),
        *(F.first(c).alias(a) for c, a in (("n", "na"), ("n_b", "nb"))),
        *(F.min(c).alias(a) for c, a in (("pos", "pa"), ("pos_b", "pb"))),
    )
    reach = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))  # shared shingles, from the first shared one on
    pairs = pairs.where((F.col("lists") >= _least_lists(percent)) & ((100 + percent) * reach >= percent * (F.col("na") + F.col("nb"))))
    return _similar(docs, classes, materialize(pairs.select("ca", "cb"), "pairs"), k, percent)


def _labelled(hashed, classes, labels):
    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select(F.col("cid").alias("of"), F.coalesce("component", "rep").alias("component"))
    named = materialize(named, "named")
    return hashed.join(named, (F.col("cid") == F.col("of")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")
    )


def drop_copies(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each group, that of its smallest doc_id, once. Rows with a null doc_id all stay: no
    decision can name them. Columns are those of ``docs``."""
    kept = join_groups(docs, k, percent).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    chosen = docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return chosen.unionByName(docs.where("doc_id IS NULL"))
