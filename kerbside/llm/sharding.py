"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size; shards take turns claiming the
first slot of theirs that is free. All get nearly the same number of slots, and a shard added or removed moves few of
the others' slots. A document's slot is a hash of its key, so its shard is one lookup in the broadcast table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 6521  # prime, about 100 times the number of shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
MOST_SLOTS = 1_000_003  # of a table that is broadcast


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode(), usedforsecurity=False).hexdigest()[:15], 16)


def lookup_table(shards=SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard's place in ``shards`` for each slot; names must differ, and the table's size must be a prime above their number."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need different names")
    if not len(shards) <= slots <= MOST_SLOTS or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from {len(shards)} to {MOST_SLOTS}")
    at = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "skip") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def place(docs: DataFrame, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` (int) and ``shard`` (string), which replace columns of these names.

    The key is the doc_id, or the text of a row whose doc_id is null (empty if that is null too), so equal rows meet in
    one shard. No shuffle: the table, whose size is a parameter, is broadcast.
    """
    table = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, slots))]
    table = F.broadcast(docs.sparkSession.createDataFrame(table, "of_slot int, of_shard string"))
    names = [c for c in docs.columns if c not in ("slot", "shard")]
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.concat(F.lit("~"), F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
    slot = (F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")
    rows = docs.select(F.struct("*").alias("row")).select("row", slot.alias("at"))
    return rows.join(table, F.col("at") == F.col("of_slot")).select(*(F.col("row")[c].alias(c) for c in names), F.col("at").alias("slot"), F.col("of_shard").alias("shard"))


def write_shards(docs: DataFrame, path: str, files: int = 1, shards=SHARDS, slots: int = SLOTS) -> None:
    """Write a folder ``shard=NAME`` of Parquet for each shard, of up to ``files`` files, which split it by slots."""
    placed = place(docs, shards, slots)
    placed.repartition(len(shards) * files, "shard", F.col("slot") % files).write.partitionBy("shard").parquet(path)


def sharding_sql(shards=SHARDS, slots: int = SLOTS) -> str:
    table = ", ".join(map(str, lookup_table(shards, slots)))
    names = ", ".join(f"'{s}'" for s in shards)
    return f"""
        SELECT doc_id, CAST(slot AS INT) AS slot, ([{names}])[([{table}])[slot + 1] + 1] AS shard, n_bytes
        FROM (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
            CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '~' || coalesce(text, ''))), 1, 8) AS BIGINT) % {slots} AS slot FROM documents)"""
