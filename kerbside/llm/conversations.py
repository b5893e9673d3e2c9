"""Repair of conversations by the cheapest edits that give a proper order of roles.

A row is kept (K), given another role (R), deleted (D), or a row without text is inserted (I); what is left must have roles
that begin ``(s?(ua)+)?``. The state of the output is nothing yet, after s, after u or after a, and a backward vector has
the least cost from each state to a proper end. Among the cheapest edits the ASCII-least string of initials is taken: walk
forward and take the smallest letter whose cost is tight. From one state each letter leads to one state, so a walk is a
path, and the roles follow from it.

The order of all rows is a range sort, which splits a long conversation. Its rows fall into blocks of at most BLOCK rows
that are neighbours in that order. A block is a (min, +) matrix over the states; multiplied up from the end these give
the vector at the end of each block, the coarse checkpoints. Within a block vectors are stored at about the square root of
its rows, and recomputed between two of them while walking forward. Each block is walked from all four states, and the
blocks' walks are put together per conversation. So a task holds one block, or a few numbers for each block of one
conversation; the texts take no part. They move once, to the edits that keep them, by a hash of (conversation, role, text).
"""

from __future__ import annotations

import hashlib
from functools import cache
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.store import materialize

BLOCK = 4096  # rows, a power of two
SEEN = r"[^\x20\x09-\x0D]"
CUT = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"  # the last sign that is seen ends no sentence
GOOD, CUT_OFF, BLANK, REPEATED = range(4)  # a row's first fault
START, S, U, A = range(4)
FAR = 1 << 40  # cost of what cannot be
#: The state after an output row with this initial, from each state; the fourth initial is any other.
AFTER = ((S, None, None, None), (U, U, None, U), (None, None, A, None), (None, None, None, None))
INSERTED = (U, U, A, U)  # the state after an inserted row, and after a change of role
ROLE = {U: "user", A: "assistant"}
END = (0, 4, 2, 0)  # costs at the end of a conversation


class Repaired(NamedTuple):
    """``rows``: conv_id, block, step, edit, role, text, one per row of the result; (block, step) is their order within a conversation.

    ``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, one per conversation that has rows.
    """

    rows: DataFrame
    report: DataFrame


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults by crc32 of ``conv_id:turn`` modulo 20 (null: one space).

    0 drops the row, 1 empties its text, 2 takes its ``[.!?]`` out, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("_kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _closed(costs) -> tuple[int, ...]:
    """With insertions before the next row."""
    start, s, u, a = costs
    u, a = min(u, 2 + a), min(a, 2 + u)
    return min(start, 2 + u, FAR), min(s, 2 + u, FAR), min(u, FAR), min(a, FAR)


@cache
def back(code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The vector before a row of this code, less its least entry, and that entry. ``code`` is 4 * fault + initial."""
    fault, initial = divmod(code, 4)
    costs = [3 + c for c in after]
    if fault < BLANK:
        for q in range(4):
            kept = AFTER[initial][q]
            if kept is not None:
                costs[q] = min(costs[q], fault + after[kept])
            costs[q] = min(costs[q], 2 + fault + after[INSERTED[q]])
    closed = _closed(costs)
    least = min(closed)
    return tuple(FAR if c >= FAR else c - least for c in closed), least


@cache
def forth(code: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The letters up to and with the one that takes this row, the least that are tight, and the state after them."""
    fault, initial = divmod(code, 4)
    before, least = back(code, after)
    before = [c + least for c in before]
    letters = ""
    while True:
        if 3 + after[state] == before[state]:
            return letters + "D", state
        if 2 + before[INSERTED[state]] == before[state]:
            letters, state = letters + "I", INSERTED[state]
            continue
        kept = AFTER[initial][state]
        if fault < BLANK and kept is not None and fault + after[kept] == before[state]:
            return letters + "K", kept
        return letters + "R", INSERTED[state]


def vector(codes: list[int], times: list[int], end: tuple[int, ...]) -> tuple[int, ...]:
    """The backward vector before the first of these rows."""
    total = 0
    for code, n in zip(reversed(codes), reversed(times), strict=True):
        end, least = back(code, end)
        total += least + 3 * (n - 1)
    return tuple(FAR if c >= FAR else c + total for c in end)


def walk(codes: list[int], times: list[int], end: tuple[int, ...], state: int) -> tuple[list[str], int]:
    """The letters for each row from this state on, and the state at the end; all vectors less their least entry."""
    size = isqrt(len(codes)) + 1
    stored = {}
    for i in range(len(codes) - 1, -1, -1):
        if i % size == size - 1 or i == len(codes) - 1:
            stored[i // size] = end  # after the last row of this stretch
        end, _ = back(codes[i], end)
    letters = []
    for stretch in range(len(stored)):
        low, high = stretch * size, min(len(codes), (stretch + 1) * size)
        vectors = [stored[stretch]]
        for i in range(high - 1, low, -1):
            vectors.append(back(codes[i], vectors[-1])[0])
        for i, after in zip(range(low, high), reversed(vectors), strict=True):
            taken, state = forth(codes[i], after, state)
            letters.append(taken + "D" * (times[i] - 1))
    return letters, state


def finish(state: int) -> str:
    """Insertions at the end of a conversation."""
    return "I" * (END[state] // 2)


def _codes(text: str, times) -> tuple[list[int], list[int]]:
    codes = [c - 65 for c in text.encode()]
    return codes, times or [1] * len(codes)


def _matrices(batches):
    """Per block: the vectors to each end state in a row, the illegal neighbours, the faults' numbers."""
    for batch in batches:
        found = []
        for text, times in zip(batch.column("codes").to_pylist(), batch.column("times").to_pylist(), strict=True):
            codes, times = _codes(text, times)
            matrix = [c for q in range(4) for c in vector(codes, times, tuple(0 if p == q else FAR for p in range(4)))]
            initials = "".join("suao"[c % 4] for c in codes)
            legal = sum(initials.count(pair) for pair in ("su", "ua", "au"))
            faults = [0, 0, 0, 0]
            for code, n in zip(codes, times, strict=True):
                fault = code // 4
                if fault < BLANK:
                    faults[fault] += 1
                    faults[REPEATED] += n - 1
                else:
                    faults[fault] += n
            found.append((matrix, sum(times) - 1 - legal, *faults[1:], initials[0], initials[-1]))
        yield _extended(batch.select(["conv_id", "key", "low", "high", "turns", "first_turn", "last_turn"]), found, MATRIX)


def _ends(batches):
    """Per conversation: its numbers, and the vector at the end of each block."""
    for batch in batches:
        found = []
        for blocks in batch.column("blocks").to_pylist():
            blocks.sort(key=lambda b: b["key"])
            ends, costs = [], END
            for b in reversed(blocks):
                ends.append([c - min(costs) for c in costs])
                m = b["matrix"]
                costs = tuple(min(m[4 * q + p] + costs[q] for q in range(4)) for p in range(4))
            pairs = list(zip(blocks, blocks[1:], strict=False))
            illegal = sum(b["illegal"] for b in blocks) + sum(x["last"] + y["first"] not in ("su", "ua", "au") for x, y in pairs)
            turns = sum(b["turns"] for b in blocks) - sum(x["last_turn"] is not None and x["last_turn"] == y["first_turn"] for x, y in pairs)
            low = min((b["low"] for b in blocks if b["low"] is not None), default=None)
            high = max((b["high"] for b in blocks if b["high"] is not None), default=None)
            gaps = 0 if low is None else high - low + 1 - turns
            counts = [sum(b[k] for b in blocks) for k in ("blank", "duplicate", "truncated")]
            found.append((gaps, *counts, illegal, costs[START], [{"key": b["key"], "end": e} for b, e in zip(blocks, reversed(ends), strict=True)]))
        yield _extended(batch.select(["conv_id"]), found, ENDS)


def _walks(batches):
    """Per block: the letters and the last state from each first state (from START alone if it is the conversation's first)."""
    for batch in batches:
        found = []
        for text, times, end, first in zip(*(batch.column(c).to_pylist() for c in ("codes", "times", "end", "first")), strict=True):
            walks = [walk(*_codes(text, times), tuple(end), q) for q in ([START] if first else range(4))]
            found.append(([["".join(letters), str(q)] for letters, q in walks],))
        yield _extended(batch.select(["conv_id", "key"]), found, WALKS)


def _audits(batches):
    """Per conversation: the letters in a row, and of each block its letters and first state."""
    for batch in batches:
        found = []
        for blocks in batch.column("blocks").to_pylist():
            state, pieces = START, []
            for b in sorted(blocks, key=lambda b: b["key"]):
                letters, last = b["walks"][0 if len(b["walks"]) == 1 else state]
                pieces.append({"key": b["key"], "letters": letters, "state": state})
                state = int(last)
            pieces[-1]["letters"] += finish(state)
            found.append(("".join(p["letters"] for p in pieces), pieces))
        yield _extended(batch.select(["conv_id"]), found, AUDITS)


def _steps(batches):
    """Per row of the result: its step in the block, the row of the input that it is (null: inserted), the edit, its role (null: as it was)."""
    for batch in batches:
        rows, found = [], []
        for number, (key, letters, state, times, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "letters", "state", "times", "codes")), strict=True)):
            codes, times = _codes(text, times)
            at, repeats = 0, 0
            for step, letter in enumerate(letters):
                if letter != "I":
                    here = at
                    repeats = repeats + 1 if repeats + 1 < times[at] else 0
                    at += repeats == 0
                if letter == "D":
                    continue
                state = AFTER[codes[here] % 4][state] if letter == "K" else INSERTED[state]
                rows.append(number)
                found.append((step, None if letter == "I" else key + here, letter, None if letter == "K" else ROLE[state]))
        yield _extended(batch.select(["conv_id", "key"]).take(pa.array(rows, pa.int64())), found, STEPS)


_NUMBERS = pa.list_(pa.int64())
MATRIX = pa.schema([("matrix", _NUMBERS), *((n, pa.int64()) for n in ("illegal", "truncated", "blank", "duplicate")), ("first", pa.string()), ("last", pa.string())])
ENDS = pa.schema([*((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("ends", pa.list_(pa.struct([("key", pa.int64()), ("end", _NUMBERS)])))])
WALKS = pa.schema([("walks", pa.list_(pa.list_(pa.string())))])
AUDITS = pa.schema([("audit", pa.string()), ("pieces", pa.list_(pa.struct([("key", pa.int64()), ("letters", pa.string()), ("state", pa.int64())])))])
STEPS = pa.schema([("step", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string())])


def _extended(batch: pa.RecordBatch, found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in found], field.type) for i, field in enumerate(schema)]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *schema.names])


def _fields(df: DataFrame, *names: str, extra: str) -> str:
    """A schema of some columns of ``df`` and further ones."""
    return ", ".join([*(f"{n} {df.schema[n].dataType.simpleString()}" for n in names), extra])


def _hash(conv_id: Column, role: Column, text: Column) -> Column:
    conv = F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("~"))
    parts = [x for c in (conv, role) for x in (F.length(c).cast("string"), F.lit(":"), c)]
    return F.substring(F.unhex(F.sha2(F.concat(*parts, text), 256)), 1, 16)


def repair(rows: DataFrame) -> Repaired:
    """The cheapest repair of all conversations in ``rows(conv_id, turn, role, text)``.

    Rows of a conversation are taken by turn, nulls first, then by role and a hash of the text; equal rows side by side. A
    row's first fault counts: blank (nothing but white space), duplicate (role and text earlier in the conversation),
    truncated (no ``.!?`` at the end). Keep costs 0, a new role user or assistant 2, deletion 3 (a must for blank and
    duplicate rows), an inserted row without text 2, and a truncated row that stays 1.

    Null roles and texts count as one space; a null conv_id is a conversation of its own; null turns are left out of the
    gaps (missing turns between the least and the greatest). Other columns are not looked at; an empty table gives no rows.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("hash", _hash(F.col("conv_id"), F.col("role"), F.col("text"))).withColumn("blank", ~F.col("text").rlike(SEEN))
    initial = F.expr("CASE substring(role, 1, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")
    light = rows.select("conv_id", "turn", "role", "hash", "blank", F.col("text").rlike(CUT).alias("cut"), initial.alias("initial"))
    keys = ["conv_id", "turn", "role", "hash"]
    # Equal rows are one row with a count, so that a row that a third of the table repeats is no burden to one task.
    counted = light.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"), *(F.first(c).alias(c) for c in ("blank", "cut", "initial")))
    ordered = materialize(counted.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "ordered")

    earliest = ordered.where("NOT blank").groupBy("hash").agg(F.min("at").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marked = ordered.join(earliest, "hash", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("at") > F.col("earliest"), REPEATED).when(F.col("cut"), CUT_OFF).otherwise(GOOD)
    marked = marked.select("conv_id", "at", "turn", "times", F.char(65 + 4 * fault + F.col("initial")).alias("code"))
    blocks = marked.groupBy("conv_id", F.shiftright("at", BLOCK.bit_length() - 1).alias("_block")).agg(F.sort_array(F.collect_list(F.struct("at", "turn", "times", "code"))).alias("rows"), F.max("times").alias("most"))
    turns = F.col("rows.turn")
    blocks = materialize(
        blocks.select(
            "conv_id", F.col("rows")[0]["at"].alias("key"), F.array_join("rows.code", "").alias("codes"), F.when(F.col("most") > 1, F.col("rows.times")).alias("times"),
            F.array_min(turns).alias("low"), F.array_max(turns).alias("high"), F.size(F.array_distinct(F.array_compact(turns))).cast("long").alias("turns"),
            turns[0].alias("first_turn"), F.element_at(turns, -1).alias("last_turn"),
        ),
        "blocks",
    )

    of_block = ("conv_id", "key", "low", "high", "turns", "first_turn", "last_turn")
    matrices = blocks.mapInArrow(_matrices, _fields(blocks, *of_block, extra="matrix array<long>, illegal long, truncated long, blank long, duplicate long, first string, last string"))
    lists = matrices.groupBy("conv_id").agg(F.collect_list(F.struct(*(c for c in matrices.columns if c != "conv_id"))).alias("blocks"))
    numbers = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    ends = materialize(lists.mapInArrow(_ends, _fields(blocks, "conv_id", extra=numbers + ", ends array<struct<key: long, end: array<long>>>")), "ends")
    each = ends.select(F.posexplode("ends").alias("place", "of")).select("of.key", "of.end", (F.col("place") == 0).alias("first"))
    walks = blocks.join(each, "key").mapInArrow(_walks, _fields(blocks, "conv_id", "key", extra="walks array<array<string>>"))
    lists = walks.groupBy("conv_id").agg(F.collect_list(F.struct("key", "walks")).alias("blocks"))
    audits = materialize(lists.mapInArrow(_audits, _fields(blocks, "conv_id", extra="audit string, pieces array<struct<key: long, letters: string, state: long>>")), "audits")
    counts = numbers.replace(" long", "").split(", ")
    report = ends.select("conv_id", *counts, F.lit(None).cast("string").alias("audit")).unionByName(audits.select("conv_id", "audit"), allowMissingColumns=True)
    report = report.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in [*counts, "audit"]))

    pieces = audits.select(F.explode("pieces").alias("of")).select("of.*")
    steps = blocks.join(pieces, "key").mapInArrow(_steps, _fields(blocks, "conv_id", "key", extra="step long, at long, edit string, role string"))
    steps = materialize(steps, "steps").select("conv_id", F.col("key").alias("block"), "step", "at", "edit", F.col("role").alias("new_role"))
    texts = rows.where("NOT blank").groupBy("hash").agg(F.first("text").alias("text"))
    kept = steps.where("at IS NOT NULL").join(ordered.select("at", "role", "hash"), "at").join(texts, "hash")
    kept = kept.select("conv_id", "block", "step", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    inserted = steps.where("at IS NULL").select("conv_id", "block", "step", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(kept.unionByName(inserted), report)


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id`` and the SHA-256 of its ``role:text`` lines, of the rows of ``Repaired.rows``.

    The hash of a conversation is one sequence, so its rows pass through one task, in order and one by one.
    """

    def hashed(batches):
        name, digest = None, None
        for batch in batches:
            done, names = [], []
            column = batch.column("conv_id")
            for i, (conv, role, text) in enumerate(zip(column.to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if digest is None or conv != name[0].as_py():
                    if digest is not None:
                        names.append(name)
                        done.append(digest.hexdigest())
                    name, digest = column.slice(i, 1), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield from _named(names, done)
        if digest is not None:
            yield from _named([name], [digest.hexdigest()])

    def _named(names, done):
        if names:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(names), pa.array(done, pa.string())], ["conv_id", "sha256"])

    placed = rows.select("conv_id", "block", "step", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "block", "step")
    return placed.select("conv_id", "role", "text").mapInArrow(hashed, _fields(rows, "conv_id", extra="sha256 string"))
