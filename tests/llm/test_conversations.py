"""Conversation repair against a plain search over all edits, for small blocks and large."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from kerbside.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, cost string, block int"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NONE = ("system:", "user:", "assistant:")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def row_hash(conv, role, text):
    name = "~" if conv is None else f"={conv}"
    return hashlib.sha256(f"{len(name)}:{name}{len(role)}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    """The contract's figures of one conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], row_hash(r[0], r[2], r[3])))
    faults, seen = [], set()
    for _, _, role, text in rows:
        words = text.strip("\x20\t\n\x0b\x0c\r")
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        for name in ("user", "assistant") if inserted < 3 else ():
            if (state, name[0]) in NEXT:
                cost, letters, lines = best(i, NEXT[state, name[0]], inserted + 1)
                found.append((cost + 2, "I" + letters, (f"{name}:", *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, letters, lines = best(i + 1, state, 0)
            found.append((cost + 3, "D" + letters, lines))
            if faults[i] in ("", "truncated"):
                for letter, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if (state, name[:1]) in NEXT:
                        cost, letters, lines = best(i + 1, NEXT[state, name[:1]], 0)
                        found.append((cost + price + (faults[i] == "truncated"), letter + letters, (f"{name}:{text}", *lines)))
        return min(found, default=(10**9, "~", ()))

    for i in range(len(rows), -1, -50):  # keeps the recursion shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    after = damaged(rows)
    return {c: plain([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}


def got(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "User", "", None, "aide", "ünder"]
    texts = ["Well.", "So?", "no end", "", " \t\n", None, "x. ", "tail .\x0b", "zwölf!", "a\xa0", "It is.\n\n"]
    out = []
    for conv in [*range(60), None]:
        turns = [rng.choice([None, *range(12)]) if conv and conv % 3 else i for i in range(rng.randrange(0, 14))]
        for t in turns:
            role = rng.choice(roles) if rng.random() < 0.6 or t is None else roles[t % 2]
            out.append((conv, t, role, rng.choice(texts) if rng.random() < 0.7 else f"Line {rng.random()}."))
    out += [(500, i, "user" if i % 2 else "assistant", f"turn {i}" + rng.choice([".", ""])) for i in range(300)]
    out += [(501, None, "user", "again")] * 40 + [(501, 3, "user", "again"), (502, 1, "user", "long " * 20_000 + ".")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [4096, 8, 1])
def test_against_all_edits(spark, rows, block, monkeypatch, tmp_path):
    monkeypatch.setattr(conversations, "BLOCK", block)
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    want = expected(rows)
    assert got(queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path))) == want


def test_empty_and_dropped(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    repaired = conversations.repair(empty)
    assert repaired.rows.count() == repaired.report.count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(dropped, 0, "user", "Hi.", "", 0)], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = got(queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)))
    assert rows == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows(spark, rows):
    """The rows of the result: order of roles, edits as in the audit, texts of the rows kept."""
    after = damaged([r for r in rows if r[0] is not None])
    repaired = conversations.repair(spark.createDataFrame(after, "conv_id long, turn long, role string, text string"))
    audits = {r.conv_id: r.audit for r in repaired.report.collect()}
    found = {}
    for r in sorted(repaired.rows.collect(), key=lambda r: (r.block, r.step)):
        found.setdefault(r.conv_id, []).append(r)
    for conv, audit in audits.items():
        lines = found.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in lines))
        assert "".join(r.edit for r in lines) == audit.replace("D", "")
        assert all(r.text == "" for r in lines if r.edit == "I")
        assert {r.text for r in lines if r.edit != "I"} <= {r[3] for r in after if r[0] == conv}


def test_given_table(spark, sf_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert got(queries.QUERIES["op13_conversation_repair"](spark, sf_dir)) == expected(rows)
