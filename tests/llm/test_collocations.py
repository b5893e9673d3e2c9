"""Phrase collocations against a plain count in exact arithmetic, and against the SQL twin."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as spark_entry
from differential import compare, duck_rows, spark_rows
from kerbside.llm import collocations
from kerbside.llm.text import LOWER


def plain(rows, longest=3, least=10, top=2000):
    counts = defaultdict(Counter)
    for text, lang in rows:
        text = bytes(LOWER[list((text or "").encode())]).decode()
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(x for g, x in f.items() if len(g) == 1)
        taken = {g: x for g, x in f.items() if len(g) > 1 and x >= least}
        most = Counter()
        for g, x in taken.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    most[g[i : i + size]] = max(most[g[i : i + size]], x)
        found = []
        for g, a in taken.items():
            if 100 * most[g] >= 50 * a:
                continue
            score, _, l, r = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((" ".join(g), a, l, r, n, score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, rank, *x) for rank, x in enumerate(found[:top], 1)]
    return sorted(out)


def mined(frame, **options):
    rows = collocations.mine(frame, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = ["of", "the", "New", "york", "city", "ünder", "Über", "a\xa0b", "x", "-", "漢字", "the's"]
    texts = []
    for i in range(300):
        line = [rng.choice(words) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            line.insert(rng.randrange(len(line) + 1), rng.choice(["new York city", "of the", "in spite of", "san Jose. new"]))
        texts.append((rng.choice([" ", "  ", "\t", " "]).join(line) + rng.choice([".", ",\n", "\x0bx", "\r\n"]) * rng.randrange(2), rng.choice(["en", "en", "de", None])))
    texts += [(None, "en"), ("", None), (" \t\n", "xx"), ("one word only " * 4, "yy"), ("a a a a a a a a a a a a a a a a", "zz"), ("the end. of the end" * 3000, "en")]
    return texts + texts[:20]


def frame_of(spark, rows):
    return spark.createDataFrame([(t, lang, 1, "s") for t, lang in rows], "text string, lang string, n int, score string").repartition(4)


def test_plain_count(spark, rows):
    assert mined(frame_of(spark, rows)) == plain(rows)


@pytest.mark.parametrize("options", [{"longest": 2}, {"longest": 4, "least": 5}, {"top": 7, "least": 3}])
def test_options(spark, rows, options):
    assert mined(frame_of(spark, rows[:80] + rows[-30:]), **options) == plain(rows[:80] + rows[-30:], **options)


def test_split_stripes_and_full_bit_map(spark, rows, monkeypatch):
    """Prefixes cut into parts, pieces of few bytes, and a bit map that lets nearly everything through."""
    monkeypatch.setattr(collocations, "STRIPE", 50)
    monkeypatch.setattr(collocations, "BITS", 13)
    monkeypatch.setattr(collocations, "PIECE", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # stripes of one key in many batches
    try:
        assert mined(frame_of(spark, rows)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_counts(spark):
    """Products beyond 64 bits."""
    known = {
        1: spark.createDataFrame([("en", "x", 10**15), ("en", "y", 3 * 10**15)], "lang string, phrase string, f long"),
        2: spark.createDataFrame([("en", "x y", 7 * 10**14)], "lang string, phrase string, f long"),
    }
    row = collocations._scored(2, known, 2).collect()[0]
    assert row.score == 10**6 * (7 * 10**14) ** 2 // (10**15 * 3 * 10**15) and (row.l, row.r) == (10**15, 3 * 10**15)


def test_nothing(spark, nothing):
    assert mined(nothing) == []
    assert mined(frame_of(spark, [(None, None), ("...", "en")])) == []


def test_sql_twin(spark, rows, tmp_path):
    frame_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = spark_rows(spark_entry.queries()["op11_collocations"](spark, str(tmp_path)))
    assert got == duck_rows(db, spark_entry.oracle_sql()["op11_collocations"])


def test_given_table(spark, db, sf_dir):
    got, want = compare(spark, db, sf_dir, "op11_collocations")
    assert got == want and len(got[1]) > 100
