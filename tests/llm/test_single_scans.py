import random

import pyarrow as pa
from pyspark.sql import functions as F

from kerbside.llm import suffixes, surrogates
from kerbside.llm import text as T

PARTS = """Dear|Mr.|Anna|Annabel|O'Neil|van|Dyck|xAnna|éAnna|name:|a@b.example.com|ya@b.de|+1 (017) 555-7713|(030) 12345678|Tel. 612 345 678|x0612345678
4111 1111 1111 1111|10.20.30.40|123-45-6789|DE89 3704 0044 0532 0130 00|aDE89370400440532013000|24be64439e3e49cf46b2d7c90f3602a3d0b907ff|Иван|漢字Mary|😀Mary|
﷐|$0|\\|-|.""".replace("\n", "|").split("|")


def test_cut_is_that_of_the_patterns(spark):
    """One scan, with places inside words passed, cuts as the bare patterns do; also where a text has the mark itself."""
    rng = random.Random(4)
    texts = [rng.choice([" ", "", "\n"]).join(rng.choices(PARTS, k=rng.randrange(1, 12))) for _ in range(1500)]
    texts += ["Mary", "Mary Anna", "x", "", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    bare = "|".join(f"(?:{p})" for p in surrogates.PATTERNS.values())
    rows = docs.select("text", surrogates._cut(F.col("text")).alias("cut"), F.regexp_extract_all("text", F.lit(f"({bare})"), 0).alias("entities"), F.split("text", f"(?:{bare})", -1).alias("pieces")).collect()
    assert sum(len(r.entities or []) for r in rows) > 1500
    for r in rows:
        assert (r.cut is None) == (r.text is None)
        if r.cut is not None:
            assert r.cut[1::2] == r.entities and r.cut[::2] == r.pieces and "".join(r.cut) == r.text


def test_the_patterns_are_not_run_again_on_what_is_written(spark):
    docs = spark.createDataFrame([(1, "Mail a@b.example.com"), (2, "none"), (3, None)], "doc_id long, text string")
    result = surrogates.replace(docs)
    assert not any(scan in result._jdf.queryExecution().optimizedPlan().toString() for scan in ("regexp_extract_all(text", "split(text"))
    assert [(r.doc_id, r.n_entities) for r in result.orderBy("doc_id").collect()] == [(1, 1), (2, 0), (3, 0)]


def test_texts_are_sent_without_ranking_them(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, None, 2]), "text": pa.array(["some text " * 9, None, "other text " * 9])})
    names = [row["chunk"] for rows in suffixes._first_ranks(3, 50, 20)([batch]) for row in rows.to_pylist()]
    monkeypatch.setattr(suffixes, "anchors", None)
    sent = [row for rows in suffixes._texts([batch]) for row in rows.to_pylist()]
    assert {row["chunk"] for row in sent} == set(names) and [row["kind"] for row in sent] == [2]


def test_window_hashes_are_span_hashes():
    buf, _ = T.flat(pa.array(["ab cé" * 40]))
    prefix = T.prefix_hash(buf)
    for size in (1, 20, len(buf)):
        at = T.np.arange(len(buf) - size + 1)
        assert (T.window_hash(prefix, size) == T.span_hash(prefix, at, at + size)).all()
