import random

import numpy as np

from kerbside.llm import quality


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    """More labels of one side than a sample of 20 000 held, and the last of them decide."""
    n = 20_600
    docs = spark.range(n + 600).selectExpr("id AS doc_id", "CASE WHEN id < %d THEN concat('w', id %% 7, ' v', id %% 5, ' u', id %% 3) ELSE concat('j', id, ' ##') END AS text" % n)
    labels = docs.selectExpr("doc_id", f"CAST(doc_id < {n} AS int) AS quality").union(docs.selectExpr("doc_id", "NULL"))
    found = quality._labelled(docs, labels).groupBy("trusted").count().collect()
    assert {r.trusted: r["count"] for r in found} == {True: n, False: 600}
    fitted = []
    monkeypatch.setattr(quality, "LEAST_WORDS", 1)
    monkeypatch.setattr(quality, "threshold_of", lambda scores, spread: fitted.append({r.trusted: r["count"] for r in scores.groupBy("trusted").count().collect()}) or 0.0)
    quality.judge(docs, labels).count()
    assert fitted == [{True: n, False: 1200}]


def test_threshold_of_rows_is_that_of_all_scores(spark):
    rng = np.random.default_rng(3)
    sides = [(rng.normal(1, 1, n), rng.normal(-1, 1, m)) for n, m in ((1, 1), (5, 3), (40, 40), (2000, 300), (30, 0), (0, 3), (0, 0))]
    sides += [(a.round(1), b.round(1)) for a, b in sides]
    sides += [(np.array([0.5]), np.array([np.nextafter(0.5, 1)])), (np.array([np.nextafter(0.5, 1), 3]), np.array([0.5, -9.0])), (np.ones(3), np.ones(2))]
    sides += [(np.zeros(5) + 100, -np.arange(9.0)), (np.arange(4.0) - 9, np.arange(5.0))]
    for good, bad in sides:
        rows = [(True, float(x)) for x in good] + [(False, float(x)) for x in bad]
        random.Random(1).shuffle(rows)
        scores = spark.createDataFrame(rows, "trusted boolean, score double")
        want = quality.threshold(good, bad)
        got = quality.threshold_of(scores)
        assert got == want or abs(got - want) < 1e-12 and not len(bad)
