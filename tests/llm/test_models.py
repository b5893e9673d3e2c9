"""Classifiers on texts with a plain difference, by accuracy on rows that were held out, and on edge rows."""

import random

import pytest
from kerbside.llm import language, toxicity
from wording import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        words = prose(rng, rng.randrange(20, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "you moron", "pathetic", "scum!", "worthless"])
        rows.append((i, " ".join(words), int(toxic)))
    rows += [(1000, None, None), (1001, "", 0), (1002, "7 7 7", None), (None, "you idiot", None), (1003, "an 1d!ot and mor0n " * 30, None), (1004, "x" * 100_000, None)]
    return spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, toxic int, score string")


def test_toxicity(labelled):
    labels = labelled.selectExpr("doc_id", "toxic").where("doc_id < 600").union(labelled.selectExpr("doc_id", "CAST(NULL AS int)").limit(3))
    rows = {r.doc_id: r for r in toxicity.score(labelled, labels).collect()}
    assert len(rows) == labelled.count()
    held = [r for i, r in rows.items() if r.held_out and i < 600]
    assert 80 < len(held) < 160
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert rows[1000].score == rows[1001].score and not rows[1000].predicted
    assert not rows[None].held_out
    kept = toxicity.reject(labelled, labels)
    assert kept.columns == labelled.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if not r.predicted}


def test_toxicity_without_two_classes(labelled, nothing):
    for labels, score in ((labelled.selectExpr("doc_id", "1 AS toxic"), 1.0), (labelled.selectExpr("doc_id", "0 AS toxic"), 0.0), (labelled.selectExpr("doc_id", "toxic").where("false"), 0.0)):
        assert {r.score for r in toxicity.score(labelled, labels).collect()} == {score}
    assert toxicity.score(nothing, labelled.selectExpr("doc_id", "toxic")).count() == 0


def test_measures():
    lexicon = toxicity.Lexicon(stems={"mor": 0.1, "you ": 0.5})
    m = dict(zip(toxicity.NAMES, toxicity.measure("You IDIOT! you st*pid 1diot, id!ot...", lexicon), strict=True))
    assert m["hits"] == 1 and m["near"] == 1.0 and m["masked_hits"] == 1 and m["shouted"] > 0
    assert m["stem_hits"] == 2 and m["stem_ratio"] == pytest.approx(m["stem_density"] / 0.5)
    assert lexicon.hits(["moron", "morons", "mo", "yours", "you"]) == {"mor": 2, "you ": 1}
    assert toxicity.measure(None, lexicon) == toxicity.measure("", lexicon) == [0.0] * len(toxicity.NAMES)


def test_language(spark, nothing):
    rng = random.Random(2)
    syllables = {"en": "th er ing and the ou ly", "de": "sch ein ung der ich keit ver", "nl": "ij een heid van het aan oo", "fr": "eau tion que ment oi ré ou", "es": "ción que ado mente lla ez os"}
    rows = []
    for i in range(500):
        lang = list(syllables)[i % 5]
        text = " ".join("".join(rng.choice(syllables[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(15, 80)))
        rows.append((i, text, lang))
    rows += [(900, None, "en"), (901, "", "en"), (902, "12 34 !!", "fr"), (None, "the and ing thou", "en"), (903, "the " * 60_000, None)]
    docs = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 500]
    assert sum(r.lang_pred == list(syllables)[r.doc_id % 5] for r in held) >= 0.97 * len(held) > 50
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[903].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang <> ''").unionByName(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "score"))).collect()} == {"und"}
    assert language.identify(nothing).count() == 0
    assert {r.lang_pred for r in language.identify(docs.where("lang = 'de'")).collect()} == {"de"}


def test_stems_of_inflected_words(spark):
    """A class that is marked by forms of one stem only, each rare, beside one marked by a plain word."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        words = prose(rng, rng.randrange(60, 200)).split()
        if i % 6 == 0:
            for _ in range(len(words) // 20):
                words[rng.randrange(len(words))] = "Brux" + "".join(rng.choice("aeioklmnrst") for _ in range(rng.randrange(5)))
        elif i % 6 == 1:
            words[rng.randrange(len(words))] = "zok"
        elif i % 10 == 0:
            words[0] = "bruxel"
        rows.append((i, " ".join(words), int(i % 6 < 2), i % 10))
    rows += [(700, None, 0, 0), (701, "", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, part int")
    stems = toxicity.learn_stems(docs.selectExpr("text", "label"))
    assert {s.strip()[:3] for s in stems} == {"bru", "zok"} and len(stems) == 2
    assert toxicity.learn_stems(docs.selectExpr("text", "0 AS label")) == {}
    got = toxicity.score(docs.where("doc_id < 700"), docs.selectExpr("doc_id", "label AS toxic")).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 < 2) for r in held) >= 0.95 * len(held) > 80


def test_close_languages_by_pairs(spark, monkeypatch):
    """Three languages of one family that share most syllables, one of another family, and a rare one beyond the limit."""
    rng = random.Random(9)
    shared = "er en sch ung der die".split()
    own = {"de": ["keit", "zu"], "nl": ["ij", "oo"], "da": ["ae", "og"], "fr": ["eau", "tion", "que", "ment", "oi", "ré"], "xx": ["zz"]}
    rows = []
    for i in range(480):
        lang = list(own)[i % 4] if i % 97 else "xx"
        syllables = own[lang] + (shared if lang in ("de", "nl", "da") else [])
        text = " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 60)))
        rows.append((i, text, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(language, "MOST_LANGUAGES", 4)
    model = language.fit(docs)
    germanic = model.languages["germanic"]
    assert germanic.names == ["da", "de", "nl"] and germanic.pairs == [(0, 1), (0, 2), (1, 2)] and "xx" not in model.languages
    for _, text, lang in rows[:60]:  # against plain votes
        x = language.grams(text)
        votes = {n: 0 for n in germanic.names}
        for (a, b), w, c in zip(germanic.pairs, germanic.weights, germanic.offsets, strict=True):
            votes[germanic.names[a] if sum(p * q for p, q in zip(w, x, strict=True)) + c >= 0 else germanic.names[b]] += 1
        if max(votes.values()) == 2:
            assert germanic.choose(x)[0] == max(votes, key=votes.get)
    held = [r for r in language.identify(docs).collect() if r.held_out and rows[r.doc_id][2] != "xx"]
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in held) >= 0.95 * len(held) > 50
    assert all(0 <= r.score <= 1 for r in held)
