import random

import pytest
from wording import edited, prose

from kerbside.llm import store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, slot string, score string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    store.ship(spark)


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents with copies, near copies, shared passages, nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([3, 30, 60, 150])) for _ in range(60)]
    base = prose(rng, 120)
    texts += [edited(rng, base, every) for every in (200, 90, 60, 40, 20, 10) for _ in range(4)] + [base] * 3
    passage = prose(rng, 60)
    texts += [prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40) for _ in range(6)]
    texts += [None, "", "  \n\t ", "x", "one two", "é ü ß 漢字 😀 " * 20, "a" * 3000, "repeat these words now " * 40, prose(rng, 30_000)]
    rows = [(7 * i % 1009, t, "en" if i % 3 else None, f"s{i % 3}" if i % 5 else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], "en", "s0"), (None, "alone without an id in this table of texts", None, None), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame([(*r, 1, "c", "s", "x") for r in corpus], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
