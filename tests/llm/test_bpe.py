"""Byte-pair encoding against the tokenizers library, which the operator does not use."""

import hashlib
import random
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from kerbside.llm import bpe, queries  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "\r\n", "a", "b", "1", "!", "..", "é", "漢", "😀", "\xa0", "\x85", "\x1c", "​", "<|endoftext|>", "<|endof", "text|>", "'S", "’s", "the"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(PATH)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def coded(vocabulary, texts):
    ids, offsets = bpe.encode_texts(vocabulary, pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], bpe.decode_ids(vocabulary, ids, offsets)


def expected(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_random_texts(vocabulary, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(8000)]
    ids, back = coded(vocabulary, texts)
    assert ids == expected(library, texts) and back == texts


def test_code_points(vocabulary, library):
    points = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000] + list(range(1, 0x3100))
    texts = [f"a{chr(c)}a 1{chr(c)}1 {chr(c)}{chr(c)}! {chr(c)}" for c in points]
    ids, back = coded(vocabulary, texts)
    assert ids == expected(library, texts) and back == texts


@cache
def both():
    return bpe.Vocabulary.read(PATH), tokenizers.Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]))), max_size=6))
def test_any_texts(texts):
    vocabulary, library = both()
    ids, back = coded(vocabulary, texts)
    assert ids == expected(library, texts) and back == [t or "" for t in texts]


def test_long_words(vocabulary, library):
    rng = random.Random(3)
    texts = ["x" * 50_000, "".join(rng.choice("etaoinshr") for _ in range(5_000)), " " * 9_999, "ab" * 9_000 + "<|endoftext|>" * 3]
    ids, back = coded(vocabulary, texts)
    assert ids == expected(library, texts) and back == texts


def test_ids_that_no_text_has(vocabulary, library):
    rows = [[0, 50256, 7], [130, 200], [49_999, 60_000, 1], []]
    offsets = np.cumsum([0, *map(len, rows)])
    got = bpe.decode_ids(vocabulary, np.array([i for r in rows for i in r], np.uint32), offsets)
    assert got == [library.decode(r, skip_special_tokens=False) for r in rows]


def test_columns(spark, docs, corpus, nothing, library):
    texts = [r[1] or "" for r in corpus]
    kept = docs.withColumn("n_tokens", F.lit("clash")).withColumn("_ids", F.lit(3))
    got = bpe.tokenize(kept, PATH).withColumn("numbers", bpe.numbers(F.col("ids"))).collect()
    want = sorted(zip([str(r[0]) for r in corpus], texts, expected(library, texts), strict=True))
    assert sorted((str(r.doc_id), r.decoded, r.numbers) for r in got) == want
    assert all(r.n_tokens == len(r.numbers) == len(r.ids) // 4 and r._ids == 3 for r in got)
    assert bpe.tokenize(nothing, PATH).count() == 0


def test_query(spark, sf_dir, library):
    rows = {r.doc_id: r for r in queries.QUERIES["op12_bpe"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for (i, text), ids in zip(texts.items(), expected(library, list(texts.values())), strict=True):
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
