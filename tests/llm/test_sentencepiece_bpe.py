"""Ids and texts exactly as the library gives them."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from docflow.llm import sentencepiece_bpe as b

PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "你", "好", "😀", "▁", "1", "23", "=", "====", "\x00", "tion", "\xa0", "ß", "aaaa", "\r", "<s>", '"', ".", "The", "ا", "ы", "ко", "<0x41>", "﻿"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b.MODEL))


@pytest.fixture(scope="module")
def model():
    return b.load(public_tokenizers.path(b.MODEL))


def test_random_texts(library, model):
    rng = random.Random(11)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        want = library.encode(text)
        assert model.encode(text) == want
        assert model.decode(want) == library.decode(want)


@pytest.mark.parametrize("text", ["", " ", " " * 700, "\n" * 50, "x" * 9000, " " * 9000, "abcabd" * 2000, "=" * 5000, "a " * 3000 + "é" * 5000, "▁" * 100])
def test_long_and_uniform_texts(library, model, text):
    assert model.encode(text) == library.encode(text)


def test_decoding_of_any_ids(library, model):
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)


def test_frames(spark, library):
    texts = ["The cat", None, "", "The cat", "x\ny  z " * 50, "日本 😀"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'n' as n_tokens", "1 as ids")
    out = {r.doc_id: r for r in b.encode(df).collect()}
    for k, t in enumerate(texts):
        ids = library.encode(t or "")
        assert out[k].ids == ids and out[k].n_tokens == len(ids)
        assert out[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[k].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = {r.doc_id: r.text for r in b.decode(b.encode(df)).collect()}
    assert back == {k: t or "" for k, t in enumerate(texts)}
    assert b.encode(df.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, library, empty):
    """The registered query against the library, over null, empty, repeated and very long texts, null ids and clashing names."""
    texts = [None, "", "The cat", "é 你 😀", "one two  three\n" * 20_000, "x" * 6_000]
    rows = [(k, t, "n", 1) for k, t in enumerate(texts)] + [(2, "The cat", "n", 2), (None, "The cat", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    (df.limit(0) if empty else df).write.parquet(str(tmp_path / "documents.parquet"))
    out = b.op3_sentencepiece(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for k, t, *_ in rows:
        ids = library.encode(t or "")
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, out.collect()))) == ([] if empty else sorted(map(repr, want)))
