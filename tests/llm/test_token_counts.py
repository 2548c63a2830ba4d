"""The automaton against greedy longest match."""

import random

from docflow.llm import token_counts as t
from docflow.llm.sentencepiece_bpe import _model_bytes


def brute(word, first, further):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (further if at else first)), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


def test_random_vocabularies():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abc") for _ in range(rng.randint(1, n)))
    for _ in range(3000):
        first, further = {word(4) for _ in range(4)}, {word(4) for _ in range(4)}
        automaton = t.LongestMatch(first, further)
        for _ in range(5):
            w = word(10)
            assert automaton.count(w) == brute(w, first, further)


def test_real_vocabulary():
    first, further = t.vocabulary(_model_bytes(None))
    automaton, rng = t.LongestMatch(first, further), random.Random(2)
    for _ in range(5000):
        w = "".join(rng.choice(["th", "e", "ing", "a", "qu", "é", "你", "9", "tion", "😀", ".", "zz"]) for _ in range(rng.randint(1, 8)))
        assert automaton.count(w) == brute(w, first, further)


def test_frames(spark):
    texts = ["The cat sat", None, "", " \n", "The cat sat", "\U000e0001", "word " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as id")
    first, further = t.vocabulary(_model_bytes(None))
    for r in t.count_tokens(df).collect():
        counts = [brute(w, first, further) for w in (texts[r.doc_id] or "").split()]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(counts), sum(1 if n is None else n for n in counts), counts.count(None))
    assert t.count_tokens(df.limit(0)).count() == 0


def test_query(spark, tmp_path):
    """The registered query against greedy matching, over null, empty and repeated texts, null ids and clashing names; an empty table."""
    texts = [None, "", "The cat sat", "\U000e0001 x", "a b " * 30_000]
    rows = [(k, t, 1, "t") for k, t in enumerate(texts)] + [(2, texts[2], 2, "t"), (None, texts[2], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, n_tokens string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    first, further = t.vocabulary(_model_bytes(None))
    want = []
    for k, x, *_ in rows:
        counts = [brute(w, first, further) for w in (x or "").split()]
        want.append((k, len(counts), sum(1 if n is None else n for n in counts), counts.count(None)))
    assert sorted(map(repr, map(tuple, t.op5_token_counts(spark, str(tmp_path)).collect()))) == sorted(map(repr, want))
    df.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert t.op5_token_counts(spark, str(tmp_path / "none")).count() == 0
