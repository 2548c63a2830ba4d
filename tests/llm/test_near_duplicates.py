"""Classes against brute force over all pairs; sampling agrees with the similarity it estimates."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from docflow.llm import near_duplicates as n

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def weighted(text, weights):
    own = n.shingles(pa.array([text]))
    return dict(zip(own[1].tolist(), weights.of(own[1], own[2]).tolist(), strict=True))


def jaccard(a, b):
    low = sum(min(w, b[k]) for k, w in a.items() if k in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if a and b else 0.0


def corpus(seed, groups, size, copies=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    shared = " ".join(word() for _ in range(15))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(30, 90))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, size)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = word()
            texts.append(rng.choice([" ", "\n"]).join(own).title() if rng.random() < 0.3 else " ".join(own))
    texts += [" ".join(word() for _ in range(60)) + " " + shared for _ in range(20)]
    texts += ["one two", "One  two!", "one", "", None, "!!!", "!!!", *[texts[0]] * copies]
    return texts


def brute(rows, weights):
    vectors = {}
    for i, t in rows:
        if i is not None and t:
            vectors.setdefault(i, weighted(t, weights))
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(vectors)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if find(a) != find(b) and jaccard(vectors[a], vectors[b]) >= n.THRESHOLD:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in parent}


@pytest.mark.parametrize(("groups", "size"), [(40, 4), (3, 60)])
def test_classes_equal_brute_force(spark, groups, size):
    texts = corpus(groups, groups, size)
    rng = random.Random(1)
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts, strict=True)) + [(None, texts[0]), (None, None), (ids[1], texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'x' as class_id")
    weights = n.fit(df.selectExpr("doc_id as id", "text"), [])
    want = brute(rows, weights)
    out = n.classes(df).collect()
    assert len(out) == len(rows) and [r.class_id for r in out if r.doc_id is None] == [None, None]
    got = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    wrong = [k for k in want if got[k] != want[k]]
    assert not wrong
    kept = n.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert n.classes(df).count() == 0 and n.deduplicate(df).count() == 0


def test_word_and_shingle_hashes():
    texts = ["a b c d e f", "A  b,c d-e\nf", "b c d e f", "é ü", "", None, "a b c d e a b c d e"]
    h, first = n.word_hashes(pa.array(texts))
    assert np.diff(first).tolist() == [len(WORD.findall((t or "").encode().lower())) for t in texts]
    assert h[: first[1]].tolist() == h[first[1] : first[2]].tolist() and len(set(h[: first[1]].tolist())) == 6
    of, s, tf, _ = n.shingles(pa.array(texts))
    assert np.bincount(of, minlength=7).tolist() == [2, 2, 1, 1, 0, 0, 5] and tf[of == 6].max() == 2
    assert set(s[of == 0]) == set(s[of == 1]) and set(s[of == 2]) < set(s[of == 0])


def test_sampling_estimates_similarity():
    rng = random.Random(5)
    weights = n.Weights(np.full(1 << n.SKETCH_BITS, 1), 1000)
    base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    hits, total = 0, 0
    for _ in range(40):
        own = list(base)
        for k in rng.sample(range(300), 3):
            own[k] = "z" + str(rng.random())
        of, s, tf, _ = n.shingles(pa.array([" ".join(base), " ".join(own)]))
        keys = n.band_keys(n.samples(weights, of, s, tf)[1])
        hits += (keys[0] == keys[1]).sum()
        total += n.BANDS
        j = n.similarity(weights, pa.array([" ".join(base)]), pa.array([" ".join(own)]))[0]
    assert abs(hits / total - j**n.ROWS) < 0.08


def test_similarity_equals_definition():
    texts = corpus(3, 6, 3)
    weights = n.Weights(np.random.default_rng(1).integers(1, 50, 1 << n.SKETCH_BITS), 60)
    vectors = [weighted(t, weights) if t else {} for t in texts]
    sides = n.shingles(pa.array(texts))[:3]
    shared = n._shared(weights, sides, sides, len(texts), len(texts))
    for i, t in enumerate(texts):
        got = n.similarity(weights, pa.array([t] * len(texts)), pa.array(texts))
        want = [jaccard(vectors[i], v) for v in vectors]
        assert np.allclose(got, want, atol=1e-9)
        low = [sum(min(w, v.get(k, 0)) for k, w in vectors[i].items()) for v in vectors]
        assert np.allclose(shared[i], low, atol=1e-9)


def test_components(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 140)] + [tuple(sorted(rng.sample(range(60), 2))) for _ in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r.label for r in n.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_weights_are_tf_times_idf():
    weights = n.Weights(np.array([0, 1, 10, 100, 1000] + [0] * ((1 << n.SKETCH_BITS) - 5)), 1000)
    assert weights.level[:5].tolist() == [round(np.log(1 + 1 / max(k / 1000, n.RARE)) / n.STEP) for k in (0, 1, 10, 100, 1000)] == [25, 25, 18, 10, 3]
    # The term frequency has no bound and is not rounded.
    own = n.shingles(pa.array(["a " * 5_000 + "b c d e f"]))
    w = weights.of(own[1], own[2]) / weights.idf(own[1])
    assert np.allclose(sorted(w)[-1], 1 + np.log(4_996)) and np.allclose(sorted(w)[0], 1)


def test_reference_counts_groups_of_copies_once(spark):
    """A third of all rows are near copies: their common shingles weigh as much as any other's; a line that all others share weighs little."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, line = [word() for _ in range(120)], [word() for _ in range(12)]
    rows = []
    for k in range(200):
        own = list(base)
        own[rng.randrange(120)] = word()
        rows.append((k, " ".join(own)))
    rows += [(200 + k, " ".join([word() for _ in range(60)] + line)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights = n.fit(df.selectExpr("doc_id as id", "text"), [])
    level = lambda words: np.median(weights.idf(n.shingles(pa.array([" ".join(words)]))[1]))
    assert level(base) > 5 and level(line) < 1.25
    got = {r.doc_id: r.class_id for r in n.classes(df).collect()}
    assert {got[k] for k in range(200)} == {0} and len({got[k] for k in range(200, 600)}) == 400


def test_repeated_ids(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(5, b, "y"), (5, a, "z"), (5, a, "x"), (7, a, "k"), (8, b, "k"), (9, c, "k"), (9, None, "k"), (None, a, "n"), (None, a, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    assert {(r.doc_id, r.class_id) for r in n.classes(df).collect()} == {(5, 5), (7, 5), (8, 5), (9, 9), (None, None)}
    assert sorted(map(repr, map(tuple, n.deduplicate(df).collect()))) == sorted(map(repr, [(5, a, "x"), (9, None, "k"), (None, a, "n"), (None, a, "n")]))


@pytest.mark.parametrize("few", [0, 500_000])
def test_texts_of_many_ids(spark, few, monkeypatch):
    monkeypatch.setattr(n, "SMALL_ROWS", max(few, 5))
    frame = spark.range(60).selectExpr("id", "cast(id as string) as text")
    ids = spark.range(0, 60, 3).selectExpr("id", "id + 1 as times")
    assert sorted(map(tuple, n._with_texts(frame, ids).collect())) == [(k, str(k), k + 1) for k in range(0, 60, 3)]


def test_spread_join(spark):
    from docflow.llm.common import spread_join

    left = spark.range(1000).selectExpr("id", "CASE WHEN id < 700 THEN 1 ELSE id % 7 END AS k")
    right = left.groupBy("k").count().withColumnRenamed("count", "n").selectExpr("k", "n", "k * 10 AS v").where("k <> 3")
    for per_task in (10, 10_000):
        for how in ("inner", "left"):
            out = spread_join(left, right, "k", "n", ["id"], per_task=per_task, how=how)
            assert sorted(map(repr, ((r.id, r.k, r.v) for r in out.collect()))) == sorted(map(repr, map(tuple, left.join(right.drop("n"), "k", how).select("id", "k", "v").collect())))


DOCUMENTS = "/root/testdata/sf0.01"


@pytest.mark.skipif(not __import__("os").path.exists(DOCUMENTS), reason="no test tables")
def test_recall_on_the_given_documents(spark):
    """All pairs of the documents that share a shingle, by their exact weights: classes are those of the links at the threshold."""
    docs = spark.read.parquet(f"{DOCUMENTS}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    weights = n.fit(docs.selectExpr("doc_id as id", "text"), [])
    want = brute(rows, weights)
    got = {r.doc_id: r.class_id for r in n.op10_near_duplicates(spark, DOCUMENTS).collect()}
    assert got == want


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, empty):
    texts = corpus(2, 12, 4)
    rows = [(k, t, k, "x", 1) for k, t in enumerate(texts)] + [(900, "word " * 60_000, 1, "x", 1), (901, "word " * 60_000 + "end", 1, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long, class_id string, n int")
    (df.limit(0) if empty else df).write.parquet(str(tmp_path / "documents.parquet"))
    out = n.op10_near_duplicates(spark, str(tmp_path))
    assert out.columns == ["doc_id", "class_id"]
    got = {r.doc_id: r.class_id for r in out.collect()}
    assert got == ({} if empty else brute([r[:2] for r in rows], n.fit(df.selectExpr("doc_id as id", "text"), [])))
