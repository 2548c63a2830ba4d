"""Contamination against brute force over all windows."""

import hashlib
import random
import re

import pytest

from docflow.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, id string, spans int", "item_id long, text string, items int"


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = tokens(text)
        if item is None or not w:
            continue
        n = min(13, len(w))
        for k in range(len(w) - n + 1):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = tokens(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def cases():
    rng = random.Random(3)
    vocab = ["Ab", "b9", "c", "É", "ünd", "x_y", "the", "z"]
    make = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, make(rng.choice([1, 3, 12, 13, 14, 30]))) for k in range(9)] + [(9, None), (10, ""), (11, "!?"), (None, "the the"), (3, make(20)), (20, make(2))]
    docs = [(k, make(rng.randint(0, 60))) for k in range(60)]
    docs += [(100 + k, make(200) + t.upper() + make(250)) for k, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (202, "..."), (5, docs[5][1]), (5, docs[5][1]), (None, items[0][1]), (203, "a " * 50_000 + items[2][1])]
    return docs, items


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_scan_equals_brute_force(spark, limit):
    docs, items = cases()
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS)
    found = d.scan(frame, spark.createDataFrame([(*r, 0) for r in items], ITEMS), max_broadcast_bytes=limit)
    key = lambda r: (r[0] is None, r)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in found.collect()]
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    docs, items = cases()
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS)
    bench = spark.createDataFrame([(*r, 0) for r in items], ITEMS)
    bad = [r[-1] for r in brute(docs, items)]
    clean = d.decontaminate(frame, bench)
    assert clean.columns == frame.columns
    want = [(*r, "x", 1) for r, b in zip(docs, bad, strict=True) if not b]
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted(want, key=repr)
    cut = {r.doc_id: r.text for r in d.decontaminate(frame, bench, mode="spans").where("doc_id is not null").collect()}
    assert all(cut[r[0]] == r[1] for r, b in zip(docs, bad, strict=True) if not b and r[0] is not None)
    with pytest.raises(ValueError):
        d.decontaminate(frame, bench, mode="rows")
    joined = d.decontaminate(frame, bench, max_broadcast_bytes=0)
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_cut_texts_get_their_length(spark, limit):
    words = " ".join(f"w{k}" for k in range(13))
    rows = [(1, f"é {words} x", 99), (2, "clean", 77), (3, None, None)]
    out = d.decontaminate(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"), spark.createDataFrame([(1, words)], "item_id long, text string"), mode="spans", max_broadcast_bytes=limit)
    assert sorted(map(tuple, out.collect())) == [(1, "é  x", 4), (2, "clean", 77), (3, None, None)]


def test_built_size_is_bounded(spark):
    import tracemalloc

    rng = random.Random(5)
    items = [(str(k), " ".join(f"w{rng.randrange(4_000)}" for _ in range(rng.randint(5, 200)))) for k in range(300)]
    bound = d.built_bytes(spark.createDataFrame(items, "i string, t string"), d.WINDOW)
    tracemalloc.start()
    built = d.Windows(items)
    size = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert built.tables and 0.4 * bound < size <= bound


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, empty):
    """The registered query, against brute force, with null, empty and repeated rows and clashing names."""
    docs, items = cases()
    frame, bench = spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS), spark.createDataFrame([(*r, 0) for r in items], ITEMS)
    (frame.limit(0) if empty else frame).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    out = d.op2_decontaminate(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, out.collect()), key=repr) == ([] if empty else sorted(brute(docs, items), key=repr))


def test_spans_are_cut():
    assert d.remove_spans("Éa b, c d!", [(1, 3)]) == "Éa  d!"


def test_empty_tables(spark):
    docs, items = cases()
    none_docs, none_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert d.scan(none_docs, spark.createDataFrame([(*r, 0) for r in items], ITEMS)).count() == 0
    out = d.scan(spark.createDataFrame([(*r, "x", 1) for r in docs], DOCS), none_items)
    assert out.count() == len(docs) and out.where("contaminated or n_hit > 0").count() == 0
