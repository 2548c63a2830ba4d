"""The stages of the pipeline on a small corpus, each against what it must keep."""

import random

import corpus_pipeline as p
from docflow.llm.common import table
from docflow.llm.sentencepiece_bpe import _model_bytes, _worker_model


def build(spark, folder):
    rng = random.Random(2)
    word = lambda s: "".join(rng.choice(s) for _ in range(3))
    prose = lambda n, s=("the", "ing", "wh", "er", "on"): " ".join(word(s) for _ in range(n))
    items = [(k, prose(40)) for k in range(4)]
    docs = [(k, prose(60) if k % 2 else prose(60, ("sch", "ung", "ein", "ie")), "en" if k % 2 else "de") for k in range(80)]
    near = docs[1][1].split()
    near[30] = "changed"
    docs += [(100, docs[0][1], "de"), (101, " ".join(near), "en"), (102, prose(50) + " " + items[2][1] + " " + prose(50), "en"), (103, prose(30) + " token=0123456789abcdefXYZ " + prose(30), "en"), (104, "123 !!", "en"), (105, None, None), (106, "", "en"), (107, prose(900) + " " + " ".join(items[1][1].split()[:13]), None)]
    rows = [(k, t, lang, "s", None if t is None else len(t)) for k, t, lang in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {k: t for k, t, _ in docs}


def test_stages(spark, tmp_path):
    texts = build(spark, str(tmp_path))
    docs, columns = table(spark, str(tmp_path), "documents"), None
    gone = [{104, 105, 106}, {100, 101}, {102}, set()]
    left = set(texts)
    for (name, stage), drop in zip(p.STAGES[:-1], gone, strict=True):
        columns = columns or docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        left -= drop
        assert sorted(r.doc_id for r in docs.collect()) == sorted(left), name
    got = {r.doc_id: r for r in docs.collect()}
    assert got[103].text == texts[103].replace("token=0123456789abcdefXYZ", "[SECRET]") and got[103].n_chars == len(got[103].text)
    assert all(r.text == texts[k] for k, r in got.items() if k != 103)
    model = _worker_model(_model_bytes(None))
    out = {r.doc_id: r.n_tokens for r in p.run(spark, str(tmp_path)).collect()}
    assert out == {k: len(model.encode(r.text)) for k, r in got.items()}
    assert [k for k, _ in p.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "sentencepiece"]


def test_empty_corpus(spark, tmp_path):
    build(spark, str(tmp_path / "full"))
    for name in ("documents", "benchmark"):
        table(spark, str(tmp_path / "full"), name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert p.run(spark, str(tmp_path)).count() == 0


def test_nulls_repeats_and_clashing_names(spark, tmp_path):
    """Null ids, repeated ids and rows, and columns that the operators use inside."""
    rng = random.Random(8)
    prose = lambda n, s=("the", "ing", "wh", "er", "on"): " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(n))
    rows = [(k, prose(60), "en", "s", 1) for k in range(40)] + [(k, prose(60, ("sch", "ung", "ein", "ie")), "de", "s", 1) for k in range(40, 80)]
    a, b = rows[3][1], prose(50)
    rows += [(None, a, "en", "s", 1), (None, b, None, None, None), (90, b, "en", "s", 1), (90, b, "en", "s", 1), (91, prose(60), "en", "r", 1), (91, prose(60), "en", "s", 2), (92, None, "en", "s", 1)]
    extra = ["id", "text_", "carry", "spans", "label", "class_id", "key", "digest", "sample", "rid", "n", "t", "l", "h"]
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, prose(40))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns, name
    got = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(k for k, _ in got if k is not None) == [*range(80), 90, 91] and sorted(t for k, t in got if k is None) == sorted([a, b])
    assert dict(got)[91] == min(r[1] for r in rows if r[0] == 91)
    assert p.run(spark, str(tmp_path)).count() == len(got)
