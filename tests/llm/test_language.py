"""Held-out accuracy on invented languages, filters against sets, defined results."""

import random
import zlib

import numpy as np
import pytest

from docflow.llm import language as g

SYLLABLES = {"aa": ["the", "ing", "wh", "er", "on"], "bb": ["sch", "ung", "ein", "ä", "ie"], "cc": ["que", "eau", "é", "ou", "tion"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows():
    rng = random.Random(6)
    langs = sorted(SYLLABLES)
    return [(k, text(rng, langs[k % 3], rng.randint(3, 40)), None if k % 7 == 0 else langs[k % 3]) for k in range(600)]


def held(k):
    return zlib.crc32(str(k).encode()) % 4 == 2


def test_held_out_accuracy(spark, tmp_path):
    spark.createDataFrame(rows(), "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in g.op7_language_id(spark, str(tmp_path)).collect()}
    assert all(r.held_out == held(k) for k, r in out.items())
    right = [out[k].lang_pred == sorted(SYLLABLES)[k % 3] for k, _, _ in rows() if held(k)]
    assert np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in out.values())


def test_labels_of_held_out_rows_are_not_read(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    changed = df.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(doc_id as string)) % 4 = 2 THEN 'zz' ELSE lang END AS lang")
    a, b = g.fit(df), g.fit(changed)
    assert a.languages == b.languages and (a.table == b.table).all()


def test_filters_hold_what_they_learned():
    rng = random.Random(1)
    kept = {f"l{k:02d}": [rng.getrandbits(63) for _ in range(200)] for k in range(70)}
    filters = g.Filters.build(kept)
    assert filters.table.shape[1] == 2
    for l, name in enumerate(filters.languages):
        mask = filters.masks(np.array(kept[name], dtype=np.uint64))
        assert ((mask[:, l // 64] >> np.uint64(l % 64)) & np.uint64(1)).all()
    fresh = filters.masks(np.array([rng.getrandbits(63) for _ in range(20_000)], dtype=np.uint64))
    rate = ((fresh[:, 0] >> np.uint64(5)) & np.uint64(1)).mean()
    assert abs(rate - filters.false_rate[5]) < 0.01


def test_defined_results(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "日本"), (5, "the whing"), (5, "the whing"), (6, "schung " * 100_000)], "doc_id long, text string").selectExpr("*", "'cc' as lang", "'x' as lang_pred", "1 as score")
    filters = g.fit(df)
    out = [(r.doc_id, r.lang_pred, r.score) for r in g.predict(odd, filters).collect()]
    assert [r[1] for r in out[:3]] == ["und"] * 3 and out[3][1:] == ("aa", 0.0)
    assert [r[1] for r in out[4:]] == ["aa", "aa", "bb"] and out[4] == out[5]
    kept = g.keep(odd, filters, least=0.3)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [5, 5, 6]
    assert g.keep(odd, filters, least=1.01).count() == 0
    none = g.fit(df.limit(0))
    assert none.languages == [] and {r.lang_pred for r in g.predict(odd, none).collect()} == {"und"}
    assert g.predict(odd.limit(0), filters).count() == 0


def test_keep_rejects_noise_and_unlearned_languages(spark):
    rng = random.Random(3)
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    letters = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n))
    noise = [letters(n) for n in (4, 12, 60, 400)] + [" ".join(rng.choice(["kala", "metsä", "yliopisto", "koivu", "järvi"]) for _ in range(n)) for n in (4, 60)]
    noise += ["собака кошка дом", "日本", "123 !!", "", "x"]
    good = [text(rng, lang, n) for lang in SYLLABLES for n in (4, 12, 60, 400) for _ in range(20)]
    # A text in two learned languages is no noise.
    good.append(text(rng, "aa", 200) + " " + text(rng, "bb", 200))
    odd = spark.createDataFrame([(k, t) for k, t in enumerate([*good, *noise, None])], "doc_id long, text string")
    assert sorted(r.doc_id for r in g.keep(odd, g.fit(df, bounds=True)).collect()) == list(range(len(good)))


def test_bounds_leave_filters_alone(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    a, b = g.fit(df), g.fit(df, bounds=True)
    assert a.languages == b.languages and (a.table == b.table).all() and a.bounds is None and b.bounds.shape == (3,) and (b.bounds > 0).all()
    short = g.fit(df.selectExpr("doc_id", "substring(text, 1, 5) AS text", "lang"), bounds=True)
    assert np.isfinite(short.bounds).all()
    few = g.fit(df.where("doc_id < 2"), bounds=True)
    assert np.isfinite(few.bounds).all() and g.fit(df.limit(0), bounds=True).bounds.shape == (3,)


def test_a_tie_is_not_determined():
    keys = np.concatenate([k for k, _ in g.grams(*g._codes(["the whing"]))]).tolist()
    filters = g.Filters.build({"aa": keys, "bb": keys})
    assert filters.predict(["the whing"]) == (["aa"], [0.5]) and not filters.determined(["the whing"], 0.5)[0]


def test_every_label_is_learned(spark):
    rng = random.Random(4)
    own = {f"l{k:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(6)] for k in range(70)}
    sets = [(k, name, " ".join(rng.choice(words) for _ in range(30))) for k, (name, words) in enumerate([x for x in own.items() for _ in range(12)])]
    # The last labels are the rarest.
    df = spark.createDataFrame([r for r in sets if r[1] < "l64" or r[0] % 12 < 9], "doc_id long, lang string, text string")
    filters = g.fit(df)
    assert filters.languages == sorted(own)
    assert {r.lang for r in g.predict(df, filters).join(df, "doc_id").where("lang = lang_pred").select("lang").distinct().collect()} == set(own)
    with pytest.raises(ValueError):
        g.fit(df, max_languages=69)


def strings(t):
    """The n-grams of a text as strings, border as a space."""
    code = "".join(c if c.isalpha() else " " for c in (t or "").lower())
    code = " ".join(["", *code.split(), ""]) if code.strip() else ""
    for n in g.SIZES:
        for i in range(len(code) - n + 1):
            x = code[i : i + n]
            if x.strip() and " " not in x[1:-1]:
                yield x


def hashed(x):
    key = len(x)
    for c in x:
        key = key * 0x100000001B3 % 2**64 ^ (1 if c == " " else ord(c))
    return key


def test_counts_correction_and_score_by_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    filters = g.fit(df, sample_rows=10_000)
    seen = {}
    for k, t, lang in data:
        if lang and not held(k):
            for x in strings(t):
                seen.setdefault(lang, {}).setdefault(x, 0)
                seen[lang][x] += 1
    part = {lang: {x: n / sum(own.values()) for x, n in own.items()} for lang, own in seen.items()}
    kept = {lang: {x for x, p in own.items() if p >= 2e-5 and p >= 0.35 * max(o.get(x, 0) for o in part.values())} for lang, own in part.items()}
    bits = len(filters.table).bit_length() - 1
    slots = {lang: [{hashed(x) * m % 2**64 >> 64 - bits for x in own} for m in g._MULTIPLIERS] for lang, own in kept.items()}
    whole = {lang: slots[lang][0] | slots[lang][1] for lang in kept}
    assert filters.languages == sorted(kept)
    rates = [(len(whole[lang]) / len(filters.table)) ** 2 for lang in sorted(kept)]
    assert np.allclose(filters.false_rate, rates)
    texts = [t for _, t, _ in data[:80]] + ["the 日本 sch", "x", "1 2", ""]
    for t, name, score in zip(texts, *filters.predict(texts), strict=True):
        own = list(strings(t))
        counts = [sum(all(hashed(x) * m % 2**64 >> 64 - bits in whole[lang] for m in g._MULTIPLIERS) for x in own) for lang in sorted(kept)]
        right = [max((c - len(own) * p) / (1 - p), 0) for c, p in zip(counts, rates, strict=True)]
        if not own:
            assert (name, score) == ("und", 0.0)
        else:
            assert name == sorted(kept)[int(np.argmax(right))] and abs(score - (max(right) / sum(right) if sum(right) else 0)) < 1e-9


def test_whole_texts_are_learned(spark):
    """What stands behind a long beginning is learned as well."""
    late = [(k, "the ing " * 6_000 + "zyzzyva " * 40, "aa") for k in range(0, 40)] + [(k, "sch ung " * 50, "bb") for k in range(40, 80)]
    filters = g.fit(spark.createDataFrame(late, "doc_id long, text string, lang string"))
    assert filters.predict(["zyzzyva"])[0] == ["aa"] and filters.predict(["zyzzyva"])[1][0] > 0.9


@pytest.mark.skipif(not __import__("os").path.exists("/root/testdata/sf0.01/documents.parquet"), reason="no test tables")
def test_accuracy_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = g.op7_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(out) > 200 and np.mean([r.lang == r.lang_pred for r in out]) > 0.99
    assert g.keep(docs, g.fit(docs, bounds=True)).count() >= 0.995 * docs.count()
