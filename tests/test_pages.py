"""The page pipeline: logs, screening, sampling, ground truth, segments, metrics, files, stream."""

import json
import random
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions import text
from docflow.operators import pages, review, screening
from docflow.operators.snapshots import segments
from docflow.plans import page_pipeline
from docflow.sources import files
from docflow.streaming.log import screen_stream

LOG = "masterindex_id string, pdf_path_in_zip string, source_page_number long, page_number long, image_sha256 string, seq long, status string, label string, confidence double"


def test_latest_results_and_resume(spark):
    rows = [("m", "p", 1, 1, "h", 1, "failed", "unclear", None), ("m", "p", 1, 1, "h", 2, "success", "target", 0.9), ("m", "p", 2, 2, "", 3, "failed", "unclear", None), ("m", "p", 1, 1, "new", 4, "failed", "unclear", None), (None, "p", 1, 1, "h", 9, "success", "target", 0.9)]
    log = spark.createDataFrame(rows, LOG)
    assert sorted((r.source_page_number, r.image_sha256, r.status) for r in screening.latest_results(log).collect()) == [(1, "h", "success"), (1, "new", "failed"), (2, "NO_IMAGE", "failed")]
    assert sorted(r.image_sha256 for r in screening.pending(log.where("masterindex_id is not null").select(*screening.PAGE_KEY, "page_number").distinct(), log).collect()) == ["NO_IMAGE", "new"]
    assert [r.seq for r in screening.latest_results(log, screening.EXPORT_KEY).orderBy("page_number").collect()] == [4, 3]


@pytest.mark.parametrize(("label", "confidence", "status", "want"), [("target", 0.6, "success", False), ("target", 0.59, "success", True), ("target", None, "success", True), ("unclear", 0.9, "success", True), ("other", 0.9, "failed", True), ("other", 0.9, None, True)])
def test_needs_review(spark, label, confidence, status, want):
    df = spark.createDataFrame([(label, confidence, status)], "l string, c double, s string")
    assert df.select(screening.needs_review(F.col("l"), F.col("c"), F.col("s"))).first()[0] is want


def test_retries():
    waits, calls = [], []

    def flaky(image):
        calls.append(image)
        if len(calls) < 3:
            raise screening.ClassifierError("busy", retryable=True)
        return {"label": "target", "confidence": 1}

    got = screening.call_with_retries(flaky, "x", ("target",), None, waits.append)
    assert (got["status"], got["attempt_count"], got["retry_count"], waits) == ("success", 3, 2, [1.0, 2.0])
    calls.clear()

    def busy(image):
        raise screening.ClassifierError("busy", retryable=True)

    got = screening.call_with_retries(busy, "x", ("target",), None, waits.append)
    assert (got["status"], got["attempt_count"], got["retry_count"]) == ("failed", 5, 4)
    got = screening.call_with_retries(lambda i: {"label": "bogus", "confidence": 1}, "x", ("target",), None)
    assert (got["status"], got["attempt_count"]) == ("failed", 1)
    got = screening.call_with_retries(lambda i: 1 / 0, "x", ("target",), None)
    assert got["evidence"] == "unexpected_screening_failure"


PAGES = "masterindex_id string, pdf_path_in_zip string, source_page_number long, page_number long, image_sha256 string, image_path string, render_status string, quality_status string"


def classifier():
    def classify(image):
        if image == "bad":
            raise screening.ClassifierError("no answer")
        return {"label": "target" if image == "good" else "other", "confidence": 0.9}

    return classify


def test_screen_gates_pages(spark):
    rows = [("m", "p", 1, 1, "h", "good", "rendered", "usable"), ("m", "p", 2, 2, "h", "bad", "rendered", "usable"), ("m", "p", 3, 3, "h", "good", "failed", "usable"), ("m", "p", 4, 4, "h", "good", "rendered", "too_small"), ("m", "p", 5, 5, "h", "no", "rendered", "usable")]
    out = {r.page_number: (r.status, r.label, r.needs_human_review, r.attempt_count) for r in screening.screen(spark.createDataFrame(rows, PAGES), classifier()).collect()}
    assert out == {1: ("success", "target", False, 1), 2: ("failed", "unclear", True, 1), 3: ("render_failed", "unclear", True, 0), 4: ("quality_rejected", "unclear", True, 0), 5: ("success", "other", False, 1)}


def test_screening_stream_resumes(spark, tmp_path):
    rows = [("m", "p", 1, 1, "h", "good", "rendered", "usable"), ("m", "p", 2, 2, "h", "bad", "rendered", "usable")]
    for k in range(2):
        spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(PAGES).parquet(str(tmp_path / "in"))
        screen_stream(stream, str(tmp_path / "log"), str(tmp_path / "state"), classifier()).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log"))
    assert sorted((r.page_number, r.status) for r in log.collect()) == [(1, "success"), (2, "failed"), (2, "failed")]


@pytest.mark.parametrize(("n", "want"), [(1, 1), (5, 5), (20, 20), (50, 20), (400, 20), (410, 20), (430, 22), (1000, 50), (20000, 400)])
def test_sample_size(spark, n, want):
    assert spark.range(1).select(review.sample_size(F.lit(n).cast("long"))).first()[0] == want


def test_audit_sample_weights(spark):
    pool = spark.range(1000).select(F.when(F.col("id") < 950, "a").otherwise("b").alias("s"), "id")
    out = review.audit_sample(pool, "s", ["id"]).groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum("sampling_weight").alias("w")).collect()
    assert {r.s: (r.n, round(r.w, 6)) for r in out} == {"a": (48, 950.0), "b": (20, 50.0)}
    assert review.audit_sample(pool.limit(0), "s", ["id"]).count() == 0


def test_ground_truth_table(spark):
    rows = [("accepted", "target", None, "target", None), (" Accepted ", "bogus", None, None, "invalid_predicted_label"), ("corrected", "target", " OTHER", "other", None), ("corrected", "target", "", None, "missing_or_invalid_reviewed_label"), ("unreadable", "target", "other", None, "unreadable"), ("out_of_scope", "target", "other", None, "out_of_scope"), (None, "target", "other", None, "incomplete_review"), (" accepted\t", "unclear", None, "unclear", None)]
    df = spark.createDataFrame([(k, *r[:3]) for k, r in enumerate(rows)], "k int, review_status string, predicted_label string, reviewed_label string")
    out = review.ground_truth(df).orderBy("k").collect()
    assert [(r.ground_truth_label, r.exclusion_reason) for r in out] == [r[3:] for r in rows]


def runs(rows):
    out, current = [], None
    for page, pdf, on in rows:
        if on and current and page == current[1] + 1 and pdf == current[2]:
            current[1] = page
        elif on:
            current = [page, page, pdf]
            out.append(current)
        else:
            current = None
    return sorted((a, b) for a, b, _ in out)


def test_segments_against_a_loop(spark):
    rng, rows, want = random.Random(5), [], []
    for g in range(60):
        own = sorted(((rng.randint(1, 9), rng.choice("xy"), k, rng.random() < 0.7) for k in range(rng.randint(0, 9))), key=lambda r: (r[0], r[1], r[2]))
        rows += [(g, p, f, k, on) for p, f, k, on in own]
        # A repeated page or another file ends a run, as the row before it in order is no direct predecessor.
        want += [(g, a, b) for a, b in runs([(p, f, on) for p, f, k, on in own])]
    df = spark.createDataFrame(rows, "g int, page int, pdf string, ordinal int, positive boolean")
    got = sorted((r.g, r.start_page, r.end_page) for r in segments(df, "g", "page", F.col("positive"), "pdf").collect())
    assert got == sorted(want)


def test_metrics(spark):
    rows = [("target", "target"), ("target", "other"), ("unclear", "target"), ("unclear", "other"), ("other", "other"), ("target", "unclear"), ("target", None)]
    out = {r.metric: (r.value, r.numerator, r.denominator) for r in review.metrics(spark.createDataFrame(rows, "predicted_label string, ground_truth_label string")).collect()}
    assert len(out) == 13 and out["precision"] == (0.5, 1, 2) and out["recall"] == (0.5, 1, 2) and out["f1"] == (0.5, None, None)
    assert out["accuracy"] == (0.4, 2, 5) and out["specificity"] == (0.5, 1, 2) and out["unclear_rate"] == (0.4, 2, 5)
    none = {r.metric: r.value for r in review.metrics(spark.createDataFrame([], "predicted_label string, ground_truth_label string")).collect()}
    assert len(none) == 13 and set(none.values()) == {0.0}


def test_retention(spark):
    rows = [("2024-01-01T00:00:01", "a"), ("2024-01-01T00:00:00", "b"), ("nonsense", "c"), (None, "d"), ("2023-12-31T23:00:00-01:00", "gone")]
    df = spark.createDataFrame(rows, "rendered_at_utc string, image_path string")
    out = review.retention_plan(df, F.lit(datetime(2024, 1, 31)), exists=F.col("image_path") != "gone").collect()
    assert [r.deletion_status for r in out] == ["retention_not_reached", "to_delete", "missing_timestamp", "missing_timestamp", "already_missing"]


def test_inventory_and_numbering(spark):
    members = spark.createDataFrame([("m", "z", "a/b/2.pdf"), ("m", "z", "a/b/1.PDF"), ("m", "z", "a/b/x.txt"), ("n", "z", None)], "masterindex_id string, zip_path string, path string")
    out = [(r.masterindex_id, r.pdf_filename, r.pdf_order_in_masterindex, r.pdf_count_in_masterindex, r.status) for r in pages.inventory(members).orderBy("masterindex_id", "pdf_order_in_masterindex").collect()]
    assert out == [("m", "1.PDF", 1, 2, "ready"), ("m", "2.pdf", 2, 2, "ready"), ("n", None, None, 0, "missing_pdf")]
    assert pages.wrapper_depth(spark.createDataFrame([("a/b/c/x.pdf",), ("a/b/d/y.pdf",)], "path string")) == 2
    assert pages.wrapper_depth(spark.createDataFrame([("a/x.pdf",)], "path string")) == 0
    assert pages.wrapper_depth(spark.createDataFrame([], "path string")) == 0
    df = spark.createDataFrame([("m", 1, "p", 1), ("m", 1, "p", 2), ("m", 2, "q", None), ("m", 3, "r", 1)], "masterindex_id string, pdf_order_in_masterindex int, pdf_path_in_zip string, source_page_number int")
    assert sorted((r.pdf_path_in_zip, r.page_number or 0) for r in pages.number_pages(df).collect()) == [("p", 1), ("p", 2), ("q", 0), ("r", 3)]


@pytest.mark.parametrize(("w", "h", "want"), [(595.0, 842.0, 200 / 72), (100.0, 100.0, 10.24), (100.0, 1000.0, 2.4), (0.0, 5.0, 200 / 72), (1000.0, 1000.0, 2.4)])
def test_page_zoom(spark, w, h, want):
    assert spark.range(1).select(pages.page_zoom(F.lit(w), F.lit(h))).first()[0] == pytest.approx(want)


def test_render_isolates_broken_documents(spark):
    def renderer(content):
        if content == b"bad":
            raise ValueError("broken")
        return [{"source_page_number": k + 1, "render_status": "rendered"} for k in range(len(content))]

    df = spark.createDataFrame([("m", "a", bytearray(b"xy")), ("m", "b", bytearray(b"bad"))], "masterindex_id string, pdf_path_in_zip string, content binary")
    out = pages.render(df, renderer, "masterindex_id string, pdf_path_in_zip string, source_page_number int, render_status string, error string").collect()
    assert sorted((r.pdf_path_in_zip, r.source_page_number or 0, r.render_status) for r in out) == [("a", 1, "rendered"), ("a", 2, "rendered"), ("b", 0, "pdf_open_failed")]


def test_text_functions(spark):
    df = spark.createDataFrame([("\t a ", " Yes\n", "Ä/x.y-z_"), (None, "0", "__"), ("  ", None, None)], "a string, b string, c string")
    out = df.select(text.norm_key("a").alias("n"), text.has_text("a").alias("h"), text.clean_text("a").alias("c"), text.to_boolean("b").alias("b"), text.safe_folder_name("c").alias("f")).collect()
    assert [tuple(r) for r in out] == [("\t A", True, "a", True, "x_y-z"), (None, False, "", False, "document"), ("", False, "", False, "document")]
    names = spark.createDataFrame([("a/b.tar.pdf",), (".pdf",), ("x",)], "p string").select(text.file_stem("p"), text.is_pdf("p"), text.file_name("p")).collect()
    assert [tuple(r) for r in names] == [("b.tar", True, "b.tar.pdf"), (".pdf", False, ".pdf"), ("x", False, "x")]
    numbers = spark.createDataFrame([("007",), ("ab",), ("1.7",), ("",)], "x string").select(text.text_number("x")).collect()
    assert [None if r[0] is None else int(r[0]) for r in numbers] == [7, None, 2, None]


def test_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/1.pdf", b"one")
        z.writestr("d/2.txt", b"two")
        z.writestr("e/", b"")
    listed = files.zip_members(spark, str(tmp_path / "*.zip"), suffix=".pdf").collect()
    assert [r.path for r in listed] == ["d/1.pdf"]
    whole = files.with_sha256(files.zip_members(spark, str(tmp_path / "*.zip"), content=True)).collect()
    assert {r.path: bytes(r.content) for r in whole} == {"d/1.pdf": b"one", "d/2.txt": b"two"} and all(len(r.sha256) == 64 for r in whole)
    (tmp_path / "log.jsonl").write_text("\n".join(['{"k": "007", "v": 1}', "", "{broken", '{"v": 2}', '{"k": "007", "v": 3}']))
    rows = files.read_json_log(spark, str(tmp_path / "log.jsonl"), T.StructType.fromDDL("k string, v int"), ["k"]).orderBy("seq").collect()
    assert [(r.k, r.v) for r in rows] == [("007", 1), ("007", 3)]
    df = spark.createDataFrame([("NA", "", 'a "b", c')], "a string, b string, c string")
    files.write_csv(df, str(tmp_path / "csv"))
    assert tuple(files.read_csv(spark, str(tmp_path / "csv"), ["a", "b", "c"]).first()) == (None, None, 'a "b", c')
    assert tuple(files.read_csv(spark, str(tmp_path / "csv"), ["a", "b", "c"], parse_na=False).first()) == ("NA", "", 'a "b", c')
    files.append_json(df, str(tmp_path / "json"))
    files.append_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    files.write_json(df, str(tmp_path / "json"))
    assert json.loads(spark.read.text(str(tmp_path / "json")).first()[0])["a"] == "NA"
    assert files.save_table(df, "docflow_files_test").count() == 1
    files.save_view(df, "docflow_view_test")
    assert spark.sql("SELECT * FROM docflow_view_test").count() == 1


def test_members_of_containers(spark, tmp_path):
    """Wrapper folders go, folders without a PDF stay, from the files to the inventory."""
    made = {
        "a.zip": ["w/v/M1/x/2.pdf", "w/v/M1/1.PDF", "w/v/M2/", "w/v/M3/note.txt", "w/v/M1/skip.txt", "other/x.txt"],
        "b.zip": ["M1/9.pdf", "M4/sub/8.pdf", "loose.txt"],
        "c.zip": ["only/text.txt", "empty/"],
        "d.zip": [],
    }
    for name, paths in made.items():
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for p in paths:
                z.writestr(p, b"")
    entries = files.zip_entries(spark, str(tmp_path / "*.zip"))
    assert sorted(r.path for r in entries.where("is_dir").collect()) == ["empty/", "w/v/M2/"]
    rows = pages.inventory(pages.members(entries)).collect()
    got = [(r.masterindex_id, r.zip_path.rpartition("/")[2], r.pdf_path_in_zip, r.pdf_order_in_masterindex, r.pdf_count_in_masterindex, r.status) for r in rows]
    want = [
        ("M1", "b.zip", "M1/9.pdf", 1, 3, "ready"), ("M1", "a.zip", "w/v/M1/1.PDF", 2, 3, "ready"), ("M1", "a.zip", "w/v/M1/x/2.pdf", 3, 3, "ready"), ("M2", "a.zip", None, None, 0, "missing_pdf"),
        ("M3", "a.zip", None, None, 0, "missing_pdf"), ("M4", "b.zip", "M4/sub/8.pdf", 1, 1, "ready"), ("only", "c.zip", None, None, 0, "missing_pdf"), ("empty", "c.zip", None, None, 0, "missing_pdf"),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    one = spark.createDataFrame([("z", "a/M/x.pdf", False)], "zip_path string, path string, is_dir boolean")
    assert [r.masterindex_id for r in pages.members(one).collect()] == ["M"] and pages.members(one.limit(0)).count() == 0


def test_image_quality_from_pixels(spark):
    import numpy as np

    greys = {b"small": np.zeros((600, 400)), b"white": np.full((600, 700), 255), b"flat": np.full((600, 700), 90), b"good": np.arange(420_000).reshape(600, 700) % 250}
    df = spark.createDataFrame([(k, bytearray(x)) for k, x in enumerate([*greys, b"broken"])] + [(9, None)], "id int, content binary")
    got = {r.id: (r.quality_status, r.width, r.height, r.file_size) for r in pages.image_quality(df, lambda data: greys[data]).collect()}
    assert got == {0: ("too_small", 400, 600, 5), 1: ("likely_blank", 700, 600, 5), 2: ("low_contrast", 700, 600, 4), 3: ("usable", 700, 600, 4), 4: ("corrupt", None, None, None), 9: ("corrupt", None, None, None)}


def test_clean_up_deletes_once(spark, tmp_path):
    paths = [str(tmp_path / f"{k}.png") for k in range(3)]
    for p in paths[:2]:
        open(p, "w").close()
    listed = spark.createDataFrame([(p, "2020-01-01T00:00:00") for p in paths], "image_path string, rendered_at_utc string")
    sheet = spark.createDataFrame([("accepted", "target", None)], "review_status string, predicted_label string, reviewed_label string")

    def store(df):
        df.write.parquet(str(tmp_path / "audit"))
        return spark.read.parquet(str(tmp_path / "audit"))

    import os

    audit = page_pipeline.clean_up(listed, sheet, os.remove, F.lit("2024-01-01 00:00:00").cast("timestamp"), store=store)
    for _ in range(2):
        assert sorted(r.deletion_status for r in audit.collect()) == ["already_missing", "deleted", "deleted"]
    with pytest.raises(ValueError):
        page_pipeline.clean_up(listed, sheet, os.remove, F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_review_workbook_columns_and_order(spark):
    log = spark.createDataFrame([("m2", "a", 1, 1, "h", 1, "failed", "unclear", None, "e", 2, 1, "x"), ("m1", "a", 2, 2, "h", 2, "failed", "unclear", None, "e", 2, 1, "x"), ("m1", "a", 1, None, "h", 3, "failed", "unclear", None, "e", 2, 1, "x")], "masterindex_id string, pdf_path_in_zip string, source_page_number long, page_number long, image_sha256 string, seq long, status string, label string, confidence double, error string, attempt_count int, retry_count int, model_id string")
    book = page_pipeline.review_workbook(log)
    assert book.columns == page_pipeline.REVIEW_COLUMNS and len(book.columns) == 24
    assert [(r.masterindex_id, r.page_number, r.error, r.attempt_count, r.model_id, r.seed) for r in book.collect()] == [("m1", 2, "e", 2, "x", None), ("m1", None, "e", 2, "x", None), ("m2", 1, "e", 2, "x", None)]
