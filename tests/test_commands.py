"""The command line and the two phases of the page pipeline."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docflow.__main__ import main
from docflow.operators import checks
from docflow.operators.checks import ContractError
from docflow.plans import page_pipeline, profile
from docflow.sources.adapters import logical
from docflow.sources.files import save_table

DATA = "/root/testdata/sf0.001"
PAGES = "masterindex_id string, pdf_path_in_zip string, source_page_number long, page_number long, image_sha256 string, image_path string, render_status string, quality_status string"


def test_command_line(spark, capsys, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS docflow_cli")
    assert main(["docflow_cli", "--yes"]) == 1 and "missing inputs" in capsys.readouterr().err
    assert main(["a;b", "--yes"]) == 1
    for name in ("event", "document", "field", "page_map", "qa", "code_lookup"):
        df = logical(spark, DATA, name)
        if name == "page_map":
            # One mapping a page, so that the grain holds.
            df = df.where("image_id is not null").dropDuplicates(["stack_id", "process_id", "entry_id", "image_id"])
        save_table(df, f"docflow_cli.{name}")
    monkeypatch.setattr("builtins.input", lambda _: "n")
    assert main(["docflow_cli"]) == 0 and not spark.catalog.tableExists("docflow_cli.stack_summary")
    code = main(["docflow_cli", "--yes"])
    out = capsys.readouterr()
    assert code == 0, out.err
    assert spark.table("docflow_cli.stack_summary").count() == spark.table("docflow_cli.completed_stacks").count() > 0
    assert spark.table("training_pages").columns == spark.table("docflow_cli.page_labels").columns
    # The command works in its schema; its tables are described by the catalog.
    assert spark.catalog.currentDatabase().lower() == "docflow_cli"
    told = profile.catalog_schemas(spark, "docflow_cli")
    assert ("stack_summary", "stack_id", "string") in told and {t for t, _, _ in told} >= {"event", "page_labels"}
    spark.catalog.setCurrentDatabase("default")


def test_schema_and_output_checks(spark):
    with pytest.raises(ContractError):
        checks.use_schema(spark, "no_such_schema")
    with pytest.raises(ContractError):
        checks.require_output(spark, "default.no_such_table")
    spark.sql("CREATE DATABASE IF NOT EXISTS docflow_checks")
    assert checks.use_schema(spark, "docflow_checks") == "DOCFLOW_CHECKS" and spark.catalog.currentDatabase().lower() == "docflow_checks"
    spark.catalog.setCurrentDatabase("default")
    save_table(spark.range(3), "docflow_checks.t")
    assert checks.require_output(spark, "docflow_checks.t").count() == 3


def test_page_phases(spark, tmp_path):
    def classify(image):
        return {"label": "target" if image == "good" else "other", "confidence": 0.9}

    rows = [("m", "p", k, k, f"h{k}", "good" if k % 2 else "no", "rendered" if k != 7 else "failed", "usable") for k in range(30)]
    pages = spark.createDataFrame(rows, PAGES)

    def append(df):
        df.withColumn("seq", F.lit(1).cast("long")).write.mode("append").parquet(str(tmp_path / "log"))
        return spark.read.parquet(str(tmp_path / "log"))

    out = page_pipeline.pre_review(pages, None, classify, append)
    assert out["log"].count() == 30 and out["review_queue"].count() == 1 and out["positive_pages"].first().n_pages == 14
    sheet = out["review_sheet"]
    assert sheet.columns == page_pipeline.REVIEW_COLUMNS and sheet.count() == 30
    again = page_pipeline.pre_review(pages, out["log"], classify, append)
    assert again["log"].count() == 31
    with pytest.raises(ContractError):
        page_pipeline.clean_up(pages, sheet, None, F.lit(datetime(2024, 1, 31)))
    done = sheet.withColumn("review_status", F.when(F.col("status") == "success", "accepted").otherwise("unreadable"))
    truth = page_pipeline.post_review(done)
    assert truth["ground_truth"].count() == 29 and truth["excluded"].count() == 1 and truth["errors"].count() == 0
    assert {r.metric: r.value for r in truth["metrics"].collect()}["accuracy"] == 1.0
    nested = truth["nested"].first()
    assert nested.reviewed_page_count == 29 and len(nested.positive_segments) == 14
    old = tmp_path / "old.png"
    old.write_text("x")
    images = spark.createDataFrame([("2024-01-01T00:00:00", str(old)), ("2024-01-01T00:00:00", str(tmp_path / "none.png")), ("2024-01-30T00:00:00", "new")], "rendered_at_utc string, image_path string")

    def delete(path):
        import os

        os.unlink(path)

    def store(df):
        df.write.parquet(str(tmp_path / "audit"))
        return spark.read.parquet(str(tmp_path / "audit"))

    audit = page_pipeline.clean_up(images, done, delete, F.lit(datetime(2024, 1, 31)), store=store)
    for _ in range(2):
        assert sorted(r.deletion_status for r in audit.collect()) == ["already_missing", "deleted", "retention_not_reached"] and not old.exists()
