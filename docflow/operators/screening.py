"""Page screening: gating, an injected classifier with retries, the result log, review flags, exports."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.config import DEFAULT, Config
from docflow.operators.snapshots import latest, ranked_one

PAGE_KEY = ["masterindex_id", "pdf_path_in_zip", "source_page_number", "image_sha256"]
EXPORT_KEY = ["masterindex_id", "pdf_path_in_zip", "page_number"]
NO_IMAGE = "NO_IMAGE"
DELAYS = (1.0, 2.0, 4.0, 8.0)


class ClassifierError(Exception):
    """A failed call; `retryable` failures are tried again."""

    def __init__(self, message: str, retryable: bool = False):
        super().__init__(message)
        self.retryable = retryable


def with_page_key(df: DataFrame) -> DataFrame:
    """The image hash of the key: pages without an image share a mark."""
    return df.withColumn("image_sha256", F.coalesce(F.nullif("image_sha256", F.lit("")), F.lit(NO_IMAGE)))


def latest_results(log: DataFrame, key: list[str] = PAGE_KEY, order: str = "seq") -> DataFrame:
    """The last entry of each page. Entries without a complete key are no results."""
    whole = with_page_key(log) if "image_sha256" in key else log
    for c in key:
        whole = whole.where(F.col(c).isNotNull())
    return ranked_one(whole, key, [latest(order)])


def pending(inventory: DataFrame, log: DataFrame) -> DataFrame:
    """Pages whose latest result is no success."""
    done = latest_results(log).where("status = 'success'").select(*PAGE_KEY)
    return with_page_key(inventory.where(F.col("page_number").isNotNull())).join(done, PAGE_KEY, "left_anti")


def needs_review(label: Column, confidence: Column, status: Column, config: Config = DEFAULT) -> Column:
    return F.coalesce(status != "success", F.lit(True)) | F.coalesce(label == config.labels.unclear, F.lit(False)) | F.coalesce(confidence < config.low_confidence, F.lit(True))


def gate(pages: DataFrame) -> DataFrame:
    """gate_status: render_failed, quality_rejected, or null for pages that go to the classifier."""
    return pages.withColumn("gate_status", F.when(F.coalesce(F.col("render_status") != "rendered", F.lit(True)), "render_failed").when(F.coalesce(F.col("quality_status") != "usable", F.lit(True)), "quality_rejected"))


def call_with_retries(classify: Callable[[str], dict[str, Any]], image: str, labels: tuple[str, ...], evidence: tuple[str, ...] | None, sleep: Callable[[float], None] = time.sleep) -> dict[str, Any]:
    """A validated answer with attempt counts. Invalid answers fail at once; retryable errors up to five attempts."""
    for attempt in range(1, len(DELAYS) + 2):
        try:
            got = classify(image)
            confidence = got.get("confidence")
            if got.get("label") not in labels or (evidence is not None and got.get("evidence") not in evidence) or not isinstance(confidence, int | float) or not 0 <= confidence <= 1:
                raise ClassifierError(f"invalid answer: {got}")
            return {"label": got["label"], "evidence": got.get("evidence"), "confidence": float(confidence), "status": "success", "error": None, "attempt_count": attempt, "retry_count": attempt - 1}
        except ClassifierError as e:
            if not e.retryable or attempt == len(DELAYS) + 1:
                return {"label": None, "evidence": "technical_failure", "confidence": None, "status": "failed", "error": str(e), "attempt_count": attempt, "retry_count": attempt - 1}
            sleep(DELAYS[attempt - 1])
        except Exception as e:  # noqa: BLE001 - a page's failure is a row, not the end of the run
            return {"label": None, "evidence": "unexpected_screening_failure", "confidence": None, "status": "failed", "error": f"{type(e).__name__}: {e}", "attempt_count": 1, "retry_count": 0}
    raise AssertionError


_RESULT = "label string, evidence string, confidence double, status string, error string, attempt_count int, retry_count int"


def screen(pages: DataFrame, classify: Callable[[str], dict[str, Any]], *, evidence: tuple[str, ...] | None = None, model_id: str = "stub", config: Config = DEFAULT, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """The log entries of pages (PAGE_KEY, page_number, image_path, render_status, quality_status).

    Only pages that pass the gate reach `classify`, in Arrow batches on the executors.
    """
    own = gate(pages)
    labels, unclear = config.labels.allowed, config.labels.unclear
    kept = [c for c in pages.columns]
    schema = pages.schema.simpleString()[len("struct<") : -1]

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            found = pd.DataFrame([call_with_retries(classify, p, labels, evidence, sleep) for p in frame["image_path"]], columns=["label", "evidence", "confidence", "status", "error", "attempt_count", "retry_count"])
            yield pd.concat([frame.reset_index(drop=True), found.assign(label=found.label.fillna(unclear))], axis=1)

    called = own.where("gate_status is null").select(*kept).mapInPandas(run, f"{schema}, {_RESULT}")
    held = own.where("gate_status is not null").select(*kept, F.lit(unclear).alias("label"), F.lit("not_screened").alias("evidence"), F.lit(None).cast("double").alias("confidence"), F.col("gate_status").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempt_count"), F.lit(0).alias("retry_count"))
    return called.unionByName(held).withColumn("needs_human_review", needs_review(F.col("label"), F.col("confidence"), F.col("status"), config)).withColumns({"model_id": F.lit(model_id), "temperature": F.lit(0.0), "seed": F.lit(42), "processed_at_utc": F.current_timestamp()})


def positive_pages(log: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Per master index: its positive pages that need no review, as a text of numbers in order."""
    now = latest_results(log, EXPORT_KEY)
    good = (F.col("status") == "success") & (F.col("label") == config.labels.positive) & ~needs_review(F.col("label"), F.col("confidence"), F.col("status"), config)
    pages = F.array_sort(F.collect_set("page_number"))
    return now.where(good).groupBy("masterindex_id").agg(F.concat_ws(", ", F.transform(pages, lambda p: p.cast("string"))).alias("pages"), F.size(pages).cast("long").alias("n_pages"))


def review_queue(log: DataFrame, config: Config = DEFAULT) -> DataFrame:
    now = latest_results(log, EXPORT_KEY)
    return now.where(needs_review(F.col("label"), F.col("confidence"), F.col("status"), config)).select(*EXPORT_KEY, "status", "label", "confidence")
