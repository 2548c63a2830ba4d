"""The page pipeline in two phases, before and after human review. Stages exchange DataFrames; `files` writes what people edit."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.config import DEFAULT, Config
from docflow.operators import review, screening
from docflow.operators.checks import ContractError, require_columns

#: The columns of the review sheet: fixed values, in the order of the sheet.
REVIEW_COLUMNS = ["masterindex_id", "pdf_path_in_zip", "page_number", "source_page_number", "image_path", "image_sha256", "predicted_label", "confidence", "evidence", "status", "error", "needs_human_review", "attempt_count", "retry_count", "review_reason", "sampling_probability", "sampling_weight", "model_id", "temperature", "seed", "reviewed_label", "review_status", "reviewer", "review_comment"]
REVIEW_ORDER = ["masterindex_id", "pdf_path_in_zip", "page_number"]
TRUTH_COLUMNS = ["masterindex_id", "pdf_path_in_zip", "page_number", "source_page_number", "image_sha256", "predicted_label", "review_reason", "review_status", "ground_truth_label", "exclusion_reason"]


def reindexed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is null."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def review_workbook(log: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The sheet that people fill in: all its columns, in page order, nulls last."""
    return reindexed(review.review_sheet(log, config=config), REVIEW_COLUMNS).orderBy(*[F.col(c).asc_nulls_last() for c in REVIEW_ORDER])


def pre_review(pages: DataFrame, log: DataFrame | None, classify: Callable[[str], dict[str, Any]], append: Callable[[DataFrame], DataFrame], config: Config = DEFAULT) -> dict[str, DataFrame]:
    """Screens what has no success yet. `append` adds entries to the log, once, and returns the whole log with its `seq`."""
    require_columns(pages, [*screening.PAGE_KEY, "page_number", "image_path", "render_status", "quality_status"], "pages")
    todo = screening.pending(pages, log) if log is not None else screening.with_page_key(pages.where(F.col("page_number").isNotNull()))
    whole = append(screening.screen(todo, classify, config=config))
    return {"log": whole, "positive_pages": screening.positive_pages(whole, config), "review_queue": screening.review_queue(whole, config), "review_sheet": review_workbook(whole, config)}


def post_review(sheet: DataFrame, config: Config = DEFAULT) -> dict[str, DataFrame]:
    """Ground truth, excluded rows, nested documents, metrics and error rows of a reviewed sheet."""
    require_columns(sheet, ["masterindex_id", "pdf_path_in_zip", "page_number", "predicted_label", "reviewed_label", "review_status"], "review sheet")
    judged = review.ground_truth(sheet.withColumn("page_number", F.expr("cast(try_cast(page_number as double) as long)")), config)
    kept = judged.where(F.col("ground_truth_label").isNotNull())
    return {
        "ground_truth": reindexed(kept, TRUTH_COLUMNS),
        "excluded": reindexed(judged.where(F.col("ground_truth_label").isNull()), TRUTH_COLUMNS),
        "nested": review.nested_ground_truth(kept, config),
        "metrics": review.metrics(kept, config=config),
        "errors": review.errors(kept, config=config),
    }


def clean_up(pages: DataFrame, sheet: DataFrame, delete: Callable[[str], None] | None, now, config: Config = DEFAULT, *, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The deletion audit. Refused while a review is open; `delete` (off by default) is called on the executors for each due path.

    With `delete`, `store` must be given: it writes the audit, once, and returns the written table, so that looking at the audit
    deletes nothing and a path is reported by what happened to it.
    """
    open_rows = review.ground_truth(sheet, config).where(F.col("exclusion_reason") == "incomplete_review").limit(1).count()
    if open_rows:
        raise ContractError("the review is not complete")
    plan = review.retention_plan(pages, now, config)
    if delete is None:
        return plan
    if store is None:
        raise ValueError("deleting needs a store for its audit")
    schema = plan.schema

    def run(frames):
        for frame in frames:
            out = []
            for path, status in zip(frame["image_path"], frame["deletion_status"], strict=True):
                if status == "to_delete":
                    try:
                        delete(path)
                        status = "deleted"
                    except FileNotFoundError:
                        status = "already_missing"
                    except OSError as e:
                        status = f"delete_failed: {e}"
                out.append(status)
            frame["deletion_status"] = out
            yield frame

    return store(plan.mapInPandas(run, schema))
