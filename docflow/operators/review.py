"""Human review: the audit sample, ground truth, evaluation, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.config import DEFAULT, Config
from docflow.functions.text import clean_text, ratio
from docflow.operators.screening import PAGE_KEY, latest_results
from docflow.operators.snapshots import segments


def sample_size(n: Column, config: Config = DEFAULT) -> Column:
    """Five percent, rounded half to even, at least 20 and at most 400, never more than there are."""
    return F.least(F.greatest(F.lit(config.audit_least), F.bround(n * F.lit(config.audit_share))).cast("long"), F.lit(config.audit_most), n).cast("long")


def review_reason(label: Column, confidence: Column, status: Column, config: Config = DEFAULT) -> Column:
    """Why a page must be reviewed; null for pages that are only sampled."""
    return F.when(F.coalesce(status != "success", F.lit(True)), "screening_failed").when(label == config.labels.unclear, "unclear").when(F.coalesce(confidence < config.low_confidence, F.lit(True)), "low_confidence")


def audit_sample(pool: DataFrame, stratum: str, key: list[str], seed: int = 42, config: Config = DEFAULT) -> DataFrame:
    """A fixed draw without replacement from each stratum, with its probability and weight.

    Rows are ordered by a hash of seed and key, which the planner limits before the shuffle at the largest sample size.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]).cast("binary"))
    sizes = pool.groupBy(stratum).agg(F.count(F.lit(1)).alias("pool_size"))
    w = Window.partitionBy(stratum).orderBy("__h", *key)
    ranked = pool.withColumn("__h", digest).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= config.audit_most)
    own = ranked.join(sizes, stratum).withColumn("sample_size", sample_size(F.col("pool_size"), config)).where("__r <= sample_size")
    p = F.col("sample_size").cast("double") / F.col("pool_size")
    return own.withColumn("sampling_probability", p).withColumn("sampling_weight", F.when(p > 0, 1 / p)).drop("__h", "__r", "sample_size", "pool_size")


def review_sheet(log: DataFrame, seed: int = 42, config: Config = DEFAULT) -> DataFrame:
    """All pages that must be reviewed, and samples of the confident positive and negative ones."""
    now = latest_results(log)
    reason = now.withColumn("review_reason", review_reason(F.col("label"), F.col("confidence"), F.col("status"), config))
    must = reason.where(F.col("review_reason").isNotNull()).withColumns({"sampling_probability": F.lit(1.0), "sampling_weight": F.lit(1.0)})
    rest = reason.where(F.col("review_reason").isNull() & F.col("label").isin(config.labels.positive, config.labels.negative))
    drawn = audit_sample(rest, "label", PAGE_KEY, seed, config).withColumn("review_reason", F.when(F.col("label") == config.labels.positive, "positive_audit").otherwise("negative_audit"))
    return must.unionByName(drawn, allowMissingColumns=True).withColumnRenamed("label", "predicted_label")


def ground_truth(review: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The review with ground_truth_label and exclusion_reason; exactly one of them is set."""
    status, predicted, reviewed = clean_text("review_status"), clean_text("predicted_label"), clean_text("reviewed_label")
    allowed = list(config.labels.allowed)
    accepted, corrected = status == "accepted", status == "corrected"
    label = F.when(accepted & predicted.isin(allowed), predicted).when(corrected & reviewed.isin(allowed), reviewed)
    reason = F.when(accepted, "invalid_predicted_label").when(corrected, "missing_or_invalid_reviewed_label").when(status.isin("unreadable", "out_of_scope"), status).otherwise("incomplete_review")
    return review.withColumn("ground_truth_label", label).withColumn("exclusion_reason", F.when(F.col("ground_truth_label").isNull(), reason))


def nested_ground_truth(truth: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One document for each master index: its reviewed pages and the runs of positive ones."""
    kept = truth.where(F.col("ground_truth_label").isNotNull()).withColumn("ordinal", F.xxhash64("pdf_path_in_zip", "page_number"))
    pages = kept.groupBy("masterindex_id").agg(F.count(F.lit(1)).alias("reviewed_page_count"), F.array_sort(F.collect_list(F.struct(F.col("page_number").alias("page"), F.col("pdf_path_in_zip"), F.col("ground_truth_label").alias("label")))).alias("pages"))
    runs = segments(kept, "masterindex_id", "page_number", F.col("ground_truth_label") == config.labels.positive, "pdf_path_in_zip")
    listed = runs.groupBy("masterindex_id").agg(F.array_sort(F.collect_list(F.struct("start_page", "end_page"))).alias("positive_segments"))
    empty = F.array().cast("array<struct<start_page:bigint,end_page:bigint>>")
    return pages.join(listed, "masterindex_id", "left").select("masterindex_id", F.lit("human_reviewed_pages_only").alias("ground_truth_scope"), "reviewed_page_count", "pages", F.coalesce(F.col("positive_segments").cast("array<struct<start_page:bigint,end_page:bigint>>"), empty).alias("positive_segments"))


def metrics(rows: DataFrame, predicted: str = "predicted_label", actual: str = "ground_truth_label", config: Config = DEFAULT) -> DataFrame:
    """(metric, value, numerator, denominator, scope): thirteen rows from one aggregation.

    Only rows with a positive or negative truth count. An unclear prediction of a positive page is a miss; of a negative page it
    is in no cell of the matrix.
    """
    pos, neg, unclear = config.labels.positive, config.labels.negative, config.labels.unclear
    p, a = F.col(predicted), F.col(actual)
    counts = rows.where(a.isin(pos, neg)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if((p == pos) & (a == pos)).alias("tp"), F.count_if((p == pos) & (a == neg)).alias("fp"), F.count_if(~p.eqNullSafe(F.lit(pos)) & (a == pos)).alias("fn"),
        F.count_if((p == neg) & (a == neg)).alias("tn"), F.count_if(p == unclear).alias("unclear"), F.count_if(p == a).alias("correct"),
    )
    c = F.col
    precision, recall = ratio(c("tp"), c("tp") + c("fp")), ratio(c("tp"), c("tp") + c("fn"))
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(2 * precision * recall / F.nullif(precision + recall, F.lit(0.0)))

    def row(name, value, numerator=None, denominator=None):
        whole = lambda x: (F.lit(None) if x is None else x).cast("long")
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), whole(numerator).alias("numerator"), whole(denominator).alias("denominator"), F.lit("human_reviewed_pages_only").alias("scope"))

    def share(name, part, whole):
        return row(name, ratio(part, whole), part, whole)

    count = lambda name, x: row(name, x, x, c("n"))
    listed = [
        count("evaluated_pages", c("n")), count("true_positive", c("tp")), count("false_positive", c("fp")), count("false_negative", c("fn")), count("true_negative", c("tn")), count("unclear_predictions", c("unclear")), count("correct_predictions", c("correct")),
        share("precision", c("tp"), c("tp") + c("fp")), share("recall", c("tp"), c("tp") + c("fn")), row("f1", f1), share("accuracy", c("correct"), c("n")), share("specificity", c("tn"), c("tn") + c("fp")), share("unclear_rate", c("unclear"), c("n")),
    ]
    return counts.select(F.inline(F.array(*listed)))


def errors(rows: DataFrame, predicted: str = "predicted_label", actual: str = "ground_truth_label", config: Config = DEFAULT) -> DataFrame:
    """Evaluated rows whose prediction differs."""
    return rows.where(F.col(actual).isin(config.labels.positive, config.labels.negative) & ~F.col(predicted).eqNullSafe(F.col(actual)))


def retention_plan(pages: DataFrame, now: Column, config: Config = DEFAULT, exists: Column | None = None) -> DataFrame:
    """deletion_status of each page: nothing is deleted here; `to_delete` rows are for a caller to act on.

    pages: rendered_at_utc (text; without a zone it is UTC), image_path.
    """
    at = F.try_to_timestamp("rendered_at_utc")
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp(at)) / 86_400)
    there = F.lit(True) if exists is None else exists
    status = F.when(at.isNull(), "missing_timestamp").when(age < config.retention_days, "retention_not_reached").when(~there, "already_missing").otherwise("to_delete")
    return pages.withColumn("age_days", age.cast("long")).withColumn("retention_days", F.lit(config.retention_days)).withColumn("deletion_status", status)
