"""Read-only profiles of the workflow history; each returns one DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.config import DEFAULT, Config
from docflow.functions.text import has_text, norm_key, percent, text_number
from docflow.operators.snapshots import latest, ranked_one, state_snapshot
from docflow.plans.workflow import DOCUMENT_KEY, LABEL_ORDER, label_rows, label_tier, qa_workers

ENTRY_KEY = [*DOCUMENT_KEY, "entry_id"]


def _n():
    return F.count(F.lit(1))


def schemas(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(table, column, type) of the given tables."""
    return [(name, c, kind) for name, df in sorted(tables.items()) for c, kind in df.dtypes]


def catalog_schemas(spark: SparkSession, schema: str | None = None) -> list[tuple[str, str, str]]:
    """(table, column, type) of all tables of a catalog schema, by the names in the catalog."""
    return schemas({t.name: spark.table(f"{schema}.{t.name}" if schema and not t.isTemporary else t.name) for t in spark.catalog.listTables(schema)})


def vocabulary(events: DataFrame) -> DataFrame:
    return events.groupBy("state", "component", "altered_by").agg(
        _n().alias("n_rows"), F.countDistinct("stack_id").alias("n_stacks"), F.min("entry_id").alias("min_entry_id"), F.max("entry_id").alias("max_entry_id"), F.min("entry_time").alias("first_seen"), F.max("entry_time").alias("last_seen")
    )


def workflow_paths(events: DataFrame, stacks: int = 100) -> DataFrame:
    """The events of the first stacks by id as one text each. The list of stacks is a report limit."""
    first = events.select("stack_id").distinct().orderBy("stack_id").limit(stacks)
    part = lambda c: F.coalesce(c, F.lit("<NULL>"))
    text = F.concat(F.col("entry_id").cast("string"), F.lit(": "), part("state"), F.lit(" / "), part("component"), F.lit(" / "), part("altered_by"))
    steps = events.join(first, "stack_id", "left_semi").select("stack_id", "entry_id", "entry_time", text.alias("step")).distinct()
    listed = steps.groupBy("stack_id").agg(F.sort_array(F.collect_list(F.struct("entry_id", "entry_time", "step"))).alias("s"))
    return listed.select("stack_id", F.array_join(F.transform("s", lambda x: x["step"]), " -> ").alias("workflow_path"))


def entry_distribution(events: DataFrame, above: int = 10) -> DataFrame:
    per = events.groupBy("stack_id").agg(F.countDistinct("entry_id").alias("n"), F.min("entry_id").alias("low"), F.max("entry_id").alias("high"))
    over = F.count_if(F.col("high") > above)
    return per.agg(
        _n().alias("n_stacks"), over.alias("stacks_with_entry_above"), percent(over, _n()).alias("pct_stacks_with_entry_above"), F.min("low").alias("global_min_entry_id"), F.max("high").alias("global_max_entry_id"),
        F.percentile_approx("n", 0.5, 1_000_000).alias("median_entries"), F.percentile_approx("n", 0.95, 1_000_000).alias("p95_entries"), F.max("n").alias("max_distinct_entries"),
    )


def chronology(events: DataFrame, config: Config = DEFAULT) -> DataFrame:
    s = config.states
    per = events.groupBy("stack_id").agg(F.min(F.when(F.col("state") == s.imported, F.col("entry_time"))).alias("a"), F.max(F.when(F.col("state") == s.exported, F.col("entry_time"))).alias("b"), F.count_if(F.col("state") == s.imported).alias("i"), F.count_if(F.col("state") == s.exported).alias("e"))
    both = (F.col("i") > 0) & (F.col("e") > 0)
    return per.agg(
        _n().alias("n_all_stacks"), F.count_if(F.col("i") > 0).alias("stacks_with_import"), F.count_if(F.col("e") > 0).alias("stacks_with_export"), F.count_if(both).alias("stacks_with_both"),
        F.count_if(both & (F.col("b") >= F.col("a"))).alias("chronologically_completed_stacks"), F.count_if(both & (F.col("b") < F.col("a"))).alias("invalid_export_before_import"),
    )


def code_grain(fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    per = label_rows(fields, config).groupBy(*ENTRY_KEY).agg(_n().alias("n"), F.countDistinct("field_value").alias("d"))
    return per.agg(_n().alias("n_document_entries"), F.count_if(F.col("n") > 1).alias("entries_with_repeated_rows"), F.count_if(F.col("d") > 1).alias("entries_with_conflicts"), F.max("n").alias("max_rows"), F.max("d").alias("max_values"))


def code_conflicts(fields: DataFrame, top: int = 500, config: Config = DEFAULT) -> DataFrame:
    per = label_rows(fields, config).groupBy(*ENTRY_KEY).agg(_n().alias("n_rows"), F.sort_array(F.collect_set("field_value")).alias("observed_values"))
    per = per.withColumn("n_values", F.size("observed_values").cast("long")).where("n_rows > 1 or n_values > 1")
    return per.orderBy(F.desc("n_values"), F.desc("n_rows"), *[F.col(c).asc_nulls_last() for c in ENTRY_KEY]).limit(top)


def last_entry_grain(documents: DataFrame) -> DataFrame:
    per = documents.where("last_entry = 1").groupBy(*DOCUMENT_KEY).agg(_n().alias("n"))
    return per.agg(_n().alias("n_final_document_keys"), F.count_if(F.col("n") > 1).alias("duplicated_final_document_keys"), F.max("n").alias("max_rows_per_key"))


def lookup_duplicates_all(lookup: DataFrame) -> DataFrame:
    """Repeated codes after normalisation; blank codes are listed too."""
    per = lookup.groupBy(norm_key("label_code").alias("normalized_code")).agg(_n().alias("n_rows"), F.sort_array(F.collect_set("category")).alias("categories"), F.sort_array(F.collect_set("class_name")).alias("classes"))
    return per.where("n_rows > 1")


def lookup_match(fields: DataFrame, lookup: DataFrame, config: Config = DEFAULT) -> DataFrame:
    seen = label_rows(fields, config).where(has_text("field_value")).select(norm_key("field_value").alias("c")).distinct()
    known = lookup.where(has_text("label_code")).select(norm_key("label_code").alias("c"), F.lit(1).alias("k")).distinct()
    hit = F.col("k").isNotNull()
    return seen.join(known, "c", "left").agg(_n().alias("n_observed_codes"), F.count_if(hit).alias("matched_codes"), F.count_if(~hit).alias("unmatched_codes"))


def _coded(fields: DataFrame, config: Config) -> DataFrame:
    return label_rows(fields, config).where(has_text("field_value")).select(*ENTRY_KEY).distinct()


def coverage_by_state(events: DataFrame, page_map: DataFrame, fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    entries = events.select("stack_id", "entry_id", "state", "component").distinct()
    rows = page_map.select(*ENTRY_KEY).distinct().join(entries, ["stack_id", "entry_id"]).join(_coded(fields, config).withColumn("k", F.lit(1)), ENTRY_KEY, "left")
    with_code = F.count("k")
    return rows.groupBy("state", "component").agg(_n().alias("n_snapshots"), with_code.alias("with_code"), (_n() - with_code).alias("without_code"), percent(with_code, _n()).alias("coverage_pct"))


def snapshot_or_delta(processes: DataFrame, page_map: DataFrame, fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Of documents on consecutive entries of a process: is the code repeated?"""
    group = ["stack_id", "process_id"]
    pairs = processes.select(*group, "entry_id").distinct().withColumn("next_id", F.lead("entry_id").over(Window.partitionBy(*group).orderBy("entry_id"))).where("next_id is not null")
    docs = page_map.select(*ENTRY_KEY).distinct()
    coded = _coded(fields, config)
    now = pairs.join(docs, [*group, "entry_id"])
    stable = now.join(docs.withColumnRenamed("entry_id", "next_id"), [*DOCUMENT_KEY, "next_id"], "left_semi")
    flagged = stable.join(coded.withColumn("c", F.lit(True)), ENTRY_KEY, "left").join(coded.withColumnRenamed("entry_id", "next_id").withColumn("n", F.lit(True)), [*DOCUMENT_KEY, "next_id"], "left")
    c, n = F.col("c").isNotNull(), F.col("n").isNotNull()
    both = F.count_if(c & n)
    return flagged.agg(_n().alias("n_pairs"), both.alias("both"), F.count_if(c & ~n).alias("current_only"), F.count_if(~c & n).alias("next_only"), F.count_if(~c & ~n).alias("neither"), percent(both, _n()).alias("repeated_pct"))


def qa_list(qa: DataFrame, top: int = 100) -> DataFrame:
    """The first QA rows in order of all their columns. The limit is the report's."""
    return qa.orderBy(*[F.col(c).asc_nulls_last() for c in qa.columns]).limit(top)


def verifiers(documents: DataFrame) -> DataFrame:
    return documents.groupBy("verified_by").agg(_n().alias("n_rows"), F.countDistinct("stack_id").alias("n_stacks"), F.min("entry_time").alias("first_seen"), F.max("entry_time").alias("last_seen"))


def _qa_rows(documents: DataFrame, qa: DataFrame) -> DataFrame:
    """Documents with each matching QA row; the list is not made distinct here."""
    known = qa.select(norm_key("id").alias("__q"), F.col("id").alias("qa_id"))
    return documents.join(known, norm_key("verified_by") == F.col("__q"), "left")


def verifier_match(documents: DataFrame, qa: DataFrame) -> DataFrame:
    rows, known = _qa_rows(documents, qa), F.col("qa_id").isNotNull()
    return rows.agg(_n().alias("n_rows"), F.count_if(has_text("verified_by")).alias("with_verifier"), F.count_if(known).alias("by_known_qa"), F.count_if(has_text("verified_by") & ~known).alias("by_others"))


def code_metadata(fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return label_rows(fields, config).groupBy("altered_by", "show_in_verifier", "action", "quality", "rating").agg(_n().alias("n_rows"), F.countDistinct("stack_id").alias("n_stacks"))


def _newest_codes(fields: DataFrame, config: Config, key: list[str], *first: str) -> DataFrame:
    return ranked_one(label_rows(fields, config), key, [latest(c) for c in (*first, *[x for x in LABEL_ORDER if x not in first])])


def export_coverage(events: DataFrame, documents: DataFrame, page_map: DataFrame, fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    export = state_snapshot(events, config.states.exported, last=True).select("stack_id", "entry_id")
    keys = page_map.join(export, ["stack_id", "entry_id"], "left_semi").select(*ENTRY_KEY).distinct()
    code = _newest_codes(fields, config, ENTRY_KEY).select(*ENTRY_KEY, "field_value", "show_in_verifier")
    docs = documents.select(*ENTRY_KEY, "verified_by", F.lit(1).alias("d"))
    rows = keys.join(code, ENTRY_KEY, "left").join(docs, ENTRY_KEY, "left")
    with_code = F.count("field_value")
    return rows.agg(
        _n().alias("n_keys"), with_code.alias("with_code"), (_n() - with_code).alias("without_code"), percent(with_code, _n()).alias("coverage_pct"), F.count("d").alias("with_document_row"),
        F.count_if(has_text("verified_by")).alias("with_verifier"), F.count_if(F.col("show_in_verifier") == 1).alias("shown_in_verifier"),
    )


def export_against_latest(events: DataFrame, fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    export = state_snapshot(events, config.states.exported, last=True).select("stack_id", "entry_id")
    at_export = _newest_codes(fields.join(export, ["stack_id", "entry_id"], "left_semi"), config, DOCUMENT_KEY).select(*DOCUMENT_KEY, F.col("field_value").alias("x"))
    newest = _newest_codes(fields, config, DOCUMENT_KEY, "entry_time", "entry_id").select(*DOCUMENT_KEY, F.col("field_value").alias("y"))
    x, y = norm_key("x"), norm_key("y")
    return at_export.join(newest, DOCUMENT_KEY, "left").agg(_n().alias("n_keys"), F.count_if(F.col("y").isNull()).alias("without_latest"), F.count_if(x == y).alias("equal"), F.count_if(x != y).alias("different"))


def evidence(events: DataFrame, documents: DataFrame, fields: DataFrame, qa: DataFrame, config: Config = DEFAULT) -> DataFrame:
    export = state_snapshot(events, config.states.exported, last=True).select("stack_id", "entry_id")
    code = _newest_codes(fields.join(export, ["stack_id", "entry_id"], "left_semi"), config, DOCUMENT_KEY).select(*ENTRY_KEY, "show_in_verifier")
    rows = _qa_rows(code.join(documents.select(*ENTRY_KEY, "verified_by"), ENTRY_KEY, "left"), qa)
    kind = F.when(F.col("qa_id").isNotNull(), "QA_VERIFIED_CANDIDATE").when(has_text("verified_by"), "OTHER_VERIFIED_CANDIDATE").when(F.col("show_in_verifier") == 1, "SHOWN_BUT_NOT_PROVEN_VERIFIED").otherwise("UNVERIFIED_EXPORT_CODE")
    return rows.groupBy(kind.alias("evidence_category")).agg(_n().alias("n_document_keys"), F.countDistinct("stack_id").alias("n_stacks"))


def image_ids(page_map: DataFrame) -> DataFrame:
    number = text_number("image_id")
    return page_map.agg(_n().alias("n_rows"), F.count_if(number.isNull() & F.col("image_id").isNotNull()).alias("non_numeric_rows"), F.countDistinct("image_id").alias("distinct_texts"), F.countDistinct(number).alias("distinct_numbers"))


def repeated_stages(events: DataFrame) -> DataFrame:
    per = events.groupBy("stack_id", "state", "component").agg(F.countDistinct("entry_id").alias("n"))
    return per.groupBy("state", "component").agg(_n().alias("n_groups"), F.count_if(F.col("n") > 1).alias("repeated_groups"), F.max("n").alias("max_occurrences"))


def repeated_keys(df: DataFrame, grain: list[str], top: int = 500) -> DataFrame:
    per = df.groupBy(*grain).agg(_n().alias("n_rows")).where("n_rows > 1")
    return per.orderBy(F.desc("n_rows"), *[F.col(c).asc_nulls_last() for c in grain]).limit(top)


def tier_share(events: DataFrame, documents: DataFrame, fields: DataFrame, qa: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Tiers of exported, non-blank codes; every such row counts."""
    export = state_snapshot(events, config.states.exported, last=True).select("stack_id", "entry_id")
    code = label_rows(fields, config).where(has_text("field_value")).join(export, ["stack_id", "entry_id"], "left_semi").select(*ENTRY_KEY, "field_value")
    rows = code.join(documents.select(*ENTRY_KEY, "verified_by"), ENTRY_KEY, "left").join(qa_workers(qa), norm_key("verified_by") == F.col("worker_id"), "left")
    tier = label_tier(F.col("field_value"), F.col("worker_id"), F.col("verified_by"), config)
    per = rows.groupBy(tier.alias("label_tier")).agg(_n().alias("n_rows"), F.countDistinct("stack_id").alias("n_stacks"))
    return per.withColumn("share_pct", F.round(100.0 * F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()), 2))


