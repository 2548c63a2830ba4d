"""Workflow plans: completed stacks, final document and page labels, grouping changes, stack summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.config import DEFAULT, Config
from docflow.functions.text import has_text, non_blank, norm_key, seconds_between
from docflow.operators.snapshots import latest, ranked_one, state_snapshot

DOCUMENT_KEY = ["stack_id", "process_id", "doc_id", "subdoc_idx"]
GRAINS = {
    "completed_stacks": ["stack_id"],
    "document_labels": DOCUMENT_KEY,
    "page_labels": ["stack_id", "process_id", "export_entry_id", "image_id", "doc_id", "subdoc_idx"],
    "grouping_changes": ["stack_id", "process_id", "image_id"],
    "stack_summary": ["stack_id"],
}


def completed_stacks(events: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Stacks with an import and an export that does not precede it."""
    s = config.states
    is_import, is_export = F.col("state") == s.imported, F.col("state") == s.exported
    found = events.groupBy("stack_id").agg(
        F.min(F.when(is_import, F.col("entry_time"))).alias("first_import_time"),
        F.max(F.when(is_export, F.col("entry_time"))).alias("last_export_time"),
        F.count_if(is_import).alias("n_import_events"),
        F.count_if(is_export).alias("n_export_events"),
    )
    return found.where("n_import_events > 0 and n_export_events > 0 and last_export_time >= first_import_time")


def qa_workers(qa: DataFrame) -> DataFrame:
    return qa.where(has_text("id")).select(norm_key("id").alias("worker_id")).distinct()


def label_rows(fields: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return fields.where(norm_key("field_name") == config.label_field)


#: A total order of label rows: the newest first; the rest only breaks ties.
LABEL_ORDER = ("entry_time", "field_value", "altered_by", "show_in_verifier", "action", "quality", "rating")


def label_tier(code: Column, worker: Column, verifier: Column, config: Config = DEFAULT) -> Column:
    actor = norm_key(verifier)
    return (
        F.when(code.isNull(), "MISSING_CODE")
        .when(worker.isNotNull(), "QA_VERIFIED")
        .when(actor == config.system_actor, "SYSTEM_VERIFIED")
        .when(actor.startswith(config.service_prefix), "SERVICE_ACCOUNT")
        .when(has_text(verifier), "NON_QA_VERIFIER")
        .otherwise("MISSING_VERIFIER")
    )


def label_quality(tier: Column) -> Column:
    """A function of the tier alone."""
    return F.when(tier == "QA_VERIFIED", "GOLD").when(tier == "NON_QA_VERIFIER", "SILVER").when(tier == "SYSTEM_VERIFIED", "WEAK").otherwise("EXCLUDE")


def document_labels(events: DataFrame, documents: DataFrame, fields: DataFrame, lookup: DataFrame, qa: DataFrame, completed: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Each document of a stack's last export with its label, the label's meaning, tier and quality.

    The newest label row counts even if its value is blank. Null key parts never match.
    """
    export = state_snapshot(events, config.states.exported, last=True).select("stack_id", "entry_id", F.col("entry_time").alias("export_entry_time"))
    docs = documents.withColumnsRenamed({"altered_by": "document_altered_by", "entry_time": "document_entry_time"}).join(export, ["stack_id", "entry_id"])
    key = [*DOCUMENT_KEY, "entry_id"]
    own = label_rows(fields, config).join(export.select("stack_id", "entry_id"), ["stack_id", "entry_id"], "left_semi")
    newest = ranked_one(own, key, [latest(c) for c in LABEL_ORDER]).select(
        *key,
        non_blank("field_value").alias("label_code"),
        F.col("altered_by").alias("code_altered_by"),
        "show_in_verifier",
        F.col("action").alias("code_action"),
        F.col("quality").alias("code_quality"),
        F.col("rating").alias("code_rating"),
        F.col("entry_time").alias("code_entry_time"),
    )
    meaning = lookup.where(has_text("label_code")).select(norm_key("label_code").alias("normalized_code"), *config.lookup_columns)
    joined = (
        docs.join(newest, key, "left")
        .withColumn("__code", norm_key("label_code"))
        .withColumn("__actor", norm_key("verified_by"))
        .join(meaning, F.col("__code") == F.col("normalized_code"), "left")
        .join(qa_workers(qa), F.col("__actor") == F.col("worker_id"), "left")
        .join(completed.select("stack_id", F.lit(True).alias("__complete")), "stack_id", "left")
    )
    tier = label_tier(F.col("label_code"), F.col("worker_id"), F.col("verified_by"), config)
    return joined.withColumn("label_tier", tier).select(
        *DOCUMENT_KEY,
        F.col("entry_id").alias("export_entry_id"),
        "export_entry_time",
        "status",
        "document_altered_by",
        "remark",
        "doc_class",
        "export_name",
        "document_entry_time",
        "verified_by",
        "last_entry",
        "doc_state",
        "doc_substate",
        "label_code",
        "code_altered_by",
        "show_in_verifier",
        "code_action",
        "code_quality",
        "code_rating",
        "code_entry_time",
        *config.lookup_columns,
        F.col("label_code").isNotNull().alias("has_code"),
        F.col("normalized_code").isNotNull().alias("has_code_meaning"),
        F.col("__complete").isNotNull().alias("has_complete_workflow_history"),
        "label_tier",
        label_quality(F.col("label_tier")).alias("training_label_quality"),
    )


def training_documents(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("has_code") & F.col("training_label_quality").isin("GOLD", "SILVER"))


def page_labels(page_map: DataFrame, labels: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The pages of exports that have documents, each mapping with its document's label and the page's number of mappings."""
    from pyspark.sql import Window

    exports = labels.select("stack_id", F.col("export_entry_id").alias("entry_id")).distinct()
    w = Window.partitionBy("stack_id", "process_id", "entry_id", "image_id")
    pages = page_map.withColumnRenamed("entry_time", "page_entry_time").join(exports, ["stack_id", "entry_id"], "left_semi").withColumn("n_document_mappings_for_page", F.count(F.lit(1)).over(w)).withColumnRenamed("entry_id", "export_entry_id")
    carried = ["label_code", "label_tier", "training_label_quality", "has_code", "has_code_meaning", "has_complete_workflow_history", "doc_class", "verified_by", "code_altered_by", "show_in_verifier", "code_action", "code_quality", "code_rating", *config.lookup_columns]
    key = [*DOCUMENT_KEY, "export_entry_id"]
    return pages.join(labels.select(*key, *carried), key, "left").select(
        *DOCUMENT_KEY, "export_entry_id", "image_id", "seqno", "relation", "rotation", "page_entry_time", "n_document_mappings_for_page",
        (F.col("n_document_mappings_for_page") == 1).alias("has_unambiguous_document_mapping"), *carried,
    )


def training_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("has_unambiguous_document_mapping") & F.col("has_code") & F.col("training_label_quality").isin("GOLD", "SILVER"))


def grouping_changes(events: DataFrame, page_map: DataFrame, completed: DataFrame, labels: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Pages of completed stacks at the first analysis against the last export.

    Presence follows the image id, so a page without one counts as missing on its side. Null keys never match; the grouping
    itself is compared null-safe. Several mappings of a page multiply; the grain contract reports that.
    """
    s = config.states
    scoped = page_map.join(completed.select("stack_id"), "stack_id", "left_semi")

    def side(name: str, state: str, last: bool) -> DataFrame:
        at = state_snapshot(events, state, last=last).select("stack_id", "entry_id", F.col("entry_time").alias(f"{name}_entry_time"), F.col("component").alias(f"{name}_component"))
        rows = scoped.join(at, ["stack_id", "entry_id"])
        own = [F.col(c).alias(f"{name}_{c}") for c in ("stack_id", "process_id", "image_id", "entry_id", "doc_id", "subdoc_idx", "seqno", "rotation")]
        return rows.select(*own, f"{name}_entry_time", f"{name}_component")

    a, e = side("analyser", s.analysed, False), side("export", s.exported, True)
    keys = ("stack_id", "process_id", "image_id")
    match = [F.col(f"analyser_{k}") == F.col(f"export_{k}") for k in keys]
    both = a.join(e, match, "full")
    final = labels.select(*[F.col(c).alias(f"l_{c}") for c in (*DOCUMENT_KEY, "export_entry_id")], F.col("label_code").alias("final_code"), "label_tier", "training_label_quality")
    on = [F.col(f"export_{c}") == F.col(f"l_{c}") for c in DOCUMENT_KEY] + [F.col("export_entry_id") == F.col("l_export_entry_id")]
    joined = both.join(final, on, "left")
    has_a, has_e = F.col("analyser_image_id").isNotNull(), F.col("export_image_id").isNotNull()
    same = F.col("analyser_doc_id").eqNullSafe(F.col("export_doc_id")) & F.col("analyser_subdoc_idx").eqNullSafe(F.col("export_subdoc_idx"))
    return joined.select(
        *[F.coalesce(f"analyser_{k}", f"export_{k}").alias(k) for k in keys],
        "analyser_entry_id", "export_entry_id", "analyser_entry_time", "export_entry_time", "analyser_component",
        "analyser_doc_id", "analyser_subdoc_idx", "export_doc_id", "export_subdoc_idx", "analyser_seqno", "export_seqno", "analyser_rotation", "export_rotation",
        F.when(has_a & has_e, "BOTH").when(has_a, "ANALYSER_ONLY").otherwise("EXPORT_ONLY").alias("page_presence"),
        F.when(has_a & has_e, same).alias("same_grouping"),
        F.when(~has_a, "ADDED_AT_EXPORT").when(~has_e, "REMOVED_BEFORE_EXPORT").when(same, "UNCHANGED_GROUPING").otherwise("REGROUPED").alias("grouping_change_type"),
        "final_code", "label_tier", "training_label_quality",
    )


def stack_summary(events: DataFrame, completed: DataFrame, qa: DataFrame, labels: DataFrame, changes: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row for each completed stack: times, hours, event counts, label and page counts.

    Counts of stacks without documents or pages are null, their list of codes is empty. Actors are told apart as written.
    """
    s = config.states
    actor = norm_key("altered_by")
    named = has_text("altered_by") & (actor != config.system_actor) & ~actor.startswith(config.service_prefix)
    moment = lambda state, f: f(F.when(F.col("state") == state, F.col("entry_time")))
    events_in = lambda state: F.count_if(F.col("state") == state)
    own = events.join(completed.select("stack_id"), "stack_id", "left_semi").withColumn("__actor", actor).join(qa_workers(qa), F.col("__actor") == F.col("worker_id"), "left")
    w = own.groupBy("stack_id").agg(
        F.max("category").alias("category"),
        F.sort_array(F.collect_set("subsystem")).alias("subsystem_list"),
        F.sort_array(F.collect_set("category")).alias("category_list"),
        moment(s.imported, F.min).alias("first_import_time"),
        moment(s.analysed, F.min).alias("first_analyser_time"),
        moment(s.supervised, F.min).alias("first_supervisor_time"),
        moment(s.verified, F.min).alias("first_verifier_time"),
        moment(s.supervised_again, F.min).alias("first_supervisor2_time"),
        moment(s.exported, F.max).alias("last_export_time"),
        events_in(s.analysed).alias("n_analyser_events"),
        events_in(s.supervised).alias("n_supervisor_events"),
        events_in(s.verified).alias("n_verifier_events"),
        events_in(s.supervised_again).alias("n_supervisor2_events"),
        events_in(s.exported).alias("n_export_events"),
        F.count_if(actor == config.system_actor).alias("n_system_events"),
        F.count_if(actor.startswith(config.service_prefix)).alias("n_service_account_events"),
        F.count_if(named).alias("n_named_non_system_events"),
        F.count_if(F.col("worker_id").isNotNull()).alias("n_known_qa_events"),
        F.size(F.collect_set(F.when(named, F.col("altered_by")))).cast("long").alias("n_distinct_named_non_system_actors"),
    )
    tier = lambda name: F.count_if(F.col("label_tier") == name)
    by_label = labels.groupBy("stack_id").agg(
        F.count(F.lit(1)).alias("n_final_documents"),
        F.count_if("has_code").alias("n_final_documents_with_code"),
        F.count_if(~F.col("has_code")).alias("n_final_documents_without_code"),
        tier("QA_VERIFIED").alias("n_qa_verified_labels"),
        tier("NON_QA_VERIFIER").alias("n_non_qa_verifier_labels"),
        tier("SYSTEM_VERIFIED").alias("n_system_verified_labels"),
        tier("SERVICE_ACCOUNT").alias("n_service_account_labels"),
        F.sort_array(F.collect_set("label_code")).alias("final_code_list"),
    )
    both = F.col("page_presence") == "BOTH"
    by_page = changes.groupBy("stack_id").agg(
        F.count(F.lit(1)).alias("n_page_comparison_rows"),
        F.count_if(both).alias("n_pages_present_in_both"),
        F.count_if(F.col("page_presence") == "ANALYSER_ONLY").alias("n_pages_removed_before_export"),
        F.count_if(F.col("page_presence") == "EXPORT_ONLY").alias("n_pages_added_at_export"),
        F.count_if(F.col("grouping_change_type") == "REGROUPED").alias("n_regrouped_pages"),
        F.avg(F.when(both, F.col("same_grouping").cast("int"))).alias("pct_pages_same_grouping_among_matched"),
    )
    hours = lambda a, b: seconds_between(a, b).cast("double") / F.lit(3600.0)
    first = ["first_import_time", "first_analyser_time", "first_supervisor_time", "first_verifier_time", "first_supervisor2_time", "last_export_time"]
    return (
        w.join(by_label, "stack_id", "left").join(by_page, "stack_id", "left")
        .select(
            "stack_id", "category", (F.size("category_list") == 1).alias("has_unambiguous_category"), "subsystem_list", "category_list", *first,
            hours("first_import_time", "last_export_time").alias("hours_import_to_export"),
            hours("first_import_time", "first_analyser_time").alias("hours_import_to_first_analyser"),
            hours("first_analyser_time", "last_export_time").alias("hours_first_analyser_to_export"),
            hours("first_import_time", "first_supervisor_time").alias("hours_import_to_first_supervisor"),
            hours("first_import_time", "first_verifier_time").alias("hours_import_to_first_verifier"),
            hours("first_import_time", "first_supervisor2_time").alias("hours_import_to_first_supervisor2"),
            *[c for c in w.columns if c.startswith("n_")],
            *[c for c in by_label.columns if c.startswith("n_")],
            F.coalesce("final_code_list", F.array().cast("array<string>")).alias("final_code_list"),
            *[c for c in by_page.columns if c != "stack_id"],
        )
    )
