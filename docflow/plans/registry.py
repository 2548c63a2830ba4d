"""The registered queries over the benchmark tables, with independent DuckDB SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions import text
from docflow.operators import checks, pages, review, screening
from docflow.operators.snapshots import first_by, last_by, order_and_count, ranked_one, segments
from docflow.plans import page_pipeline, profile, workflow
from docflow.sources import files
from docflow.sources.adapters import logical, sql

Query = Callable[[SparkSession, str], DataFrame]


class _Tables:
    """Logical tables of one folder, built when first asked for, and the plans that several queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self.kept = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        if name not in self.kept:
            self.kept[name] = logical(self.spark, self.dir, name)
        return self.kept[name]

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """One plan for each stage, so that the planner sees equal exchanges and runs them once."""
        if name not in self.kept:
            self.kept[name] = make()
        return self.kept[name]

    def completed(self) -> DataFrame:
        return self._once("completed", lambda: workflow.completed_stacks(self.event))

    def labels(self) -> DataFrame:
        return self._once("labels", lambda: workflow.document_labels(self.event, self.document, self.field, self.code_lookup, self.qa, self.completed()))

    def page_labels(self) -> DataFrame:
        return self._once("page_labels", lambda: workflow.page_labels(self.page_map, self.labels()))

    def changes(self) -> DataFrame:
        return self._once("changes", lambda: workflow.grouping_changes(self.event, self.page_map, self.completed(), self.labels()))

    def truth(self) -> DataFrame:
        return self._once("truth", lambda: review.ground_truth(self.review))

    def csv_file(self) -> DataFrame:
        """Customers written as CSV and read back as text."""
        path = f"{files.scratch_folder(self.spark)}/customer"
        files.write_csv(self.raw("customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 == 0, "n/a").when(F.col("c_custkey") % 3 == 1, 'say "x", y').alias("c_note")), path)
        return files.read_csv(self.spark, path, ["c_custkey", "c_name", "c_note"])

    def json_file(self) -> DataFrame:
        """Events appended to a JSON-lines log in two steps, of which entries without a key are no entries; the last entry of each user."""
        path = f"{files.scratch_folder(self.spark)}/log"
        for kind in ("view", "click"):
            files.append_json(self.raw("events").where(F.col("event_type") == kind).select(F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"), "event_id", "event_type"), path)
        rows = files.read_json_log(self.spark, path, T.StructType.fromDDL("user_id long, event_id long, event_type string"), ["user_id"])
        return ranked_one(rows, ["user_id"], [F.desc("event_id")]).select("user_id", "event_id", "event_type")

    def zip_entries(self) -> DataFrame:
        """Entries of two containers with a wrapper folder, one folder for each source, and folders without files."""
        n = F.col("doc_id")
        name = F.concat(F.lit("wrap/"), F.col("source"), F.lit("/sub"), (n % 3).cast("string"), F.lit("/"), n.cast("string"), F.when(n % 4 == 0, ".PDF").when(n % 4 == 1, ".txt").otherwise(".pdf"))
        empty = n % 11 == 0
        return self.raw("documents").select(F.concat(F.lit("z"), (n % 2).cast("string"), F.lit(".zip")).alias("zip_path"), F.when(empty, F.concat(F.lit("wrap/"), "source", F.lit("_empty/"))).otherwise(name).alias("path"), empty.alias("is_dir"))


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, plan: Callable[[_Tables], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: plan(_Tables(spark, sf_dir))
    if oracle is not None:
        ORACLES[name] = oracle


# ---- SQL parts ------------------------------------------------------------------------------------------------------

_EV, _DOC, _FLD, _PM, _PR, _LK, _QA, _SC, _RV = (sql(n) for n in ("event", "document", "field", "page_map", "process", "code_lookup", "qa", "screening", "review"))
_K4 = "stack_id, process_id, doc_id, subdoc_idx"
_FIELD_ORDER = "entry_time DESC NULLS FIRST, field_value DESC NULLS FIRST, altered_by DESC NULLS FIRST, show_in_verifier DESC NULLS FIRST, action DESC NULLS FIRST, quality DESC NULLS FIRST, rating DESC NULLS FIRST"


def _one(rel: str, state: str, direction: str) -> str:
    """The first or last event of each stack in a state, by arg_min over a struct instead of a rank."""
    pick = "max" if direction == "last" else "min"
    return f"(SELECT u.stack_id, u.entry_id, u.entry_time, u.component FROM {rel} u JOIN (SELECT stack_id, {pick}(struct_pack(t := entry_time, i := entry_id)) AS best FROM {rel} z WHERE state = '{state}' GROUP BY stack_id) b ON u.stack_id = b.stack_id AND u.entry_id = b.best.i WHERE u.state = '{state}')"


_BASE = f"""WITH ev AS MATERIALIZED {_EV}, doc AS MATERIALIZED {_DOC}, fld AS MATERIALIZED {_FLD}, pm AS MATERIALIZED {_PM}, lk AS {_LK}, qa_raw AS {_QA},
lab AS (SELECT * FROM fld WHERE upper(trim(field_name, ' ')) = 'LABEL_CODE'),
qa AS (SELECT DISTINCT upper(trim(id, ' ')) AS w FROM qa_raw WHERE trim(id, ' ') <> ''),
lex AS MATERIALIZED {_one("ev", "export", "last")}, fan AS MATERIALIZED {_one("ev", "analyse", "first")},
"""
_T0 = """t0 AS (SELECT * FROM (SELECT stack_id, min(entry_time) FILTER (WHERE state = 'import') AS first_import_time, max(entry_time) FILTER (WHERE state = 'export') AS last_export_time,
  count(*) FILTER (WHERE state = 'import') AS n_import_events, count(*) FILTER (WHERE state = 'export') AS n_export_events FROM ev GROUP BY ALL) g
  WHERE first_import_time <= last_export_time)"""
_TIER = """CASE WHEN {code} IS NULL THEN 'MISSING_CODE' WHEN {qa} IS NOT NULL THEN 'QA_VERIFIED' WHEN upper(trim({v}, ' ')) = 'SYSTEM' THEN 'SYSTEM_VERIFIED'
  WHEN starts_with(upper(trim({v}, ' ')), 'SVC') THEN 'SERVICE_ACCOUNT' WHEN trim({v}, ' ') <> '' THEN 'NON_QA_VERIFIER' ELSE 'MISSING_VERIFIER' END"""
_T1 = f"""newest AS (SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY f.stack_id, process_id, doc_id, subdoc_idx, f.entry_id ORDER BY {_FIELD_ORDER.replace("entry_time", "f.entry_time", 1)}) AS r
  FROM lab f JOIN lex USING (stack_id, entry_id)) q WHERE r = 1),
t1a AS (SELECT d.*, x.entry_time AS export_entry_time, nullif(trim(n.field_value, ' '), '') AS label_code, n.altered_by AS code_altered_by, n.show_in_verifier, n.action AS code_action, n.quality AS code_quality, n.rating AS code_rating, n.entry_time AS code_entry_time
  FROM doc d JOIN lex x ON x.stack_id = d.stack_id AND x.entry_id = d.entry_id
  LEFT JOIN newest n ON (n.stack_id, n.process_id, n.doc_id, n.subdoc_idx, n.entry_id) = (d.stack_id, d.process_id, d.doc_id, d.subdoc_idx, d.entry_id) AND d.subdoc_idx IS NOT NULL AND d.process_id IS NOT NULL),
t1b AS (SELECT a.*, m.category, m.class_name, m.action, m.detail, m.label_code IS NOT NULL AS has_code_meaning, t0.stack_id IS NOT NULL AS has_complete_workflow_history,
  {_TIER.format(code="a.label_code", qa="qa.w", v="a.verified_by")} AS label_tier
  FROM t1a a LEFT JOIN (SELECT * FROM lk WHERE trim(label_code, ' ') <> '') m ON upper(trim(m.label_code, ' ')) = upper(trim(a.label_code, ' '))
  LEFT JOIN qa ON qa.w = upper(trim(a.verified_by, ' ')) LEFT JOIN t0 ON t0.stack_id = a.stack_id),
t1 AS MATERIALIZED (SELECT {_K4}, entry_id AS export_entry_id, export_entry_time, status, altered_by AS document_altered_by, remark, doc_class, export_name, entry_time AS document_entry_time, verified_by, last_entry, doc_state, doc_substate,
  label_code, code_altered_by, show_in_verifier, code_action, code_quality, code_rating, code_entry_time, category, class_name, action, detail, label_code IS NOT NULL AS has_code, has_code_meaning, has_complete_workflow_history, label_tier,
  CASE label_tier WHEN 'QA_VERIFIED' THEN 'GOLD' WHEN 'NON_QA_VERIFIER' THEN 'SILVER' WHEN 'SYSTEM_VERIFIED' THEN 'WEAK' ELSE 'EXCLUDE' END AS training_label_quality FROM t1b)"""
_CARRIED = "label_code, label_tier, training_label_quality, has_code, has_code_meaning, has_complete_workflow_history, doc_class, verified_by, code_altered_by, show_in_verifier, code_action, code_quality, code_rating, category, class_name, action, detail"
_T2 = f"""per_page AS (SELECT stack_id, process_id, entry_id, image_id, count(*) AS n FROM pm GROUP BY ALL),
t2 AS (SELECT p.stack_id, p.process_id, p.doc_id, p.subdoc_idx, p.entry_id AS export_entry_id, p.image_id, p.seqno, p.relation, p.rotation, p.entry_time AS page_entry_time, c.n AS n_document_mappings_for_page, c.n = 1 AS has_unambiguous_document_mapping, {_CARRIED}
  FROM pm p JOIN per_page c ON c.stack_id = p.stack_id AND c.process_id IS NOT DISTINCT FROM p.process_id AND c.entry_id = p.entry_id AND c.image_id IS NOT DISTINCT FROM p.image_id
  LEFT JOIN t1 ON t1.stack_id = p.stack_id AND t1.process_id = p.process_id AND t1.doc_id = p.doc_id AND t1.subdoc_idx = p.subdoc_idx AND t1.export_entry_id = p.entry_id
  WHERE EXISTS (SELECT 1 FROM t1 z WHERE z.stack_id = p.stack_id AND z.export_entry_id = p.entry_id))"""
_T3 = """ap AS (SELECT p.*, x.entry_time AS at, x.component FROM pm p JOIN fan x ON x.stack_id = p.stack_id AND x.entry_id = p.entry_id WHERE p.stack_id IN (SELECT stack_id FROM t0)),
ep AS (SELECT p.*, x.entry_time AS at FROM pm p JOIN lex x ON x.stack_id = p.stack_id AND x.entry_id = p.entry_id WHERE p.stack_id IN (SELECT stack_id FROM t0)),
t3 AS (SELECT coalesce(a.stack_id, e.stack_id) AS stack_id, coalesce(a.process_id, e.process_id) AS process_id, coalesce(a.image_id, e.image_id) AS image_id, a.entry_id AS analyser_entry_id, e.entry_id AS export_entry_id,
  a.at AS analyser_entry_time, e.at AS export_entry_time, a.component AS analyser_component, a.doc_id AS analyser_doc_id, a.subdoc_idx AS analyser_subdoc_idx, e.doc_id AS export_doc_id, e.subdoc_idx AS export_subdoc_idx,
  a.seqno AS analyser_seqno, e.seqno AS export_seqno, a.rotation AS analyser_rotation, e.rotation AS export_rotation,
  CASE WHEN a.image_id IS NULL THEN 'EXPORT_ONLY' WHEN e.image_id IS NULL THEN 'ANALYSER_ONLY' ELSE 'BOTH' END AS page_presence,
  CASE WHEN a.image_id IS NULL OR e.image_id IS NULL THEN NULL ELSE (a.doc_id, a.subdoc_idx) IS NOT DISTINCT FROM (e.doc_id, e.subdoc_idx) END AS same_grouping,
  CASE WHEN a.image_id IS NULL THEN 'ADDED_AT_EXPORT' WHEN e.image_id IS NULL THEN 'REMOVED_BEFORE_EXPORT' WHEN (a.doc_id, a.subdoc_idx) IS NOT DISTINCT FROM (e.doc_id, e.subdoc_idx) THEN 'UNCHANGED_GROUPING' ELSE 'REGROUPED' END AS grouping_change_type,
  t1.label_code AS final_code, t1.label_tier, t1.training_label_quality
  FROM ap a FULL JOIN ep e ON e.stack_id = a.stack_id AND e.process_id = a.process_id AND e.image_id = a.image_id
  LEFT JOIN t1 ON t1.stack_id = e.stack_id AND t1.process_id = e.process_id AND t1.doc_id = e.doc_id AND t1.subdoc_idx = e.subdoc_idx AND t1.export_entry_id = e.entry_id)"""
_NAMED = "trim(altered_by, ' ') <> '' AND upper(trim(altered_by, ' ')) <> 'SYSTEM' AND NOT starts_with(upper(trim(altered_by, ' ')), 'SVC')"
_T4 = f"""wf AS (SELECT stack_id, max(category) AS category, count(DISTINCT category) = 1 AS has_unambiguous_category,
  coalesce(list(DISTINCT subsystem ORDER BY subsystem) FILTER (WHERE subsystem IS NOT NULL), []) AS subsystem_list, coalesce(list(DISTINCT category ORDER BY category) FILTER (WHERE category IS NOT NULL), []) AS category_list,
  min(entry_time) FILTER (WHERE state = 'import') AS first_import_time, min(entry_time) FILTER (WHERE state = 'analyse') AS first_analyser_time, min(entry_time) FILTER (WHERE state = 'supervise') AS first_supervisor_time,
  min(entry_time) FILTER (WHERE state = 'verify') AS first_verifier_time, min(entry_time) FILTER (WHERE state = 'supervise_again') AS first_supervisor2_time, max(entry_time) FILTER (WHERE state = 'export') AS last_export_time,
  count(*) FILTER (WHERE state = 'analyse') AS n_analyser_events, count(*) FILTER (WHERE state = 'supervise') AS n_supervisor_events, count(*) FILTER (WHERE state = 'verify') AS n_verifier_events,
  count(*) FILTER (WHERE state = 'supervise_again') AS n_supervisor2_events, count(*) FILTER (WHERE state = 'export') AS n_export_events,
  count(*) FILTER (WHERE upper(trim(altered_by, ' ')) = 'SYSTEM') AS n_system_events, count(*) FILTER (WHERE starts_with(upper(trim(altered_by, ' ')), 'SVC')) AS n_service_account_events,
  count(*) FILTER (WHERE {_NAMED}) AS n_named_non_system_events, count(*) FILTER (WHERE upper(trim(altered_by, ' ')) IN (SELECT w FROM qa)) AS n_known_qa_events,
  count(DISTINCT altered_by) FILTER (WHERE {_NAMED}) AS n_distinct_named_non_system_actors
  FROM ev WHERE stack_id IN (SELECT stack_id FROM t0) GROUP BY stack_id),
ls AS (SELECT stack_id, count(*) AS n_final_documents, count(label_code) AS n_final_documents_with_code, count(*) - count(label_code) AS n_final_documents_without_code, count(*) FILTER (WHERE label_tier = 'QA_VERIFIED') AS n_qa_verified_labels,
  count(*) FILTER (WHERE label_tier = 'NON_QA_VERIFIER') AS n_non_qa_verifier_labels, count(*) FILTER (WHERE label_tier = 'SYSTEM_VERIFIED') AS n_system_verified_labels, count(*) FILTER (WHERE label_tier = 'SERVICE_ACCOUNT') AS n_service_account_labels,
  list(DISTINCT label_code ORDER BY label_code) FILTER (WHERE label_code IS NOT NULL) AS final_code_list FROM t1 GROUP BY stack_id),
gs AS (SELECT stack_id, count(*) AS n_page_comparison_rows, count(*) FILTER (WHERE page_presence = 'BOTH') AS n_pages_present_in_both, count(*) FILTER (WHERE page_presence = 'ANALYSER_ONLY') AS n_pages_removed_before_export,
  count(*) FILTER (WHERE page_presence = 'EXPORT_ONLY') AS n_pages_added_at_export, count(*) FILTER (WHERE grouping_change_type = 'REGROUPED') AS n_regrouped_pages, avg(CAST(same_grouping AS INT)) AS pct_pages_same_grouping_among_matched FROM t3 GROUP BY stack_id)
SELECT wf.*, date_diff('second', first_import_time, last_export_time) / CAST(3600 AS DOUBLE) AS hours_import_to_export, date_diff('second', first_import_time, first_analyser_time) / CAST(3600 AS DOUBLE) AS hours_import_to_first_analyser,
  date_diff('second', first_analyser_time, last_export_time) / CAST(3600 AS DOUBLE) AS hours_first_analyser_to_export, date_diff('second', first_import_time, first_supervisor_time) / CAST(3600 AS DOUBLE) AS hours_import_to_first_supervisor,
  date_diff('second', first_import_time, first_verifier_time) / CAST(3600 AS DOUBLE) AS hours_import_to_first_verifier, date_diff('second', first_import_time, first_supervisor2_time) / CAST(3600 AS DOUBLE) AS hours_import_to_first_supervisor2,
  n_final_documents, n_final_documents_with_code, n_final_documents_without_code, n_qa_verified_labels, n_non_qa_verifier_labels, n_system_verified_labels, n_service_account_labels, coalesce(final_code_list, []) AS final_code_list,
  n_page_comparison_rows, n_pages_present_in_both, n_pages_removed_before_export, n_pages_added_at_export, n_regrouped_pages, pct_pages_same_grouping_among_matched
FROM wf LEFT JOIN ls USING (stack_id) LEFT JOIN gs USING (stack_id)"""
_TO1 = f"{_BASE}{_T0}, {_T1}"

# ---- stages ---------------------------------------------------------------------------------------------------------

_add("completed_stacks", lambda t: t.completed(), f"WITH ev AS {_EV}, {_T0} SELECT * FROM t0")
_add("last_snapshot", lambda t: last_by(t.event, ["stack_id"], "entry_time", "entry_id").select("stack_id", "entry_id", "state"), f"WITH ev AS {_EV} SELECT stack_id, arg_max(entry_id, struct_pack(t := entry_time, i := entry_id)) AS entry_id, arg_max(state, struct_pack(t := entry_time, i := entry_id)) AS state FROM ev GROUP BY stack_id")
_add("first_snapshot", lambda t: first_by(t.event, ["stack_id"], "entry_time", "entry_id").select("stack_id", "entry_id", "state"), f"WITH ev AS {_EV} SELECT stack_id, arg_min(entry_id, struct_pack(t := entry_time, i := entry_id)) AS entry_id, arg_min(state, struct_pack(t := entry_time, i := entry_id)) AS state FROM ev GROUP BY stack_id")
_add(
    "dedup_latest",
    lambda t: ranked_one(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c).desc_nulls_first() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"),
    "SELECT l_orderkey, l_linenumber, b.p AS l_partkey, b.s AS l_suppkey, b.d AS l_shipdate FROM (SELECT l_orderkey, l_linenumber, max(struct_pack(d := l_shipdate, p := l_partkey, s := l_suppkey, q := l_quantity, x := l_extendedprice)) AS b FROM lineitem GROUP BY ALL) g",
)
_add("document_labels", lambda t: t.labels(), f"{_TO1} SELECT * FROM t1")
_add("label_tiers", lambda t: t.labels().groupBy("label_tier", "training_label_quality").agg(F.count(F.lit(1)).alias("n"), F.count_if("has_code_meaning").alias("n_with_meaning")), f"{_TO1} SELECT label_tier, training_label_quality, count(*) AS n, count(*) FILTER (WHERE has_code_meaning) AS n_with_meaning FROM t1 GROUP BY ALL")
_add("training_docs", lambda t: workflow.training_documents(t.labels()), f"{_TO1} SELECT * FROM t1 WHERE label_code IS NOT NULL AND training_label_quality IN ('SILVER', 'GOLD')")
_add("page_labels", lambda t: t.page_labels(), f"{_TO1}, {_T2} SELECT * FROM t2")
_add("page_mapping_counts", lambda t: t.page_labels().groupBy("n_document_mappings_for_page", "has_unambiguous_document_mapping").agg(F.count(F.lit(1)).alias("n")), f"{_TO1}, {_T2} SELECT n_document_mappings_for_page, has_unambiguous_document_mapping, count(*) AS n FROM t2 GROUP BY ALL")
_add("training_pages", lambda t: workflow.training_pages(t.page_labels()), f"{_TO1}, {_T2} SELECT * FROM t2 WHERE has_unambiguous_document_mapping AND label_code IS NOT NULL AND training_label_quality IN ('SILVER', 'GOLD')")
_add("grouping_changes", lambda t: t.changes(), f"{_TO1}, {_T3} SELECT * FROM t3")
_add("stack_agg", lambda t: workflow.stack_summary(t.event, t.completed(), t.qa, t.labels(), t.changes()), f"{_TO1}, {_T3}, {_T4}")

# ---- contracts ------------------------------------------------------------------------------------------------------

_add("semantic_duplicates", lambda t: checks.lookup_duplicates(t.code_lookup.unionByName(t.code_lookup.where("label_code like 'c%'"))), f"WITH lk AS {_LK}, l2 AS (SELECT label_code FROM lk UNION ALL SELECT label_code FROM lk WHERE label_code[1] = 'c') SELECT upper(trim(label_code, ' ')) AS normalized_code, count(*) AS n_rows FROM l2 WHERE trim(label_code, ' ') <> '' GROUP BY 1 HAVING count(*) >= 2")
_add(
    "process_stability",
    lambda t: checks.unstable_processes(t.event, t.page_map.withColumn("process_id", F.when(F.col("entry_id") % 5 == 0, F.lit(None)).otherwise(F.col("process_id")))),
    f"WITH ev AS {_EV}, pm AS (SELECT stack_id, entry_id, image_id, CASE WHEN entry_id % 5 <> 0 THEN process_id END AS process_id FROM {_PM}), a AS (SELECT DISTINCT stack_id, image_id, process_id FROM pm SEMI JOIN {_one('ev', 'analyse', 'first')} x USING (stack_id, entry_id)), e AS (SELECT DISTINCT stack_id, image_id, process_id FROM pm SEMI JOIN {_one('ev', 'export', 'last')} x USING (stack_id, entry_id)) SELECT a.stack_id, a.image_id, a.process_id AS analyser_process_id, e.process_id AS export_process_id FROM a JOIN e ON a.stack_id = e.stack_id AND a.image_id = e.image_id WHERE a.process_id IS DISTINCT FROM e.process_id",
)
_add("grain_check", lambda t: checks.grain_report(t.raw("lineitem"), ["l_orderkey", "l_linenumber"]), "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS n_duplicate_keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g")

# ---- profiles -------------------------------------------------------------------------------------------------------

_E5 = f"{_K4}, entry_id"
_add("workflow_vocabulary", lambda t: profile.vocabulary(t.event), f"WITH ev AS {_EV} SELECT state, component, altered_by, count(*) AS n_rows, count(DISTINCT stack_id) AS n_stacks, min(entry_id) AS min_entry_id, max(entry_id) AS max_entry_id, min(entry_time) AS first_seen, max(entry_time) AS last_seen FROM ev GROUP BY ALL")
_add("workflow_paths", lambda t: profile.workflow_paths(t.event), f"WITH ev AS {_EV}, few AS (SELECT DISTINCT stack_id FROM ev ORDER BY 1 LIMIT 100), steps AS (SELECT DISTINCT stack_id, entry_id, entry_time, concat(entry_id, ': ', ifnull(state, '<NULL>'), ' / ', ifnull(component, '<NULL>'), ' / ', ifnull(altered_by, '<NULL>')) AS s FROM ev SEMI JOIN few USING (stack_id)) SELECT stack_id, string_agg(s, ' -> ' ORDER BY entry_id, entry_time, s) AS workflow_path FROM steps GROUP BY stack_id")
_add("entry_distribution", lambda t: profile.entry_distribution(t.event), f"WITH p AS (SELECT stack_id, count(DISTINCT entry_id) AS n, min(entry_id) AS a, max(entry_id) AS b FROM {_EV} GROUP BY 1) SELECT count(*) AS n_stacks, count(*) FILTER (WHERE b > 10) AS stacks_with_entry_above, round(100.0 * count(*) FILTER (WHERE b > 10) / count(*), 2) AS pct_stacks_with_entry_above, min(a) AS global_min_entry_id, max(b) AS global_max_entry_id, quantile_disc(n, 0.5) AS median_entries, quantile_disc(n, 0.95) AS p95_entries, max(n) AS max_distinct_entries FROM p")
_add("chronology", lambda t: profile.chronology(t.event), f"WITH p AS (SELECT stack_id, min(entry_time) FILTER (WHERE state = 'import') AS a, max(entry_time) FILTER (WHERE state = 'export') AS b FROM {_EV} GROUP BY 1) SELECT count(*) AS n_all_stacks, count(a) AS stacks_with_import, count(b) AS stacks_with_export, count(a + (b - a)) AS stacks_with_both, count(*) FILTER (WHERE a <= b) AS chronologically_completed_stacks, count(*) FILTER (WHERE a > b) AS invalid_export_before_import FROM p")
_LAB = f"lab AS (SELECT * FROM {_FLD} WHERE upper(trim(field_name, ' ')) = 'LABEL_CODE')"
_add("code_grain", lambda t: profile.code_grain(t.field), f"WITH {_LAB}, p AS (SELECT {_E5}, count(*) AS n, count(DISTINCT field_value) AS d FROM lab GROUP BY ALL) SELECT count(*) AS n_document_entries, count(*) FILTER (WHERE n >= 2) AS entries_with_repeated_rows, count(*) FILTER (WHERE d >= 2) AS entries_with_conflicts, max(n) AS max_rows, max(d) AS max_values FROM p")
_add("code_conflicts", lambda t: profile.code_conflicts(t.field), f"WITH {_LAB}, p AS (SELECT {_E5}, count(*) AS n_rows, count(DISTINCT field_value) AS n_values, list(DISTINCT field_value ORDER BY field_value) FILTER (WHERE field_value IS NOT NULL) AS observed_values FROM lab GROUP BY ALL) SELECT * FROM p WHERE n_rows >= 2 OR n_values >= 2 ORDER BY n_values DESC, n_rows DESC, stack_id NULLS LAST, process_id NULLS LAST, doc_id NULLS LAST, subdoc_idx NULLS LAST, entry_id NULLS LAST LIMIT 500")
_add("last_entry_grain", lambda t: profile.last_entry_grain(t.document), f"SELECT count(*) AS n_final_document_keys, count(*) FILTER (WHERE n >= 2) AS duplicated_final_document_keys, max(n) AS max_rows_per_key FROM (SELECT count(*) AS n FROM {_DOC} d WHERE last_entry = 1 GROUP BY {_K4}) g")
_add("lookup_duplicates", lambda t: profile.lookup_duplicates_all(t.code_lookup), f"SELECT upper(trim(label_code, ' ')) AS normalized_code, count(*) AS n_rows, list(DISTINCT category ORDER BY category) AS categories, list(DISTINCT class_name ORDER BY class_name) AS classes FROM {_LK} l GROUP BY 1 HAVING count(*) >= 2")
_add("lookup_match", lambda t: profile.lookup_match(t.field, t.code_lookup), f"WITH {_LAB}, s AS (SELECT DISTINCT upper(trim(field_value, ' ')) AS c FROM lab WHERE trim(field_value, ' ') <> ''), m AS (SELECT c, c IN (SELECT upper(trim(label_code, ' ')) FROM {_LK} l WHERE trim(label_code, ' ') <> '') AS k FROM s) SELECT count(*) AS n_observed_codes, count(*) FILTER (WHERE k) AS matched_codes, count(*) FILTER (WHERE NOT k) AS unmatched_codes FROM m")
_add("coverage_by_state", lambda t: profile.coverage_by_state(t.event, t.page_map, t.field), f"WITH {_LAB}, c AS (SELECT DISTINCT {_E5}, 1 AS one FROM lab WHERE trim(field_value, ' ') <> ''), e AS (SELECT DISTINCT stack_id, entry_id, state, component FROM {_EV} v), d AS (SELECT DISTINCT {_E5} FROM {_PM} p), r AS (SELECT e.state, e.component, c.one FROM d JOIN e ON e.stack_id = d.stack_id AND e.entry_id = d.entry_id LEFT JOIN c ON c.stack_id = d.stack_id AND c.process_id = d.process_id AND c.doc_id = d.doc_id AND c.subdoc_idx = d.subdoc_idx AND c.entry_id = d.entry_id) SELECT state, component, count(*) AS n_snapshots, count(one) AS with_code, count(*) - count(one) AS without_code, round(100.0 * count(one) / count(*), 2) AS coverage_pct FROM r GROUP BY ALL")
_add("snapshot_vs_delta", lambda t: profile.snapshot_or_delta(t.process, t.page_map, t.field), f"WITH {_LAB}, c AS (SELECT DISTINCT {_E5} FROM lab WHERE trim(field_value, ' ') <> ''), pr AS (SELECT *, lead(entry_id) OVER (PARTITION BY stack_id, process_id ORDER BY entry_id) AS nx FROM (SELECT DISTINCT stack_id, process_id, entry_id FROM {_PR} q) z), d AS (SELECT DISTINCT {_E5} FROM {_PM} p), s AS (SELECT a.*, pr.nx FROM pr JOIN d a USING (stack_id, process_id, entry_id) JOIN d b ON b.stack_id = a.stack_id AND b.process_id = a.process_id AND b.doc_id = a.doc_id AND b.subdoc_idx = a.subdoc_idx AND b.entry_id = pr.nx), f AS (SELECT x.doc_id IS NOT NULL AS x, y.doc_id IS NOT NULL AS y FROM s LEFT JOIN c x ON x.stack_id = s.stack_id AND x.process_id = s.process_id AND x.doc_id = s.doc_id AND x.subdoc_idx = s.subdoc_idx AND x.entry_id = s.entry_id LEFT JOIN c y ON y.stack_id = s.stack_id AND y.process_id = s.process_id AND y.doc_id = s.doc_id AND y.subdoc_idx = s.subdoc_idx AND y.entry_id = s.nx) SELECT count(*) AS n_pairs, count(*) FILTER (WHERE x AND y) AS \"both\", count(*) FILTER (WHERE x AND NOT y) AS current_only, count(*) FILTER (WHERE y AND NOT x) AS next_only, count(*) FILTER (WHERE NOT x AND NOT y) AS neither, round(100.0 * count(*) FILTER (WHERE x AND y) / nullif(count(*), 0), 2) AS repeated_pct FROM f")
_add("qa_list", lambda t: profile.qa_list(t.qa), f"SELECT id FROM {_QA} q ORDER BY id NULLS LAST LIMIT 100")
_add("verifier_vocabulary", lambda t: profile.verifiers(t.document), f"SELECT verified_by, count(*) AS n_rows, count(DISTINCT stack_id) AS n_stacks, min(entry_time) AS first_seen, max(entry_time) AS last_seen FROM {_DOC} d GROUP BY 1")
_add("verifier_match", lambda t: profile.verifier_match(t.document, t.qa), f"WITH j AS (SELECT trim(d.verified_by, ' ') <> '' AS v, q.id IS NOT NULL AS k FROM {_DOC} d LEFT JOIN {_QA} q ON upper(trim(q.id, ' ')) = upper(trim(d.verified_by, ' '))) SELECT count(*) AS n_rows, count(*) FILTER (WHERE v) AS with_verifier, count(*) FILTER (WHERE k) AS by_known_qa, count(*) FILTER (WHERE v AND NOT k) AS by_others FROM j")
_add("code_metadata", lambda t: profile.code_metadata(t.field), f"WITH {_LAB} SELECT altered_by, show_in_verifier, action, quality, rating, count(*) AS n_rows, count(DISTINCT stack_id) AS n_stacks FROM lab GROUP BY ALL")
_NEW5 = f"n5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_E5} ORDER BY {_FIELD_ORDER}) AS r FROM lab) q WHERE r = 1)"
_EXACT = "{b}.stack_id = {a}.stack_id AND {b}.process_id = {a}.process_id AND {b}.doc_id = {a}.doc_id AND {b}.subdoc_idx = {a}.subdoc_idx"
_add("export_coverage", lambda t: profile.export_coverage(t.event, t.document, t.page_map, t.field), f"WITH ev AS {_EV}, {_LAB}, {_NEW5}, k AS (SELECT DISTINCT {_E5} FROM {_PM} p SEMI JOIN {_one('ev', 'export', 'last')} x USING (stack_id, entry_id)), r AS (SELECT n5.field_value, n5.show_in_verifier, d.verified_by, d.stack_id AS d FROM k LEFT JOIN n5 ON {_EXACT.format(a='k', b='n5')} AND n5.entry_id = k.entry_id LEFT JOIN {_DOC} d ON {_EXACT.format(a='k', b='d')} AND d.entry_id = k.entry_id) SELECT count(*) AS n_keys, count(field_value) AS with_code, count(*) - count(field_value) AS without_code, round(100.0 * count(field_value) / nullif(count(*), 0), 2) AS coverage_pct, count(d) AS with_document_row, count(*) FILTER (WHERE trim(verified_by, ' ') <> '') AS with_verifier, count(*) FILTER (WHERE show_in_verifier = 1) AS shown_in_verifier FROM r")
_AT = f"ax AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_K4} ORDER BY {_FIELD_ORDER}) AS r FROM lab SEMI JOIN {_one('ev', 'export', 'last')} x USING (stack_id, entry_id)) q WHERE r = 1)"
_add("export_vs_latest", lambda t: profile.export_against_latest(t.event, t.field), f"WITH ev AS {_EV}, {_LAB}, {_AT}, nw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_K4} ORDER BY {_FIELD_ORDER.replace('entry_time DESC NULLS FIRST,', 'entry_time DESC NULLS FIRST, entry_id DESC NULLS FIRST,')}) AS r FROM lab) q WHERE r = 1), j AS (SELECT upper(trim(ax.field_value, ' ')) AS x, upper(trim(nw.field_value, ' ')) AS y FROM ax LEFT JOIN nw ON {_EXACT.format(a='ax', b='nw')}) SELECT count(*) AS n_keys, count(*) - count(y) AS without_latest, count(*) FILTER (WHERE x = y) AS equal, count(*) FILTER (WHERE x <> y) AS different FROM j")
_add("evidence_categories", lambda t: profile.evidence(t.event, t.document, t.field, t.qa), f"WITH ev AS {_EV}, {_LAB}, {_AT}, j AS (SELECT ax.stack_id, q.id, d.verified_by, ax.show_in_verifier FROM ax LEFT JOIN {_DOC} d ON {_EXACT.format(a='ax', b='d')} AND d.entry_id = ax.entry_id LEFT JOIN {_QA} q ON upper(trim(q.id, ' ')) = upper(trim(d.verified_by, ' '))) SELECT CASE WHEN id IS NOT NULL THEN 'QA_VERIFIED_CANDIDATE' WHEN trim(verified_by, ' ') <> '' THEN 'OTHER_VERIFIED_CANDIDATE' WHEN show_in_verifier = 1 THEN 'SHOWN_BUT_NOT_PROVEN_VERIFIED' ELSE 'UNVERIFIED_EXPORT_CODE' END AS evidence_category, count(*) AS n_document_keys, count(DISTINCT stack_id) AS n_stacks FROM j GROUP BY 1")
_add("id_normalisation_risk", lambda t: profile.image_ids(t.page_map), f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE image_id IS NOT NULL AND try_cast(image_id AS DECIMAL(38, 0)) IS NULL) AS non_numeric_rows, count(DISTINCT image_id) AS distinct_texts, count(DISTINCT try_cast(image_id AS DECIMAL(38, 0))) AS distinct_numbers FROM {_PM} p")
_add("repeated_stages", lambda t: profile.repeated_stages(t.event), f"SELECT state, component, count(*) AS n_groups, count(*) FILTER (WHERE n >= 2) AS repeated_groups, max(n) AS max_occurrences FROM (SELECT stack_id, state, component, count(DISTINCT entry_id) AS n FROM {_EV} e GROUP BY ALL) g GROUP BY ALL")
_add("duplicate_grain_top", lambda t: profile.repeated_keys(t.changes(), ["stack_id", "process_id", "image_id"]), f"{_TO1}, {_T3} SELECT stack_id, process_id, image_id, count(*) AS n_rows FROM t3 GROUP BY ALL HAVING count(*) >= 2 ORDER BY n_rows DESC, stack_id NULLS LAST, process_id NULLS LAST, image_id NULLS LAST LIMIT 500")
_add("duplicate_entry_top", lambda t: profile.repeated_keys(t.changes(), ["stack_id", "process_id", "export_entry_id"]), f"{_TO1}, {_T3} SELECT stack_id, process_id, export_entry_id, count(*) AS n_rows FROM t3 GROUP BY ALL HAVING count(*) >= 2 ORDER BY n_rows DESC, stack_id NULLS LAST, process_id NULLS LAST, export_entry_id NULLS LAST LIMIT 500")
_add("duplicate_stack_top", lambda t: profile.repeated_keys(t.event, ["stack_id"]), f"SELECT stack_id, count(*) AS n_rows FROM {_EV} e GROUP BY ALL HAVING count(*) >= 2 ORDER BY n_rows DESC, stack_id NULLS LAST LIMIT 500")
_add("tier_share", lambda t: profile.tier_share(t.event, t.document, t.field, t.qa), f"WITH ev AS {_EV}, {_LAB}, qa AS (SELECT DISTINCT upper(trim(id, ' ')) AS w FROM {_QA} q WHERE trim(id, ' ') <> ''), j AS (SELECT l.stack_id, {_TIER.format(code='l.field_value', qa='qa.w', v='d.verified_by')} AS label_tier FROM lab l SEMI JOIN {_one('ev', 'export', 'last')} x USING (stack_id, entry_id) LEFT JOIN {_DOC} d ON {_EXACT.format(a='l', b='d')} AND d.entry_id = l.entry_id LEFT JOIN qa ON qa.w = upper(trim(d.verified_by, ' ')) WHERE trim(l.field_value, ' ') <> '') SELECT label_tier, count(*) AS n_rows, count(DISTINCT stack_id) AS n_stacks, round(100.0 * count(*) / (SELECT count(*) FROM j), 2) AS share_pct FROM j GROUP BY 1")

# ---- page pipeline --------------------------------------------------------------------------------------------------

_LATEST = f"""lg AS (SELECT *, CASE WHEN image_sha256 IS NULL OR image_sha256 = '' THEN 'NO_IMAGE' ELSE image_sha256 END AS sha FROM {_SC} s),
now AS (SELECT * FROM lg SEMI JOIN (SELECT masterindex_id, pdf_path_in_zip, source_page_number, sha, max(seq) AS seq FROM lg GROUP BY ALL) b USING (masterindex_id, pdf_path_in_zip, source_page_number, sha, seq))"""
_REV = "(status IS DISTINCT FROM 'success' OR label IS NOT DISTINCT FROM 'unclear' OR confidence IS NULL OR confidence < 0.6)"
_add("latest_log", lambda t: screening.latest_results(t.screening), f"WITH {_LATEST} SELECT * REPLACE (sha AS image_sha256) EXCLUDE (sha) FROM now".replace("* REPLACE (sha AS image_sha256) EXCLUDE (sha)", "masterindex_id, pdf_path_in_zip, source_page_number, page_number, sha AS image_sha256, seq, status, label, confidence, actual"))
_add("json_log", lambda t: ranked_one(t.raw("events").select("user_id", F.col("event_id").alias("seq"), F.from_json("props", "k long")["k"].alias("k")).where("k is not null"), ["user_id"], [F.desc("seq")]), "SELECT user_id, max(event_id) AS seq, arg_max(CAST(props ->> '$.k' AS BIGINT), event_id) AS k FROM events WHERE props ->> '$.k' IS NOT NULL GROUP BY user_id")
_add("resume_pending", lambda t: screening.pending(t.screening.select(*screening.PAGE_KEY, "page_number").dropDuplicates(), t.screening), f"WITH {_LATEST} SELECT DISTINCT masterindex_id, pdf_path_in_zip, source_page_number, sha AS image_sha256, page_number FROM lg WHERE page_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM now n WHERE n.status = 'success' AND n.masterindex_id = lg.masterindex_id AND n.pdf_path_in_zip = lg.pdf_path_in_zip AND n.source_page_number = lg.source_page_number AND n.sha = lg.sha)")
_NOW3 = f"now3 AS (SELECT s.* FROM {_SC} s JOIN (SELECT masterindex_id, pdf_path_in_zip, page_number, max(seq) AS top FROM {_SC} z GROUP BY ALL) b ON s.masterindex_id = b.masterindex_id AND s.pdf_path_in_zip = b.pdf_path_in_zip AND s.page_number = b.page_number AND s.seq = b.top)"
_add("positive_pages", lambda t: screening.positive_pages(t.screening), f"WITH {_NOW3} SELECT masterindex_id, string_agg(DISTINCT CAST(page_number AS VARCHAR), ', ' ORDER BY page_number) AS pages, count(DISTINCT page_number) AS n_pages FROM now3 WHERE label = 'target' AND NOT {_REV} GROUP BY 1".replace("string_agg(DISTINCT CAST(page_number AS VARCHAR), ', ' ORDER BY page_number)", "array_to_string(list_sort(list(DISTINCT page_number)), ', ')"))
_add("human_review", lambda t: screening.review_queue(t.screening), f"WITH {_NOW3} SELECT masterindex_id, pdf_path_in_zip, page_number, status, label, confidence FROM now3 WHERE {_REV}")
_add(
    "review_sample",
    lambda t: review.review_sheet(t.screening).select(*screening.PAGE_KEY, "predicted_label", "review_reason", "sampling_probability", "sampling_weight"),
    f"""WITH {_LATEST}, c AS (SELECT *, CASE WHEN status IS DISTINCT FROM 'success' THEN 'screening_failed' WHEN label = 'unclear' THEN 'unclear' WHEN confidence IS NULL OR confidence < 0.6 THEN 'low_confidence' END AS why FROM now),
p AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || masterindex_id || '|' || pdf_path_in_zip || '|' || source_page_number || '|' || sha), masterindex_id, pdf_path_in_zip, source_page_number, sha) AS r FROM c WHERE why IS NULL AND label IN ('target', 'other')),
z AS (SELECT *, least(greatest(20, CAST(round_even(n * 0.05, 0) AS BIGINT)), 400, n) AS m FROM p)
SELECT masterindex_id, pdf_path_in_zip, source_page_number, sha AS image_sha256, label AS predicted_label, why AS review_reason, CAST(1 AS DOUBLE) AS sampling_probability, CAST(1 AS DOUBLE) AS sampling_weight FROM c WHERE why IS NOT NULL
UNION ALL SELECT masterindex_id, pdf_path_in_zip, source_page_number, sha, label, CASE label WHEN 'target' THEN 'positive_audit' ELSE 'negative_audit' END, CAST(m AS DOUBLE) / n, 1 / (CAST(m AS DOUBLE) / n) FROM z WHERE r <= m""",
)
_SHEET = ", ".join(f"{c if c in ('masterindex_id', 'pdf_path_in_zip', 'source_page_number', 'image_sha256', 'predicted_label', 'review_reason', 'sampling_probability', 'sampling_weight') else 'n.' + c if c in ('page_number', 'confidence', 'status') else 'CAST(NULL AS VARCHAR) AS ' + c}" for c in page_pipeline.REVIEW_COLUMNS)
_add(
    "review_workbook",
    lambda t: page_pipeline.review_workbook(t.screening),
    f"SELECT {_SHEET} FROM ({ORACLES['review_sample']}) w JOIN (WITH {_LATEST} SELECT masterindex_id, pdf_path_in_zip, source_page_number, sha AS image_sha256, page_number, confidence, status FROM now) n USING (masterindex_id, pdf_path_in_zip, source_page_number, image_sha256)",
)
_add("csv_file", lambda t: t.csv_file(), "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 3 = 1 THEN 'say \"x\", y' END AS c_note FROM customer")
_add("json_file", lambda t: t.json_file(), "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events WHERE event_type IN ('view', 'click') AND user_id % 5 <> 0 GROUP BY 1")
_add(
    "zip_inventory",
    lambda t: pages.inventory(pages.members(t.zip_entries())),
    """WITH e AS (SELECT 'z' || CAST(doc_id % 2 AS VARCHAR) || '.zip' AS zip_path, source || CASE WHEN doc_id % 11 = 0 THEN '_empty' ELSE '' END AS m, doc_id % 11 <> 0 AND doc_id % 4 <> 1 AS pdf,
  CAST(doc_id AS VARCHAR) || CASE doc_id % 4 WHEN 0 THEN '.PDF' ELSE '.pdf' END AS name, 'wrap/' || source || '/sub' || CAST(doc_id % 3 AS VARCHAR) || '/' AS folder FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY folder || name, zip_path) AS k, count(*) OVER (PARTITION BY m) AS n FROM e WHERE pdf)
SELECT m AS masterindex_id, zip_path, folder || name AS pdf_path_in_zip, name AS pdf_filename, CAST(k AS INT) AS pdf_order_in_masterindex, CAST(n AS INT) AS pdf_count_in_masterindex, 'ready' AS status FROM p
UNION ALL SELECT m, min(zip_path), NULL, NULL, NULL, 0, 'missing_pdf' FROM e WHERE m NOT IN (SELECT m FROM p) GROUP BY m""",
)
_GT = f"""gt AS (SELECT *, lower(trim(coalesce(review_status, ''))) AS st, lower(trim(coalesce(predicted_label, ''))) AS pl, lower(trim(coalesce(reviewed_label, ''))) AS rl FROM {_RV} r),
tr AS (SELECT *, CASE st WHEN 'accepted' THEN CASE WHEN pl IN ('target', 'other', 'unclear') THEN pl END WHEN 'corrected' THEN CASE WHEN rl IN ('target', 'other', 'unclear') THEN rl END END AS ground_truth_label FROM gt)"""
_KEEP = "masterindex_id, pdf_path_in_zip, page_number"
_add("ground_truth", lambda t: t.truth().where("ground_truth_label is not null").select("masterindex_id", "pdf_path_in_zip", "page_number", "ground_truth_label"), f"WITH {_GT} SELECT {_KEEP}, ground_truth_label FROM tr WHERE ground_truth_label IS NOT NULL")
_add("excluded_rows", lambda t: t.truth().where("ground_truth_label is null").select("masterindex_id", "pdf_path_in_zip", "page_number", "exclusion_reason"), f"WITH {_GT} SELECT {_KEEP}, CASE st WHEN 'accepted' THEN 'invalid_predicted_label' WHEN 'corrected' THEN 'missing_or_invalid_reviewed_label' WHEN 'unreadable' THEN st WHEN 'out_of_scope' THEN st ELSE 'incomplete_review' END AS exclusion_reason FROM tr WHERE ground_truth_label IS NULL")
_add("segments", lambda t: segments(t.raw("conversations").withColumn("ordinal", F.col("turn")), "conv_id", "turn", F.col("role") == "user", "role"), "WITH u AS (SELECT conv_id, turn, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations WHERE role = 'user') SELECT conv_id, min(turn) AS start_page, max(turn) AS end_page FROM u GROUP BY conv_id, g")
_add("nested_ground_truth", lambda t: review.nested_ground_truth(t.truth()).select("masterindex_id", "ground_truth_scope", "reviewed_page_count", F.to_json("pages").alias("pages"), F.to_json("positive_segments").alias("positive_segments")), f"""WITH {_GT}, k AS (SELECT {_KEEP}, ground_truth_label AS label, ground_truth_label = 'target' AS p FROM tr WHERE ground_truth_label IS NOT NULL),
m AS (SELECT *, CASE WHEN lag(p) OVER o AND page_number - lag(page_number) OVER o = 1 AND pdf_path_in_zip = lag(pdf_path_in_zip) OVER o THEN 0 ELSE 1 END AS b FROM k WINDOW o AS (PARTITION BY masterindex_id ORDER BY page_number)),
i AS (SELECT *, sum(b) OVER (PARTITION BY masterindex_id ORDER BY page_number) AS g FROM m), r AS (SELECT masterindex_id, min(page_number) AS s, max(page_number) AS e FROM i WHERE p GROUP BY masterindex_id, g),
z AS (SELECT masterindex_id, CAST(to_json(list(struct_pack(start_page := s, end_page := e) ORDER BY s, e)) AS VARCHAR) AS positive_segments FROM r GROUP BY 1)
SELECT masterindex_id, 'human_reviewed_pages_only' AS ground_truth_scope, count(*) AS reviewed_page_count, CAST(to_json(list(struct_pack(page := page_number, pdf_path_in_zip := pdf_path_in_zip, label := label) ORDER BY page_number, pdf_path_in_zip)) AS VARCHAR) AS pages, coalesce(any_value(positive_segments), '[]') AS positive_segments FROM k LEFT JOIN z USING (masterindex_id) GROUP BY masterindex_id""")


def _metric_sql() -> str:
    def row(name: str, value: str, a: str = "NULL", b: str = "NULL") -> str:
        return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value, CAST({a} AS BIGINT) AS numerator, CAST({b} AS BIGINT) AS denominator, 'human_reviewed_pages_only' AS scope FROM c"

    def share(name: str, a: str, b: str) -> str:
        return row(name, f"CASE WHEN {b} = 0 THEN 0 ELSE CAST({a} AS DOUBLE) / ({b}) END", a, b)

    counts = [row(n, c, c, "n") for n, c in (("evaluated_pages", "n"), ("true_positive", "tp"), ("false_positive", "fp"), ("false_negative", "fn"), ("true_negative", "tn"), ("unclear_predictions", "un"), ("correct_predictions", "ok"))]
    shares = [share("precision", "tp", "(tp + fp)"), share("recall", "tp", "(tp + fn)"), share("accuracy", "ok", "n"), share("specificity", "tn", "(tn + fp)"), share("unclear_rate", "un", "n")]
    f1 = row("f1", "CASE WHEN tp = 0 THEN 0 ELSE 2 * (tp / CAST(tp + fp AS DOUBLE)) * (tp / CAST(tp + fn AS DOUBLE)) / (tp / CAST(tp + fp AS DOUBLE) + tp / CAST(tp + fn AS DOUBLE)) END")
    return f"""WITH {_LATEST}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 'target' AND actual = 'target') AS tp, count(*) FILTER (WHERE label = 'target' AND actual = 'other') AS fp,
 count(*) FILTER (WHERE label <> 'target' AND actual = 'target') AS fn, count(*) FILTER (WHERE label = 'other' AND actual = 'other') AS tn, count(*) FILTER (WHERE label = 'unclear') AS un, count(*) FILTER (WHERE label = actual) AS ok FROM now WHERE actual IN ('target', 'other'))
 {" UNION ALL ".join([*counts, *shares, f1])}"""


_add("confusion_metrics", lambda t: review.metrics(screening.latest_results(t.screening), "label", "actual"), _metric_sql())
_add("review_errors", lambda t: review.errors(screening.latest_results(t.screening), "label", "actual").select("masterindex_id", "source_page_number", "label", "actual"), f"WITH {_LATEST} SELECT masterindex_id, source_page_number, label, actual FROM now WHERE actual IS NOT NULL AND label IS DISTINCT FROM actual")
_PAGES = "SELECT source AS masterindex_id, lang || '.pdf' AS pdf_path_in_zip, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS pdf_order_in_masterindex, CASE WHEN doc_id % 17 <> 0 THEN doc_id END AS source_page_number FROM documents"
_add(
    "page_numbering",
    lambda t: pages.number_pages(t.raw("documents").select(F.col("source").alias("masterindex_id"), F.concat("lang", F.lit(".pdf")).alias("pdf_path_in_zip"), F.when(F.col("lang") == "en", 1).when(F.col("lang") == "de", 2).otherwise(3).alias("pdf_order_in_masterindex"), F.when(F.col("doc_id") % 17 != 0, F.col("doc_id")).alias("source_page_number"))),
    f"WITH p AS ({_PAGES}) SELECT *, CASE WHEN source_page_number IS NOT NULL THEN CAST(count(source_page_number) OVER (PARTITION BY masterindex_id ORDER BY pdf_order_in_masterindex, pdf_path_in_zip, source_page_number ROWS UNBOUNDED PRECEDING) AS INT) END AS page_number FROM p",
)
_add(
    "inventory_order",
    lambda t: order_and_count(t.raw("part"), ["p_brand"], [F.col("p_name"), F.col("p_partkey")], "pdf_order", "pdf_count").select("p_brand", "p_partkey", "pdf_order", "pdf_count"),
    "WITH c AS (SELECT p_brand, count(*) AS pdf_count FROM part GROUP BY 1) SELECT p_brand, p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS INT) AS pdf_order, pdf_count FROM part JOIN c USING (p_brand)",
)
_add(
    "page_zoom",
    lambda t: t.raw("part").select("p_partkey", F.round(pages.page_zoom((F.col("p_size") * 30 - 60).cast("double"), F.col("p_retailprice").cast("double")), 9).alias("zoom")),
    "WITH p AS (SELECT p_partkey, CAST(p_size * 30 - 60 AS DOUBLE) AS w, CAST(p_retailprice AS DOUBLE) AS h FROM part), z AS (SELECT *, greatest(CAST(200 AS DOUBLE) / 72, 1024 / nullif(least(w, h), 0)) AS u FROM p) SELECT p_partkey, round(CASE WHEN w <= 0 OR h <= 0 THEN CAST(200 AS DOUBLE) / 72 ELSE least(u, 2400 / greatest(w, h)) END, 9) AS zoom FROM z",
)
_add(
    "quality_ladder",
    lambda t: t.raw("part").select("p_partkey", pages.quality_status(F.col("p_size") * 100, F.lit(1000), (F.col("p_partkey") % 1000).cast("double") / 1000, (F.col("p_partkey") % 50).cast("double"), F.col("p_partkey") % 31 == 0).alias("quality_status")),
    "SELECT p_partkey, CASE WHEN p_partkey % 31 = 0 THEN 'corrupt' WHEN p_size < 5 THEN 'too_small' WHEN p_partkey % 1000 >= 995 THEN 'likely_blank' WHEN p_partkey % 50 < 8 THEN 'low_contrast' ELSE 'usable' END AS quality_status FROM part",
)
_add(
    "retention_plan",
    lambda t: review.retention_plan(t.raw("events").select("event_id", F.when(F.col("event_id") % 19 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("never").alias("rendered_at_utc")), F.lit("2024-03-01 00:00:00").cast("timestamp"), exists=F.col("event_id") % 3 != 0).select("event_id", "age_days", "deletion_status"),
    "WITH e AS (SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN date_trunc('second', ts) END AS made FROM events), a AS (SELECT *, CAST(floor((epoch(TIMESTAMP '2024-03-01 00:00:00') - epoch(made)) / 86400) AS BIGINT) AS age_days FROM e) SELECT event_id, age_days, CASE WHEN made IS NULL THEN 'missing_timestamp' WHEN age_days < 30 THEN 'retention_not_reached' WHEN event_id % 3 = 0 THEN 'already_missing' ELSE 'to_delete' END AS deletion_status FROM a",
)
_add(
    "text_normal_forms",
    lambda t: t.raw("documents").select("doc_id", text.safe_folder_name("source").alias("folder"), text.to_boolean(F.when(F.col("doc_id") % 3 == 0, " Yes ").when(F.col("doc_id") % 3 == 1, "no")).alias("flag"), text.is_pdf(F.concat(F.lit("a/b."), F.col("lang"), F.lit(".PDF"))).alias("pdf"), F.sha2(F.col("text").cast("binary"), 256).alias("digest")),
    "SELECT doc_id, source AS folder, doc_id % 3 = 0 AS flag, true AS pdf, sha256(text) AS digest FROM documents",
)
