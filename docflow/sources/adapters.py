"""Logical tables over the benchmark tables, as SQL that Spark and DuckDB both read.

`{events}` and the like stand for relations. In Spark they are DataFrames, elsewhere table names or subqueries. `copies` is
`events` with a column k from 0 to 5 for each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COPIES = "(SELECT e.*, v.k FROM events e CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) v(k))"
_STACK = "CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS stack_id"

TABLES = {
    "event": f"""SELECT {_STACK}, event_id AS entry_id, ts AS entry_time,
  CASE event_type WHEN 'signup' THEN 'import' WHEN 'click' THEN 'analyse' WHEN 'error' THEN 'supervise' WHEN 'view' THEN 'verify' ELSE 'export' END AS state,
  CASE event_id % 3 WHEN 0 THEN 'core' WHEN 1 THEN 'web' END AS component,
  CASE event_id % 7 WHEN 0 THEN 'System' WHEN 1 THEN ' system' WHEN 2 THEN 'SVC_load' WHEN 3 THEN 'Worker A' WHEN 4 THEN 'worker a ' WHEN 5 THEN 'qa_1' ELSE '' END AS altered_by,
  CASE event_id % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'A' END AS category,
  CASE event_id % 4 WHEN 0 THEN 'S1' WHEN 1 THEN 'S2' END AS subsystem FROM {{events}}""",
    "document": f"""SELECT {_STACK}, 'P' || CAST(user_id % 3 AS STRING) AS process_id, 'D' || CAST(k AS STRING) AS doc_id,
  CASE WHEN k = 2 THEN NULL ELSE CAST(k % 2 AS INT) END AS subdoc_idx, event_id AS entry_id,
  CASE event_id % 3 WHEN 0 THEN 'open' ELSE 'done' END AS status, 'worker' AS altered_by, CAST(NULL AS STRING) AS remark,
  'class' || CAST(k AS STRING) AS doc_class, 'file' || CAST(event_id AS STRING) AS export_name, ts AS entry_time,
  CASE (event_id + k) % 8 WHEN 0 THEN 'System' WHEN 1 THEN 'qa_1 ' WHEN 2 THEN ' QA_2' WHEN 3 THEN 'SVC_x' WHEN 4 THEN 'Worker A' WHEN 5 THEN '' WHEN 6 THEN 'other' END AS verified_by,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS last_entry, 'final' AS doc_state, CAST(NULL AS STRING) AS doc_substate
  FROM {{copies}} WHERE event_type IN ('purchase', 'click') AND k < 3""",
    "field": f"""SELECT {_STACK}, 'P' || CAST(user_id % 3 AS STRING) AS process_id, 'D' || CAST(k % 3 AS STRING) AS doc_id,
  CASE WHEN k % 3 = 2 THEN NULL ELSE CAST((k % 3) % 2 AS INT) END AS subdoc_idx, event_id AS entry_id,
  CASE (event_id + k) % 5 WHEN 0 THEN ' label_code' WHEN 1 THEN 'LABEL_CODE ' WHEN 2 THEN 'Label_Code' WHEN 3 THEN 'label_code' ELSE 'amount' END AS field_name,
  CASE (event_id + k) % 6 WHEN 0 THEN ' c1' WHEN 1 THEN 'C2 ' WHEN 2 THEN 'c3' WHEN 3 THEN '  ' WHEN 4 THEN 'C9' ELSE 'C1' END AS field_value,
  CASE event_id % 3 WHEN 0 THEN 'System' ELSE 'worker' END AS altered_by, CAST((event_id + k) % 2 AS INT) AS show_in_verifier,
  CASE event_id % 2 WHEN 0 THEN 'set' ELSE 'fix' END AS action, CAST(NULL AS STRING) AS quality, 'r' || CAST(k AS STRING) AS rating,
  CASE WHEN k >= 3 AND event_id % 2 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS entry_time
  FROM {{copies}} WHERE event_type IN ('purchase', 'click')""",
    "page_map": f"""SELECT {_STACK}, 'P' || CAST(user_id % 3 AS STRING) AS process_id,
  'D' || CAST((k + CASE WHEN event_type = 'click' THEN event_id % 2 ELSE 0 END) % 3 AS STRING) AS doc_id,
  CASE WHEN k = 2 THEN NULL ELSE CAST((k % 3) % 2 AS INT) END AS subdoc_idx, event_id AS entry_id,
  CASE WHEN event_id % 13 = 0 AND k = 3 THEN NULL WHEN k = 1 THEN '001' WHEN k = 4 THEN '1' WHEN k = 5 AND event_id % 7 = 0 THEN 'I0' ELSE 'I' || CAST(k AS STRING) END AS image_id,
  CAST(k AS INT) AS seqno, 'page' AS relation, CAST((event_id % 4) * 90 AS INT) AS rotation, ts AS entry_time
  FROM {{copies}} WHERE event_type = 'purchase' AND k <> 4 OR event_type = 'click' AND k <> 2""",
    "process": f"""SELECT {_STACK}, 'P' || CAST(user_id % 3 AS STRING) AS process_id, event_id AS entry_id FROM {{events}} WHERE event_type IN ('purchase', 'click')""",
    "code_lookup": """SELECT CASE n_nationkey WHEN 0 THEN 'c1 ' WHEN 1 THEN ' C2' WHEN 2 THEN 'C3' WHEN 3 THEN '' WHEN 4 THEN '' WHEN 5 THEN 'C5' ELSE 'X' || CAST(n_nationkey AS STRING) END AS label_code,
  n_name AS category, 'region' || CAST(n_regionkey AS STRING) AS class_name, 'keep' AS action, CAST(NULL AS STRING) AS detail FROM {nation}""",
    "qa": """SELECT CASE s_suppkey WHEN 1 THEN 'QA_1' WHEN 2 THEN ' qa_2' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN 'qa_1 ' WHEN 6 THEN 'SVC_QA' ELSE 'QA-' || CAST(s_suppkey AS STRING) END AS id FROM {supplier}""",
    "screening": """SELECT d.source AS masterindex_id, d.lang || '.pdf' AS pdf_path_in_zip, d.doc_id AS source_page_number, d.doc_id AS page_number,
  CASE WHEN d.doc_id % 9 = 0 THEN '' ELSE 'h' || CAST(d.doc_id % 3 AS STRING) END AS image_sha256, d.doc_id * 2 + s.v AS seq,
  CASE (d.doc_id + s.v) % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'render_failed' WHEN 2 THEN 'quality_rejected' ELSE 'success' END AS status,
  CASE WHEN (d.doc_id + s.v) % 10 < 3 THEN 'unclear' WHEN d.n_chars % 3 = 0 THEN 'target' WHEN d.n_chars % 11 = 1 THEN 'unclear' ELSE 'other' END AS label,
  CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST((d.doc_id * 37) % 100 AS DOUBLE) / 100 END AS confidence,
  CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 1 THEN 'target' ELSE 'other' END AS actual
  FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id JOIN (SELECT 0 AS v UNION ALL SELECT 1 AS v) s ON d.doc_id % 3 >= s.v""",
    "review": """SELECT doc_id AS page_number, source AS masterindex_id, lang || '.pdf' AS pdf_path_in_zip,
  CASE doc_id % 6 WHEN 0 THEN ' Accepted ' WHEN 1 THEN 'corrected' WHEN 2 THEN 'UNREADABLE' WHEN 3 THEN 'out_of_scope' WHEN 4 THEN 'accepted' END AS review_status,
  CASE doc_id % 5 WHEN 0 THEN 'Target' WHEN 1 THEN 'other ' WHEN 2 THEN '' WHEN 3 THEN 'unclear' END AS reviewed_label,
  CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'bogus' WHEN 2 THEN 'target' ELSE 'other' END AS predicted_label FROM {documents}""",
}
_NEEDS = {"code_lookup": ["nation"], "qa": ["supplier"], "screening": ["documents", "labels"], "review": ["documents"], "event": ["events"], "process": ["events"]}


def logical(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A logical table as DataFrame over the Parquet tables of a folder."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    needs = _NEEDS.get(name, ["copies"])
    given = {t: read("events").withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(6)]))) if t == "copies" else read(t) for t in needs}
    return spark.sql(TABLES[name], **given)


def sql(name: str) -> str:
    """The same table as a subquery for DuckDB."""
    names = {t: t for t in ("events", "nation", "supplier", "documents", "labels")}
    return "(" + TABLES[name].format(copies=COPIES, **names) + ")"
