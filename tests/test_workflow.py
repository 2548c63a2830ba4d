"""Hand-made rows for each rule of the workflow stages."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docflow.operators.checks import ContractError, check_lookup, check_output, check_processes, require_columns, require_inputs, validate_identifier
from docflow.plans import runner, workflow

T = [datetime(2024, 1, 1, h) for h in range(10)]
EVENT = "stack_id string, entry_id long, entry_time timestamp_ntz, state string, component string, altered_by string, category string, subsystem string"
DOCUMENT = "stack_id string, process_id string, doc_id string, subdoc_idx int, entry_id long, status string, altered_by string, remark string, doc_class string, export_name string, entry_time timestamp_ntz, verified_by string, last_entry int, doc_state string, doc_substate string"
FIELD = "stack_id string, process_id string, doc_id string, subdoc_idx int, entry_id long, field_name string, field_value string, altered_by string, show_in_verifier int, action string, quality string, rating string, entry_time timestamp_ntz"
PAGE = "stack_id string, process_id string, doc_id string, subdoc_idx int, entry_id long, image_id string, seqno int, relation string, rotation int, entry_time timestamp_ntz"


def event(stack, entry, at, state, by="x", category=None):
    return (stack, entry, at, state, "core", by, category, None)


def document(stack, entry, doc, verifier, sub=0, process="p"):
    return (stack, process, doc, sub, entry, None, None, None, None, None, T[0], verifier, 1, None, None)


def label(stack, entry, doc, value, at=T[0], name="LABEL_CODE", sub=0, process="p"):
    return (stack, process, doc, sub, entry, name, value, None, 1, None, None, None, at)


def page(stack, entry, image, doc, sub=0, process="p"):
    return (stack, process, doc, sub, entry, image, 0, None, 0, T[0])


@pytest.fixture(scope="module")
def lookups(spark):
    return spark.createDataFrame([("c1 ", "A", "k", "a", "d"), ("", "B", "k", "a", "d"), (" ", "B", "k", "a", "d")], "label_code string, category string, class_name string, action string, detail string"), spark.createDataFrame([(" qa1",), ("SYSTEM",), (None,), ("",)], "id string")


def test_completed_stacks(spark):
    rows = [event("ok", 1, T[1], "import"), event("ok", 2, T[2], "export"), event("in", 1, T[1], "import"), event("out", 1, T[1], "export"), event("back", 1, T[3], "import"), event("back", 2, T[2], "export"), event("same", 1, T[1], "import"), event("same", 2, T[1], "export"), event("null", 1, None, "import"), event("null", 2, T[1], "export")]
    assert {r.stack_id for r in workflow.completed_stacks(spark.createDataFrame(rows, EVENT)).collect()} == {"ok", "same"}


def test_document_labels(spark, lookups):
    lookup, qa = lookups
    events = spark.createDataFrame([event("s", 1, T[1], "export"), event("s", 2, T[2], "export"), event("s", 3, T[2], "export")], EVENT)
    docs = [document("s", 3, f"d{k}", v) for k, v in enumerate(["QA1 ", "system", "svc_1", "Bob", None, " ", "Bob", "Bob"])] + [document("s", 2, "old", "Bob"), document("s", 3, "nosub", "Bob", sub=None)]
    fields = [label("s", 3, f"d{k}", "C1") for k in range(6)]
    fields += [label("s", 3, "d6", "C9", T[1]), label("s", 3, "d6", " ", T[2])]  # a newer blank wins
    fields += [label("s", 3, "d7", " c1 ", T[1], " label_code "), label("s", 3, "d7", "C0", T[0]), label("s", 3, "nosub", "C1", sub=None)]
    out = workflow.document_labels(events, spark.createDataFrame(docs, DOCUMENT), spark.createDataFrame(fields, FIELD), lookup, qa, workflow.completed_stacks(events))
    got = {r.doc_id: (r.label_code, r.label_tier, r.training_label_quality, r.has_code_meaning) for r in out.collect()}
    assert got == {
        "d0": ("C1", "QA_VERIFIED", "GOLD", True),
        "d1": ("C1", "QA_VERIFIED", "GOLD", True),  # the list names SYSTEM
        "d2": ("C1", "SERVICE_ACCOUNT", "EXCLUDE", True),
        "d3": ("C1", "NON_QA_VERIFIER", "SILVER", True),
        "d4": ("C1", "MISSING_VERIFIER", "EXCLUDE", True),
        "d5": ("C1", "MISSING_VERIFIER", "EXCLUDE", True),
        "d6": (None, "MISSING_CODE", "EXCLUDE", False),
        "d7": ("c1", "NON_QA_VERIFIER", "SILVER", True),
        "nosub": (None, "MISSING_CODE", "EXCLUDE", False),  # null keys never match
    }
    assert len(out.columns) == 32 and len(workflow.training_documents(out).collect()) == 4


def test_grouping_changes(spark, lookups):
    lookup, qa = lookups
    events = spark.createDataFrame([event("s", 1, T[0], "import"), event("s", 2, T[1], "analyse"), event("s", 4, T[3], "analyse"), event("s", 5, T[4], "export")], EVENT)
    pages = [page("s", 2, "same", "a"), page("s", 5, "same", "a"), page("s", 2, "doc", "a"), page("s", 5, "doc", "b"), page("s", 2, "sub", "a", 0), page("s", 5, "sub", "a", 1), page("s", 2, "nulls", "a", None), page("s", 5, "nulls", "a", None), page("s", 2, "gone", "a"), page("s", 5, "new", "a"), page("s", 2, None, "a"), page("s", 4, "late", "a")]
    labels = workflow.document_labels(events, spark.createDataFrame([document("s", 5, "a", "Bob")], DOCUMENT), spark.createDataFrame([label("s", 5, "a", "C1")], FIELD), lookup, qa, workflow.completed_stacks(events))
    out = workflow.grouping_changes(events, spark.createDataFrame(pages, PAGE), workflow.completed_stacks(events), labels)
    got = {r.image_id: (r.page_presence, r.same_grouping, r.grouping_change_type, r.final_code) for r in out.collect()}
    assert got == {
        "same": ("BOTH", True, "UNCHANGED_GROUPING", "C1"),
        "doc": ("BOTH", False, "REGROUPED", None),
        "sub": ("BOTH", False, "REGROUPED", None),
        "nulls": ("BOTH", True, "UNCHANGED_GROUPING", None),
        "gone": ("ANALYSER_ONLY", None, "REMOVED_BEFORE_EXPORT", None),
        "new": ("EXPORT_ONLY", None, "ADDED_AT_EXPORT", "C1"),
        None: ("EXPORT_ONLY", None, "ADDED_AT_EXPORT", None),
    }


def test_stack_summary(spark, lookups):
    lookup, qa = lookups
    rows = [event("s", 1, datetime(2024, 1, 1, 0, 0, 0, 900_000), "import", "Bob", "A"), event("s", 2, datetime(2024, 1, 1, 1, 0, 1, 100_000), "export", "Bob ", "B"), event("s", 3, T[0], "verify", " system "), event("s", 4, T[0], "verify", "qa1")]
    events = spark.createDataFrame(rows, EVENT)
    empty = lambda s: spark.createDataFrame([], s)
    labels = workflow.document_labels(events, empty(DOCUMENT), empty(FIELD), lookup, qa, workflow.completed_stacks(events))
    changes = workflow.grouping_changes(events, empty(PAGE), workflow.completed_stacks(events), labels)
    r = workflow.stack_summary(events, workflow.completed_stacks(events), qa, labels, changes).first()
    assert (r.n_distinct_named_non_system_actors, r.n_system_events, r.n_known_qa_events, r.category, r.has_unambiguous_category) == (3, 1, 2, "B", False)
    assert r.hours_import_to_export == 3601 / 3600 and r.final_code_list == [] and r.n_final_documents is None and r.n_page_comparison_rows is None
    assert r.category_list == ["A", "B"] and r.subsystem_list == []


def test_contracts(spark, lookups):
    lookup, _ = lookups
    check_lookup(lookup)  # blank repeats pass
    with pytest.raises(ContractError):
        check_lookup(lookup.unionByName(lookup.withColumn("label_code", F.upper("label_code"))))
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    with pytest.raises(ContractError):
        check_output(df, ["a", "b"], "df")
    with pytest.raises(ContractError):
        check_output(df.where("a > 5"), ["a"], "df")
    assert check_output(df.distinct(), ["a"], "df") == 2
    for bad in (lambda: require_inputs({"a": df}, ["a", "b"]), lambda: require_columns(df, ["z"]), lambda: validate_identifier("a; b")):
        with pytest.raises(ContractError):
            bad()
    events = spark.createDataFrame([event("s", 1, T[0], "analyse"), event("s", 2, T[1], "export")], EVENT)
    check_processes(events, spark.createDataFrame([page("s", 1, "i", "a"), page("s", 2, "i", "b")], PAGE))
    with pytest.raises(ContractError):
        check_processes(events, spark.createDataFrame([page("s", 1, "i", "a"), page("s", 2, "i", "b", process="q")], PAGE))


def test_runner(spark, lookups, tmp_path):
    lookup, qa = lookups
    events = spark.createDataFrame([event("s", 1, T[0], "import"), event("s", 2, T[1], "analyse"), event("s", 3, T[2], "export")], EVENT)
    inputs = {"event": events, "document": spark.createDataFrame([document("s", 3, "a", "Bob")], DOCUMENT), "field": spark.createDataFrame([label("s", 3, "a", "C1")], FIELD), "page_map": spark.createDataFrame([page("s", 2, "i", "a"), page("s", 3, "i", "a")], PAGE), "qa": qa, "code_lookup": lookup}

    def store(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    said = []
    out = runner.run(inputs, store, say=said.append)
    assert len(said) == 5 and out["training_pages"].count() == 1 and out["training_documents"].count() == 1
    assert runner.run(inputs, store, confirm=lambda: False, say=said.append) == {}
    with pytest.raises(ContractError):
        runner.run({}, store)
    twice = inputs | {"page_map": spark.createDataFrame([page("s", 2, "i", "a"), page("s", 3, "i", "a"), page("s", 3, "i", "b")], PAGE)}
    with pytest.raises(ContractError, match="grouping_changes"):
        runner.run(twice, lambda name, df: df, say=said.append)
