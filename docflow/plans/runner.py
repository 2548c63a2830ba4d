"""Runs the workflow stages in order: contracts before, a written table for each stage, contracts after."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from docflow.config import DEFAULT, Config
from docflow.operators.checks import check_lookup, check_output, check_processes, require_inputs
from docflow.plans import workflow as w

REQUIRED = ("event", "document", "field", "page_map", "qa", "code_lookup")


def run(inputs: Mapping[str, DataFrame], store: Callable[[str, DataFrame], DataFrame], config: Config = DEFAULT, confirm: Callable[[], bool] | None = None, say: Callable[[str], None] = print) -> dict[str, DataFrame]:
    """All stage outputs by name. `store` materialises an output once and returns what to read; a broken contract stops the run."""
    require_inputs(inputs, REQUIRED)
    check_lookup(inputs["code_lookup"])
    if confirm is not None and not confirm():
        say("not confirmed")
        return {}
    i, done = inputs, {}
    stages: list[tuple[str, Callable[[], DataFrame]]] = [
        ("completed_stacks", lambda: w.completed_stacks(i["event"], config)),
        ("document_labels", lambda: w.document_labels(i["event"], i["document"], i["field"], i["code_lookup"], i["qa"], done["completed_stacks"], config)),
        ("page_labels", lambda: w.page_labels(i["page_map"], done["document_labels"], config)),
        ("grouping_changes", lambda: w.grouping_changes(i["event"], i["page_map"], done["completed_stacks"], done["document_labels"], config)),
        ("stack_summary", lambda: w.stack_summary(i["event"], done["completed_stacks"], i["qa"], done["document_labels"], done["grouping_changes"], config)),
    ]
    for name, make in stages:
        began = time.monotonic()
        if name == "grouping_changes":
            check_processes(i["event"], i["page_map"], config)
        done[name] = store(name, make())
        n = check_output(done[name], w.GRAINS[name], name)
        say(f"{name}: {n} rows, {time.monotonic() - began:.1f} s")
    done["training_documents"] = w.training_documents(done["document_labels"])
    done["training_pages"] = w.training_pages(done["page_labels"])
    return done
