"""python -m docflow SCHEMA [--yes]: runs the workflow stages over the tables of a catalog schema."""

from __future__ import annotations

import argparse
import sys

from docflow.operators.checks import ContractError, catalog_tables, require_inputs, require_output, use_schema
from docflow.plans import runner
from docflow.session import session
from docflow.sources.files import save_table, save_view


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docflow", description=__doc__)
    parser.add_argument("schema")
    parser.add_argument("--yes", action="store_true", help="do not ask")
    given = parser.parse_args(args)
    spark = session()
    try:
        schema = use_schema(spark, given.schema)
        require_inputs({t.lower() for t in catalog_tables(spark, schema)}, runner.REQUIRED)
        inputs = {name: spark.table(f"{schema}.{name}") for name in runner.REQUIRED}
        ask = None if given.yes else lambda: input(f"Replace the outputs in {schema}? [y/N] ").strip().lower() in ("y", "yes")

        def store(name, df):
            save_table(df, f"{schema}.{name}")
            return require_output(spark, f"{schema}.{name}")

        done = runner.run(inputs, store, confirm=ask)
        for name in ("training_documents", "training_pages"):
            if name in done:
                save_view(done[name], name)
    except ContractError as e:
        print(f"failed: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
