"""Data-quality contracts. A violated contract raises `ContractError`."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.config import DEFAULT, Config
from docflow.functions.text import has_text, norm_key
from docflow.operators.snapshots import state_snapshot


class ContractError(Exception):
    pass


def validate_identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ContractError(f"{name!r} is no identifier")
    return name.upper()


def require_inputs(given: Mapping[str, DataFrame] | Iterable[str], required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(given))
    if missing:
        raise ContractError(f"missing inputs: {', '.join(missing)}")


def catalog_tables(spark: SparkSession, schema: str | None = None) -> set[str]:
    return {t.name.upper() for t in spark.catalog.listTables(schema)}


def use_schema(spark: SparkSession, name: str) -> str:
    """Make a schema the current one; its name must be an identifier and the schema must exist."""
    schema = validate_identifier(name)
    if not spark.catalog.databaseExists(schema):
        raise ContractError(f"there is no schema {schema}")
    spark.catalog.setCurrentDatabase(schema)
    return schema


def require_output(spark: SparkSession, name: str) -> DataFrame:
    """The table a stage must have left behind."""
    if not spark.catalog.tableExists(name):
        raise ContractError(f"the stage did not create {name}")
    return spark.table(name)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{what} lacks the columns {', '.join(missing)}")
    return df


def duplicate_groups(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def grain_report(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """One row: n_rows and n_duplicate_keys, in one pass over the groups."""
    groups = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_duplicate_keys"))


def check_output(df: DataFrame, grain: Sequence[str], name: str) -> int:
    """Not empty and unique on its grain; the number of rows."""
    row = grain_report(df, grain).first()
    if not row["n_rows"]:
        raise ContractError(f"{name} is empty")
    if row["n_duplicate_keys"]:
        raise ContractError(f"{name} has {row['n_duplicate_keys']} repeated keys of {', '.join(grain)}")
    return row["n_rows"]


def lookup_duplicates(lookup: DataFrame) -> DataFrame:
    """Codes that occur more than once after normalisation; blank codes do not count."""
    return lookup.where(has_text("label_code")).groupBy(norm_key("label_code").alias("normalized_code")).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_lookup(lookup: DataFrame) -> None:
    if n := lookup_duplicates(lookup).count():
        raise ContractError(f"{n} label codes are defined more than once")


def unstable_processes(events: DataFrame, page_map: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Pages whose process id differs between the first analysis and the last export; of all stacks."""

    def pages(last: bool, name: str) -> DataFrame:
        at = state_snapshot(events, config.states.exported if last else config.states.analysed, last=last)
        own = page_map.join(at.select("stack_id", "entry_id"), ["stack_id", "entry_id"])
        return own.select("stack_id", "image_id", F.col("process_id").alias(name)).distinct()

    both = pages(False, "analyser_process_id").join(pages(True, "export_process_id"), ["stack_id", "image_id"])
    return both.where(~F.col("analyser_process_id").eqNullSafe(F.col("export_process_id")))


def check_processes(events: DataFrame, page_map: DataFrame, config: Config = DEFAULT) -> None:
    if n := unstable_processes(events, page_map, config).count():
        raise ContractError(f"{n} pages changed their process between analysis and export")
