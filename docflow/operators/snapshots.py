"""First and last rows of a group, by a total order. Nulls sort as the largest value, as in the source dialect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def earliest(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def ranked_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. The planner limits each group before and after the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def last_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return ranked_one(df, keys, [latest(c) for c in order])


def first_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return ranked_one(df, keys, [earliest(c) for c in order])


def state_snapshot(events: DataFrame, state: str, *, last: bool) -> DataFrame:
    """(stack_id, entry_id, entry_time, component) of a stack's first or last event in a state."""
    own = events.where(F.col("state") == state).select("stack_id", "entry_id", "entry_time", "component")
    return (last_by if last else first_by)(own, ["stack_id"], "entry_time", "entry_id")


def running_number(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "page_number") -> DataFrame:
    """A number from 1 that runs on over all rows of a group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def order_and_count(df: DataFrame, group: Sequence[str], order: Sequence[Column], at: str, count: str) -> DataFrame:
    w = Window.partitionBy(*group)
    return df.withColumn(at, F.row_number().over(w.orderBy(*order))).withColumn(count, F.count(F.lit(1)).over(w))


def segments(pages: DataFrame, group: str, page: str, positive: Column, within: str) -> DataFrame:
    """(group, start_page, end_page): runs of consecutive positive pages within one file.

    The break is taken over all rows in order, so repeated pages and changes of file end a run.
    """
    order = [F.col(page), F.coalesce(F.col(within), F.lit("")), F.col("ordinal")]
    w = Window.partitionBy(group).orderBy(*order)
    rows = pages.withColumn("__p", F.coalesce(positive, F.lit(False)))
    goes_on = F.lag("__p").over(w) & (F.col(page) == F.lag(page).over(w) + 1) & (F.col(within) == F.lag(within).over(w))
    marked = rows.withColumn("__break", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    island = F.sum("__break").over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = marked.withColumn("__island", island).where("__p")
    return runs.groupBy(group, "__island").agg(F.min(page).alias("start_page"), F.max(page).alias("end_page")).drop("__island")
