"""Column functions on text. SQL trimming strips spaces only, `clean_text` all Unicode white space; they do not mix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_key(c: Column | str) -> Column:
    """Spaces stripped, upper case: the form in which codes, actors and field names are compared."""
    return F.upper(F.trim(c))


def non_blank(c: Column | str) -> Column:
    """The text without surrounding spaces; null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def has_text(c: Column | str) -> Column:
    """Whether anything but spaces is there; never null."""
    return non_blank(c).isNotNull()


def clean_text(c: Column | str) -> Column:
    """Unicode white space stripped, lower case; null becomes the empty text."""
    return F.coalesce(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit(""))


def to_boolean(c: Column | str) -> Column:
    """true, 1 and yes in any case are true; everything else and null are false."""
    c = F.col(c) if isinstance(c, str) else c
    return clean_text(c.cast("string")).isin("true", "1", "yes")


def safe_folder_name(c: Column | str) -> Column:
    """Characters outside letters, digits, `_` and `-` become `_`, outer `_` go; `document` where nothing is left."""
    kept = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"[^A-Za-z0-9_-]", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit("document"))


def file_name(c: Column | str) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def file_stem(c: Column | str) -> Column:
    return F.regexp_replace(file_name(c), r"(?<=.)\.[^.]*$", "")


def is_pdf(c: Column | str) -> Column:
    return F.lower(file_name(c)).rlike(r".\.pdf$")


def text_number(c: Column | str) -> Column:
    """The whole number a text holds, rounded; null where it holds none."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("decimal(38,0)")


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole to two digits; null for an empty whole."""
    return F.round(100.0 * part.cast("double") / F.nullif(whole, F.lit(0)), 2)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Boundaries of seconds crossed, for timestamps without time zone."""
    at = lambda c: F.unix_timestamp((F.col(c) if isinstance(c, str) else c).cast("timestamp"))
    return at(end) - at(start)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 for an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.nullif(whole, F.lit(0)))
