"""Page inventory: numbering, render zoom, image quality ladder. Rendering itself is an injected callable."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.snapshots import order_and_count, running_number

#: Fixed values of the render and quality rules.
BASE_ZOOM = 200 / 72
LEAST_SHORT_EDGE, MOST_LONG_EDGE = 1024, 2400
LEAST_PIXELS, WHITE_SHARE, LEAST_STDDEV, WHITE_FROM = 500, 0.995, 8.0, 250


def wrapper_depth(paths: DataFrame, column: str = "path") -> int:
    """How many leading folders all paths share while each keeps two parts at least; one aggregation."""
    parts = paths.select(F.split(column, "/").alias("p"))
    found = parts.agg(F.min(F.size("p")).alias("least"), F.min("p").alias("low"), F.max("p").alias("high")).first()
    if found is None or found["least"] is None:
        return 0
    depth = 0
    # Arrays sort by their parts, so what the least and the greatest share, all share.
    while depth < found["least"] - 2 and found["low"][depth] == found["high"][depth]:
        depth += 1
    return depth


def members(entries: DataFrame) -> DataFrame:
    """(masterindex_id, zip_path, path) of container entries (zip_path, path, is_dir), for `inventory`.

    Folders that all PDF paths of a container share are wrappers and skipped, while each PDF keeps a folder and its name. The next folder names the
    master index; a folder without a file stays with a null path.
    """
    from docflow.functions.text import is_pdf

    parts = F.split(F.trim(F.col("path"), F.lit("/")), "/")
    own = entries.where(F.trim(F.col("path"), F.lit("/")) != "").select("zip_path", "path", F.coalesce("is_dir", F.lit(False)).alias("is_dir"), parts.alias("parts"))
    # Arrays sort by their parts, so what the least and the greatest share, all share.
    pdfs = own.where(~F.col("is_dir") & is_pdf("path")).groupBy("zip_path").agg(F.min(F.size("parts")).alias("least"), F.min("parts").alias("low"), F.max("parts").alias("high"))
    free = F.greatest(F.col("least") - 2, F.lit(0))
    differ = F.array_position(F.transform(F.slice(F.arrays_zip("low", "high"), 1, free), lambda x: x["low"] == x["high"]), False)
    wrapped = pdfs.select("zip_path", F.slice("low", 1, F.when(differ > 0, (differ - 1).cast("int")).otherwise(free)).alias("prefix"))
    joined = own.join(wrapped, "zip_path", "left").withColumn("prefix", F.coalesce("prefix", F.array().cast("array<string>")))
    depth, n = F.size("prefix"), F.size("parts")
    inside = joined.where((n > depth) & (F.slice("parts", 1, depth) == F.col("prefix")) & ((n >= depth + 2) | F.col("is_dir")))
    return inside.select(F.element_at("parts", depth + 1).alias("masterindex_id"), "zip_path", F.when(~F.col("is_dir"), F.col("path")).alias("path"))


def inventory(members: DataFrame) -> DataFrame:
    """PDF members of containers, numbered within their master index; a master index without a PDF stays as `missing_pdf`.

    members: masterindex_id, zip_path, path (null where a folder holds nothing).
    """
    from docflow.functions.text import file_name, is_pdf

    pdfs = members.where(is_pdf("path"))
    numbered = order_and_count(pdfs, ["masterindex_id"], [F.col("path"), F.col("zip_path")], "pdf_order_in_masterindex", "pdf_count_in_masterindex")
    ready = numbered.select("masterindex_id", "zip_path", F.col("path").alias("pdf_path_in_zip"), file_name("path").alias("pdf_filename"), "pdf_order_in_masterindex", F.col("pdf_count_in_masterindex").cast("int"), F.lit("ready").alias("status"))
    none = members.join(pdfs.select("masterindex_id").distinct(), "masterindex_id", "left_anti").groupBy("masterindex_id").agg(F.min("zip_path").alias("zip_path"))
    missing = none.select("masterindex_id", "zip_path", F.lit(None).cast("string").alias("pdf_path_in_zip"), F.lit(None).cast("string").alias("pdf_filename"), F.lit(None).cast("int").alias("pdf_order_in_masterindex"), F.lit(0).alias("pdf_count_in_masterindex"), F.lit("missing_pdf").alias("status"))
    return ready.unionByName(missing)


def number_pages(pages: DataFrame) -> DataFrame:
    """page_number over all files of a master index; rows without a source page (file not opened) get none and do not count.

    Pages are numbered within their file and moved on by the pages of the files before, so that a large master index is as many tasks as it
    has files.
    """
    file = ["masterindex_id", "pdf_order_in_masterindex", "pdf_path_in_zip"]
    real = pages.where(F.col("source_page_number").isNotNull())
    own = running_number(real, file, [F.col("source_page_number")], "__own")
    order = [F.col(c).asc_nulls_last() for c in file[1:]]
    before = Window.partitionBy("masterindex_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sizes = real.groupBy(*file).agg(F.count(F.lit(1)).alias("__n"))
    moved = sizes.select(*[F.col(c).alias(f"__{c}") for c in file], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in file]
    numbered = own.join(moved, same[0] & same[1] & same[2]).select(*pages.columns, (F.col("__own") + F.col("__before")).cast("int").alias("page_number"))
    return numbered.unionByName(pages.where(F.col("source_page_number").isNull()).withColumn("page_number", F.lit(None).cast("int")))


def page_zoom(width: Column, height: Column) -> Column:
    """The zoom for a page's points: 200 dpi, more for small short edges, less for long edges above the limit."""
    short, long = F.least(width, height), F.greatest(width, height)
    up = F.when(short * BASE_ZOOM < LEAST_SHORT_EDGE, LEAST_SHORT_EDGE / short).otherwise(F.lit(BASE_ZOOM))
    down = F.when(long * up > MOST_LONG_EDGE, MOST_LONG_EDGE / long).otherwise(up)
    return F.when((width <= 0) | (height <= 0), F.lit(BASE_ZOOM)).otherwise(down)


def quality_status(width: Column, height: Column, white_share: Column, stddev: Column, failed: Column) -> Column:
    return (
        F.when(F.coalesce(failed, F.lit(False)) | width.isNull() | height.isNull(), "corrupt")
        .when((width < LEAST_PIXELS) | (height < LEAST_PIXELS), "too_small")
        .when(white_share >= WHITE_SHARE, "likely_blank")
        .when(stddev < LEAST_STDDEV, "low_contrast")
        .otherwise("usable")
    )


def image_quality(images: DataFrame, decode: Callable[[bytes], Any]) -> DataFrame:
    """quality_status, width, height and file_size of images (their columns, with `content`), by pixel statistics.

    `decode` gives the grey values of an image as a two-dimensional array of bytes. What it cannot decode is corrupt, without sizes.
    """
    kept = [f for f in images.schema.fields if f.name != "content"]
    fields = T.StructType([*kept, *T.StructType.fromDDL("width int, height int, file_size long, white_share double, stddev double").fields])

    def run(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for frame in frames:
            found = []
            for content in frame["content"]:
                try:
                    grey = np.asarray(decode(bytes(content)))
                    found.append((grey.shape[1], grey.shape[0], len(content), float((grey >= WHITE_FROM).mean()) if grey.size else 1.0, float(grey.std()) if grey.size else 0.0))
                except Exception:  # noqa: BLE001 - an image that cannot be read is a finding
                    found.append((None,) * 5)
            more = pd.DataFrame(found, columns=["width", "height", "file_size", "white_share", "stddev"])
            yield pd.concat([frame.drop(columns=["content"]).reset_index(drop=True), more.astype({"width": "Int32", "height": "Int32", "file_size": "Int64"})], axis=1)

    found = images.mapInPandas(run, fields)
    status = quality_status(F.col("width"), F.col("height"), F.col("white_share"), F.col("stddev"), F.lit(False))
    return found.withColumn("quality_status", status).drop("white_share", "stddev")


def image_name(path: Column, order: Column, page: Column) -> Column:
    from docflow.functions.text import file_stem, safe_folder_name

    return F.concat(F.format_string("pdf_%03d_", order), safe_folder_name(file_stem(path)), F.format_string("/page_%04d.png", page))


def render(documents: DataFrame, renderer: Callable[[bytes], Iterable[dict[str, Any]]], schema: str) -> DataFrame:
    """Rows of an injected renderer for each document (columns masterindex_id, pdf_path_in_zip, content).

    A renderer yields one mapping for each page; if it raises, the document gives one row with `error` and no page number.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                own = {"masterindex_id": r["masterindex_id"], "pdf_path_in_zip": r["pdf_path_in_zip"]}
                try:
                    rows = [own | page for page in renderer(r["content"])]
                except Exception as e:  # noqa: BLE001 - one broken document must not end the others
                    rows = [own | {"error": f"{type(e).__name__}: {e}", "render_status": "pdf_open_failed"}]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return documents.select("masterindex_id", "pdf_path_in_zip", "content").mapInArrow(run, schema)
