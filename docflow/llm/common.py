"""Helpers that the corpus operators share: table access, scratch tables, Arrow text buffers."""

from __future__ import annotations

import ctypes
import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Working set of one vectorised step: a chunk holds at most so many bytes of text, or one row.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch between the JVM and Python. Spark's default of 10,000 holds tens of MB on both sides of every task.
ARROW_ROWS = 2_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and keep Arrow batches small.

    This serves local sessions and clusters that see the folder; others get the package by `--py-files`. Fewer rows a batch than `ARROW_ROWS`, if the
    session says so, stay.
    """
    if not 0 < int(spark.conf.get(_ROWS)) <= ARROW_ROWS:
        spark.conf.set(_ROWS, str(ARROW_ROWS))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder, by Spark's own reader."""
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only a local session (tests) that names none gets a temporary folder; a cluster without one is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="docflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder; what is written there goes at the latest when the application ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    files, at = _file_system(spark, path)
    files.deleteOnExit(at)
    return path


def materialise(df: DataFrame, tag: str, kept: list[str] | None = None) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors.

    `kept` gets the path, for `discard` once all that reads the table is itself written.
    """
    spark = df.sparkSession
    reachable(spark)
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    if kept is not None:
        kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, kept: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in kept:
        files, at = _file_system(spark, path)
        files.delete(at, True)
    kept.clear()


#: A table of at most so many rows of a few numbers may be broadcast: some tens of MB in each executor.
SMALL_ROWS = 500_000


def spread_join(left: DataFrame, right: DataFrame, key: str, n: str, by: list[str], *, per_task: int, how: str = "inner") -> DataFrame:
    """`left` joined with `right` by `key`, of which `right` has one row each and in `n` the number of `left` rows.

    Keys with more than `per_task` rows are dealt over parts by a hash of `by`. Such keys are at most 50,000, as the limit grows with the rows, so
    their list is broadcast; the others take no part in that. The result has no column `n`.
    """
    row = right.agg(F.sum(n).alias("rows"), F.max(n).alias("most")).first()
    limit = max(per_task, (row["rows"] or 0) // 50_000)
    if (row["most"] or 0) <= limit:
        return left.join(right.drop(n), key, how)
    parts = F.ceil(F.col(n) / F.lit(limit)).cast("int")
    hot = right.where(F.col(n) > limit).select(key, parts.alias("__parts"))
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("__part", F.pmod(F.xxhash64(*by), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    split = right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))).drop(n)
    return dealt.join(split, [key, "__part"], how).drop("__part")


def sha256_hex(data: str | bytes) -> str:
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying its text; a null has no bytes."""
    large = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.type != large:
        column = column.cast(large)
    if column.null_count:
        column = column.fill_null(b"" if large == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets and len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give free memory back: a worker lives on and the next operator's tasks run beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # Not every C library has it.
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes in `column`; a longer row comes alone."""
    done = 0
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, at = text_buffers(batch.column(batch.schema.get_field_index(column)))
            start = 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
                yield batch.slice(start, end - start)
                start, done = end, done + 1
                if done % 16 == 0:
                    release()
    finally:
        release()


def col(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
