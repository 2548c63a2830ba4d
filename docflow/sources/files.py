"""Files: CSV as text, append-only JSON logs, ZIP containers, tables and views."""

from __future__ import annotations

import io
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the usual CSV readers take for a missing value. Fixed values.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder in spark.checkpoint.dir, which a cluster shares; a local session without one gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="docflow-")
    return f"{shared.rstrip('/')}/files-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, columns: list[str], *, parse_na: bool = True) -> DataFrame:
    """All columns as text. With `parse_na` the usual tokens are null; without it an empty field is the empty text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    clean = (lambda c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c))) if parse_na else (lambda c: F.coalesce(F.col(c), F.lit("")))
    return raw.select(*[clean(c).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_json_log(spark: SparkSession, path: str, schema: T.StructType, key: list[str]) -> DataFrame:
    """The valid lines of a JSON-lines log with `seq`, their order within the file: blank and broken lines and lines without a whole key go.

    `seq` follows the byte order of one file; a log of several files should carry a sequence of its own.
    """
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("seq"), F.trim("value").alias("v")).where("v <> ''")
    rows = lines.select("seq", F.from_json("v", schema).alias("r")).select("seq", "r.*")
    for c in key:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _zip_paths(spark: SparkSession, glob: str) -> DataFrame:
    """(path): the containers, without reading them."""
    return spark.read.format("binaryFile").load(glob).select("path")


class _Stream(io.RawIOBase):
    """An Arrow file as a Python stream; a place before its start is an OSError, as the ZIP reader expects."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0 if whence == 0 else self.file.tell() if whence == 1 else self.file.size())
        if at < 0:
            raise OSError("a place before the start")
        return self.file.seek(at)

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


def _open(path: str):
    """A seekable stream of a file, by Arrow's file systems; only what is read of it is fetched."""
    from pyarrow import fs

    where, own = fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)
    return io.BufferedReader(_Stream(where.open_input_file(own)), 1 << 16)


def zip_entries(spark: SparkSession, glob: str) -> DataFrame:
    """(zip_path, path, is_dir): all entries of ZIP containers, folders too, by their directories alone."""

    def run(frames: Iterator) -> Iterator:
        import zipfile

        import pandas as pd

        for frame in frames:
            for where in frame["path"]:
                with _open(where) as f, zipfile.ZipFile(f) as z:
                    names = z.namelist()
                if names:
                    yield pd.DataFrame({"zip_path": where, "path": names, "is_dir": [n.endswith("/") for n in names]})

    return _zip_paths(spark, glob).mapInPandas(run, "zip_path string, path string, is_dir boolean")


def zip_members(spark: SparkSession, glob: str, *, content: bool = False, suffix: str = "") -> DataFrame:
    """(zip_path, path[, content]): the files in ZIP containers, listed on the executors, contents one member at a time."""
    if not content:
        return zip_entries(spark, glob).where(~F.col("is_dir") & F.lower("path").endswith(suffix)).select("zip_path", "path")

    def run(frames: Iterator) -> Iterator:
        import zipfile

        import pandas as pd

        for frame in frames:
            for where in frame["path"]:
                with _open(where) as f, zipfile.ZipFile(f) as z:
                    for n in z.namelist():
                        if not n.endswith("/") and n.lower().endswith(suffix):
                            yield pd.DataFrame({"zip_path": [where], "path": [n], "content": [z.read(n)]})

    return _zip_paths(spark, glob).mapInPandas(run, "zip_path string, path string, content binary")


def with_sha256(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2("content", 256))


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a managed table and read it back."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
