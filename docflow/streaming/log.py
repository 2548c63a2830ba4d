"""The screening log as a stream: each micro-batch of pages is screened if its latest result is no success."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docflow.config import DEFAULT, Config
from docflow.operators.screening import pending, screen


def screen_stream(pages: DataFrame, log_path: str, checkpoint: str, classify: Callable[[str], dict[str, Any]], config: Config = DEFAULT) -> StreamingQuery:
    """Append the results of streamed pages to a Parquet log; pages that already succeeded are skipped."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        from pyspark.errors import AnalysisException
        from pyspark.sql import functions as F

        spark = rows.sparkSession
        try:
            rows = pending(rows, spark.read.parquet(log_path))
        except AnalysisException as e:
            # Before the first batch there is no log.
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        screen(rows, classify, config=config).withColumn("seq", F.lit(batch_id).cast("long")).write.mode("append").parquet(log_path)

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
