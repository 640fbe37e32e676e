"""One row per finished run."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..session import path_exists, small_table, with_settings

SUMMARY = ("shards", "total_rows", "total_bytes", "elapsed_s", "watermark", "mode")
RUN_SCHEMA = (
    "shards bigint, total_rows bigint, total_bytes bigint, elapsed_s double, watermark string, mode string, "
    "run_id string, finished_at timestamp, job string"
)


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/runs"

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return small_table(self.spark, [], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.path)

    def append(self, job: str, run_id: str, summary: DataFrame) -> dict[str, Any]:
        """Record the one-row ``summary`` and return its values."""
        values = summary.select(*SUMMARY).first().asDict()
        row = (*values.values(), run_id, datetime.now(timezone.utc), job)
        rows = small_table(self.spark, [row], RUN_SCHEMA).coalesce(1)
        with with_settings(rows, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}) as out:
            out.write.mode("append").partitionBy("job").parquet(self.path)
        return values
