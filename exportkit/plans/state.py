"""Durable window state: one small Parquet table, append-only."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.windows import Bounds
from ..session import path_exists, small_table, with_settings

STATE_SCHEMA = (
    "run_id string, status string, prev string, now string, type_name string, written_at timestamp, job string"
)
PLANNED, COMMITTED = "planned", "committed"


class StateTable:
    """Windows of all jobs. A run first plans its window and commits it when all is down.

    A run that is started again under the same id gets the window it planned before, so what
    landed in the first attempt and what is committed in the second describe the same rows.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/state"

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return small_table(self.spark, [], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.path)

    def latest(self) -> DataFrame:
        """``(job, run_id, watermark)`` of the newest committed window per job."""
        newest = Window.partitionBy("job").orderBy(F.desc("written_at"), F.desc("run_id"))
        return (
            self.rows()
            .filter(F.col("status") == COMMITTED)
            .withColumn("_rank", F.row_number().over(newest))
            .filter("_rank = 1")
            .select("job", "run_id", F.col("now").alias("watermark"), "type_name")
        )

    def lookup(self, job: str, run_id: str) -> tuple[Bounds | None, str | None]:
        """``(window planned by this run, watermark of the job)`` in one pass."""
        planned = (F.col("status") == PLANNED) & (F.col("run_id") == run_id)
        row = (
            self.rows()
            .filter(F.col("job") == job)
            .agg(
                F.min_by(
                    F.when(planned, F.struct("prev", "now", "type_name")), F.when(planned, F.col("written_at"))
                ).alias("planned"),
                _newest_committed().alias("watermark"),
            )
            .first()
        )
        known = row["planned"]
        return (Bounds(known["prev"], known["now"], known["type_name"]) if known else None), row["watermark"]

    def watermark(self, job: str) -> str | None:
        return self.lookup(job, "")[1]

    def plan(self, job: str, run_id: str, bounds: Bounds) -> Bounds:
        """Record the window of a run, or give back the one it recorded before."""
        known, _ = self.lookup(job, run_id)
        return known or self.record(job, run_id, bounds)

    def record(self, job: str, run_id: str, bounds: Bounds) -> Bounds:
        """Record the window of a run that is known to have none (see ``lookup``)."""
        self._append(job, run_id, PLANNED, bounds)
        return bounds

    def commit(self, job: str, run_id: str, bounds: Bounds) -> bool:
        """Make ``bounds.now`` the job's watermark. It never moves back; returns whether it moved."""
        current = self.rows().filter(F.col("job") == job).agg(_newest_committed().alias("now"))
        moves = bounds.value(bounds.now) > F.col("now").cast(bounds.type_name)
        if not current.select(F.coalesce(moves, F.lit(True)).alias("moves")).first()["moves"]:
            return False
        self._append(job, run_id, COMMITTED, bounds)
        return True

    def _append(self, job: str, run_id: str, status: str, bounds: Bounds) -> None:
        row = (run_id, status, bounds.prev, bounds.now, bounds.type_name, datetime.now(timezone.utc), job)
        rows = small_table(self.spark, [row], STATE_SCHEMA).coalesce(1)
        with with_settings(rows, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}) as out:
            out.write.mode("append").partitionBy("job").parquet(self.path)


def _newest_committed() -> Column:
    committed = F.col("status") == COMMITTED
    return F.max_by(F.when(committed, F.col("now")), F.when(committed, F.struct("written_at", "run_id")))
