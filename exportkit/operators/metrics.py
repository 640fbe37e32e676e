"""Run metrics over ``(shard_index, rows, bytes, elapsed_s)`` rows.

Every figure that compares a shard with the whole set uses a scalar subquery over an
aggregate, so no window ever pulls all shards into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shards import SHARD

# Duration floor, slow-shard share, stability limits and grades, level count.
MIN_SECONDS = 0.001
SLOW_SHARE = 0.40
GRADES = ((0.25, "A+"), (0.45, "A"), (0.65, "B"))
LOWEST_GRADE = "C"
TOP_LEVEL = 7
TOP_COUNT = 3
BYTES_PER_MB = 1_048_576


def _seconds(column) -> Column:
    return F.greatest(F.col(column) if isinstance(column, str) else column, F.lit(MIN_SECONDS))


def _scalar(df: DataFrame, value: Column) -> Column:
    return df.agg(value).scalar()


def _nonzero(value: Column) -> Column:
    return F.when(value == 0, F.lit(1.0)).otherwise(value)


def by_shard(inventory: DataFrame) -> DataFrame:
    """File rows summed up per shard; a shard takes as long as its last file."""
    return inventory.groupBy(SHARD).agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("elapsed_s").alias("elapsed_s")
    )


def shard_metrics(shards: DataFrame) -> DataFrame:
    """Size in MB, rows per second and MB per second of every shard."""
    size = F.col("bytes") / BYTES_PER_MB
    return shards.select(
        SHARD,
        "rows",
        "bytes",
        size.alias("bytes_mb"),
        F.col("elapsed_s").alias("duration_s"),
        (F.col("rows") / _seconds("elapsed_s")).alias("rows_s"),
        (size / _seconds("elapsed_s")).alias("mb_s"),
    )


def totals(shards: DataFrame, wall_s: float | Column) -> DataFrame:
    """One row: totals and averages over wall time. No shards give zeros."""
    wall = _seconds(wall_s if isinstance(wall_s, Column) else F.lit(float(wall_s)))
    summed = shards.agg(
        F.count(F.lit(1)).alias("shards"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )
    size = F.col("total_bytes") / BYTES_PER_MB
    return summed.select(
        "shards",
        "total_rows",
        "total_bytes",
        size.alias("total_bytes_mb"),
        (F.col("total_rows") / wall).alias("avg_rows_s"),
        (size / wall).alias("avg_mb_s"),
    )


def slow_shards(metrics: DataFrame) -> DataFrame:
    """Adds ``slow``: throughput below 40 % of the mean over the shards."""
    return metrics.withColumn("slow", F.col("mb_s") < _scalar(metrics, F.avg("mb_s")) * SLOW_SHARE)


def stability_grade(metrics: DataFrame) -> DataFrame:
    """One row: spread of the throughput relative to the fastest shard, and its grade."""
    top = _nonzero(F.max("mb_s"))
    spread = metrics.agg(((top - F.min("mb_s")) / top).alias("variation"))
    grade = F.lit(LOWEST_GRADE)
    for limit, name in reversed(GRADES):
        grade = F.when(F.col("variation") < limit, name).otherwise(grade)
    return spread.filter("variation IS NOT NULL").withColumn("grade", grade)


def top_shards(metrics: DataFrame, count: int = TOP_COUNT) -> DataFrame:
    """The fastest and the slowest shards with their rank; ties go to the lower shard."""

    def ranked(kind: str, order: Column) -> DataFrame:
        # The limit is a per-task top-k; the ranking window only ever sees ``count`` rows.
        best = metrics.orderBy(order, SHARD).limit(count)
        rank = F.row_number().over(Window.partitionBy(F.lit(kind)).orderBy(order, SHARD))
        return best.select(F.lit(kind).alias("kind"), rank.alias("place"), SHARD, "mb_s")

    return ranked("fastest", F.desc("mb_s")).unionAll(ranked("slowest", F.asc("mb_s")))


def relative_levels(metrics: DataFrame) -> DataFrame:
    """Rows/s and MB/s scaled to levels 0..7 between the extremes, and as share of the maximum."""
    added = {}
    for name in ("rows_s", "mb_s"):
        high = _nonzero(_scalar(metrics, F.max(name)))
        low = _scalar(metrics, F.min(name))
        added[f"{name}_level"] = F.floor((F.col(name) - low) / _nonzero(high - low) * TOP_LEVEL).cast("int")
        added[f"{name}_share"] = F.col(name) / high
    return metrics.withColumns(added)


def run_summary(inventory: DataFrame, elapsed_s: float, watermark: str | None = None, mode: str = "export") -> DataFrame:
    """One row per run: shards, totals, time, window bound and mode."""
    return by_shard(inventory).agg(
        F.count(F.lit(1)).alias("shards"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    ).select(
        "shards",
        "total_rows",
        "total_bytes",
        F.lit(float(elapsed_s)).alias("elapsed_s"),
        F.lit(watermark).cast("string").alias("watermark"),
        F.lit(mode).alias("mode"),
    )
