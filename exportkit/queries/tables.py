"""Access to the input tables of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make tables visible to SQL text under their own names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
