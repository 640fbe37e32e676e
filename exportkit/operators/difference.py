"""Which rows differ between two sides: a tree of hash buckets, followed only where sums differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, scratch_dir
from .fingerprint import ROW_HASH, SUMS, hash_slices, hashable, row_hash

# Bits of the row hash that one level of the tree looks at, and how many levels there are: after three
# of twelve bits, buckets hold one row in 68 billion.
LEVEL_BITS, LEVELS = 12, 3
SIDE, BUCKET = "_side", "_bucket"


def _in_buckets(both: DataFrame, level: int) -> DataFrame:
    return both.withColumn(BUCKET, F.shiftrightunsigned(ROW_HASH, 64 - LEVEL_BITS * (level + 1)))


def differing_buckets(both: DataFrame, level: int) -> DataFrame:
    """Buckets of a level in which the sides do not hold the same rows the same number of times.

    ``both`` holds the rows of the two sides with ``_side`` 1 and -1. They shrink to one row per bucket
    and task before they are exchanged; what both sides hold cancels in every sum.
    """
    parts = [F.lit(1), *hash_slices()]
    names = ["rows", *SUMS]
    sums = [F.sum(part * F.col(SIDE)).alias(name) for part, name in zip(parts, names)]
    found = _in_buckets(both, level).groupBy(BUCKET).agg(*sums)
    return found.where(reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names])).select(BUCKET)


def differing_rows(source: DataFrame, target: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Rows that one side holds more often than the other: the columns of ``target``, ``side`` (which one
    has more) and ``copies`` (how many more).

    Every level reads both sides, but only the rows below buckets that differed on the level before go
    on, so that few rows are compared value by value however large the sides are; the buckets are as
    many as there are differences, at most. Repeated rows count; NULL equals NULL; maps are compared by
    their entries. Sides that agree give no row.
    """
    columns = target.columns
    sides = [source.select(*(F.col(f"`{c}`") for c in columns)), target]
    marked = [
        df.select("*", row_hash(list(target.schema)).alias(ROW_HASH), F.lit(sign).cast("bigint").alias(SIDE))
        for df, sign in zip(sides, (1, -1))
    ]
    both = marked[0].unionAll(marked[1])
    spark, folders = target.sparkSession, []
    for level in range(levels):
        folders.append(scratch_dir(spark, "differing-buckets"))
        # A table, so that Spark knows its size when it picks the join.
        differing_buckets(both, level).write.parquet(folders[-1])
        buckets = spark.read.schema(f"{BUCKET} bigint").parquet(folders[-1])
        both = _in_buckets(both, level).join(buckets, BUCKET, "left_semi").drop(BUCKET)
    keys = [hashable(f).alias(f"_key{i}") for i, f in enumerate(target.schema)]
    row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row")
    compared = both.select(*keys, row, SIDE).groupBy(*(f"_key{i}" for i in range(len(keys))))
    found = compared.agg(F.sum(SIDE).alias("_more"), F.first("_row").alias("_row")).where("_more <> 0")
    result = found.select(
        "_row.*",
        F.when(F.col("_more") > 0, "source").otherwise("target").alias("side"),
        F.abs("_more").alias("copies"),
    )
    path = scratch_dir(spark, "differing-rows")
    result.write.parquet(path)
    for folder in folders:
        delete_path(spark, folder)
    return spark.read.schema(result.schema).parquet(path)
