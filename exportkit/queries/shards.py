"""Registered queries: shard layouts and partition directories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (
    DAY_COLUMNS,
    SHARD,
    CrossShards,
    ModShards,
    PredicateShards,
    RangeShards,
    ValueShards,
    coverage,
    day_columns,
    day_slice,
    equal_depth_shards,
    files,
    read_export,
    write_export,
)
from ..options import ParquetOptions
from ..session import scratch_dir
from .tables import table

EXACT = ParquetOptions(coerce_timestamps=None)
RANGES = [(0, 3000), (3000, 9000), (9000, 12000), (12000, None)]
SEGMENTS = ["BUILDING", "MACHINERY", "AUTOMOBILE"]
KINDS = ["click", "purchase", "view"]
DAYS = [3, 17, 28]


def _landed(spark, df, layout, label):
    """Export, read the files back: whole rows, each with the number of the shard it landed in."""
    written = write_export(df, scratch_dir(spark, label), layout, parquet=EXACT)
    return read_export(spark, written).withColumn(SHARD, layout.index().cast("int"))


def shard_mod(spark, sf_dir):
    return _landed(spark, table(spark, sf_dir, "orders"), ModShards("o_orderkey", 8), "shard_mod")


def shard_mod_signed(spark, sf_dir):
    """Negative and NULL keys: each still has a shard."""
    orders = table(spark, sf_dir, "orders").withColumn("key", F.nullif(-F.col("o_orderkey"), F.lit(-7)))
    return _landed(spark, orders, ModShards("key", 8), "shard_mod_signed")


def shard_range(spark, sf_dir):
    return _landed(spark, table(spark, sf_dir, "orders"), RangeShards("o_orderkey", RANGES), "shard_range")


def shard_values(spark, sf_dir):
    layout = ValueShards("c_mktsegment", SEGMENTS)
    return _landed(spark, table(spark, sf_dir, "customer"), layout, "shard_values")


def shard_cross(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    layout = CrossShards({"event_type": KINDS, "day": DAYS})
    return _landed(spark, events, layout, "shard_cross")


def shard_predicates(spark, sf_dir):
    """Overlapping conditions: a row lands once per condition it meets."""
    layout = PredicateShards(["o_totalprice > 200000", "o_orderstatus = 'F'", "o_orderpriority = '1-URGENT'"])
    return _landed(spark, table(spark, sf_dir, "orders"), layout, "shard_predicates")


def part_by_day(spark, sf_dir):
    events = day_columns(table(spark, sf_dir, "events"), "ts")
    written = write_export(events, scratch_dir(spark, "part_by_day"), partition_by=DAY_COLUMNS, parquet=EXACT)
    return read_export(spark, written)


def slice_day(spark, sf_dir):
    return day_slice(table(spark, sf_dir, "events"), "ts", "2024-01-05")


def shard_coverage(spark, sf_dir):
    layout = PredicateShards(["o_orderkey < 5000", "o_orderkey BETWEEN 4000 AND 9000", "o_orderkey >= 10000"])
    return coverage(table(spark, sf_dir, "orders"), layout)


def shard_depth(spark, sf_dir):
    """Ranges of equal depth over a key of which one value holds a third of all rows: whole rows, each
    once, and whether its shard is within twice the mean."""
    orders = table(spark, sf_dir, "orders")
    skewed = orders.withColumn("key", F.when(F.col("o_orderkey") % 3 == 0, F.lit(40)).otherwise(F.col("o_custkey")))
    skewed = skewed.withColumn("key", F.nullif("key", F.lit(7)))
    layout = equal_depth_shards(skewed, "key", 12, then="o_orderkey")
    rows = layout.assign(skewed)
    sizes = rows.groupBy(SHARD).agg(F.count("*").alias("held"))
    mean = sizes.agg(F.avg("held")).scalar()
    return rows.join(sizes.select(SHARD, (F.col("held") <= 2 * mean).alias("level")), SHARD).drop(SHARD)


def shard_files(spark, sf_dir):
    """Every shard directory holds at least one file, and the files hold all rows."""
    layout = ModShards("l_suppkey", 8)
    written = write_export(table(spark, sf_dir, "lineitem"), scratch_dir(spark, "shard_files"), layout)
    listing = files(spark, written, layout)
    return listing.groupBy(SHARD).agg(F.sum("rows").alias("rows"), (F.count("*") > 0).alias("has_files"))


QUERIES = {
    f.__name__: f
    for f in (
        shard_mod,
        shard_mod_signed,
        shard_range,
        shard_values,
        shard_cross,
        shard_predicates,
        part_by_day,
        slice_day,
        shard_coverage,
        shard_depth,
        shard_files,
    )
}

ORACLE = {
    "shard_mod": "SELECT *, CAST(o_orderkey % 8 AS INTEGER) AS shard_index FROM orders",
    "shard_mod_signed": """
        SELECT *, nullif(-o_orderkey, -7) AS key,
               CAST(CASE WHEN o_orderkey = 7 THEN 0 ELSE ((-o_orderkey) % 8 + 8) % 8 END AS INTEGER) AS shard_index
        FROM orders
    """,
    "shard_range": """
        SELECT *, CAST(CASE WHEN o_orderkey < 3000 THEN 0 WHEN o_orderkey < 9000 THEN 1
                            WHEN o_orderkey < 12000 THEN 2 ELSE 3 END AS INTEGER) AS shard_index
        FROM orders WHERE o_orderkey >= 0
    """,
    "shard_values": """
        SELECT *, CAST(list_position(['BUILDING', 'MACHINERY', 'AUTOMOBILE'], c_mktsegment) - 1 AS INTEGER) AS shard_index
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
    """,
    "shard_cross": """
        SELECT *, CAST(extract(day FROM ts) AS INTEGER) AS day,
               CAST((list_position(['click', 'purchase', 'view'], event_type) - 1) * 3
                    + list_position([3, 17, 28], CAST(extract(day FROM ts) AS INTEGER)) - 1 AS INTEGER) AS shard_index
        FROM events WHERE event_type IN ('click', 'purchase', 'view') AND extract(day FROM ts) IN (3, 17, 28)
    """,
    "shard_predicates": """
        SELECT *, CAST(0 AS INTEGER) AS shard_index FROM orders WHERE o_totalprice > 200000
        UNION ALL
        SELECT *, CAST(1 AS INTEGER) FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT *, CAST(2 AS INTEGER) FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
    "part_by_day": """
        SELECT *, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events
    """,
    "slice_day": """
        SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'
    """,
    "shard_coverage": """
        SELECT CAST((o_orderkey < 5000)::INT + (o_orderkey BETWEEN 4000 AND 9000)::INT
                    + (o_orderkey >= 10000)::INT AS INTEGER) AS hits,
               CAST(COUNT(*) AS BIGINT) AS rows
        FROM orders GROUP BY 1
    """,
    "shard_depth": """
        SELECT *, nullif(CASE WHEN o_orderkey % 3 = 0 THEN 40 ELSE o_custkey END, 7) AS key, TRUE AS level FROM orders
    """,
    "shard_files": """
        SELECT CAST(l_suppkey % 8 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS has_files
        FROM lineitem GROUP BY 1
    """,
}
