"""Time the headline exports and print one JSON line.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEAT   timed repetitions, the best counts (default 5)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from exportkit import ExportJob, FrameSource, Incremental, LayoutOptions, UnloadOptions
from exportkit.functions import arrow_batches, chain, clamp, full_hash, short_hash
from exportkit.operators import (
    DAY_COLUMNS,
    Bounds,
    ModShards,
    day_columns,
    files,
    latest_per_key,
    read_export,
    reconcile,
    unload,
    window,
    write_export,
)
from exportkit.queries.tables import table
from exportkit.session import configure, scratch_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))
SPREAD = LayoutOptions(spread=True)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("exportkit-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def full_export(spark):
    """lineitem to zstd Parquet. The input is one row group, so its rows are dealt out first."""
    return write_export(table(spark, SF_DIR, "lineitem"), scratch_dir(spark, "bench_full"), layout=SPREAD)


def full_export_one_task(spark):
    """The same without an exchange: the one task that reads the row group also encodes it."""
    return write_export(table(spark, SF_DIR, "lineitem"), scratch_dir(spark, "bench_one_task"))


def full_export_checked(spark):
    """The same with content checksums summed up on the way."""
    path = scratch_dir(spark, "bench_checked")
    return write_export(table(spark, SF_DIR, "lineitem"), path, layout=SPREAD, checksum=True)


def sharded_export(spark):
    """orders in eight modulo shards."""
    return write_export(table(spark, SF_DIR, "orders"), scratch_dir(spark, "bench_shards"), ModShards("o_orderkey", 8))


def sharded_lineitem(spark):
    """lineitem in eight modulo shards."""
    path = scratch_dir(spark, "bench_shards_lineitem")
    return write_export(table(spark, SF_DIR, "lineitem"), path, ModShards("l_orderkey", 8))


def incremental_window(spark):
    """Three days of thirty of events."""
    bounds = Bounds("2024-01-10 00:00:00", "2024-01-13 00:00:00", "timestamp_ntz")
    return write_export(window(table(spark, SF_DIR, "events"), "ts", bounds), scratch_dir(spark, "bench_window"))


def incremental_job(spark):
    """The same window as a whole run: plan, write, inventory, checks, catalog, manifest, commit."""
    root = scratch_dir(spark, "bench_job")
    rule = Incremental(column="ts", now="2024-01-13 00:00:00", default="2024-01-10 00:00:00")
    source = FrameSource(lambda s: table(s, SF_DIR, "events"))
    return ExportJob("bench", source, f"{root}/data", f"{root}/catalog", incremental=rule).run(spark, "r1")


def day_partitions(spark):
    """events by year, month and day."""
    df = day_columns(table(spark, SF_DIR, "events"), "ts")
    return write_export(df, scratch_dir(spark, "bench_days"), partition_by=DAY_COLUMNS)


def documents_masked(spark):
    """Whole document texts hashed and written."""
    df = short_hash(table(spark, SF_DIR, "documents"), "text")
    return write_export(df, scratch_dir(spark, "bench_documents"))


def customers_masked(spark):
    df = table(spark, SF_DIR, "customer")
    steps = (lambda d: short_hash(d, "c_name"), lambda d: full_hash(d, "c_mktsegment"), lambda d: clamp(d, "c_acctbal"))
    return write_export(chain(df, *steps), scratch_dir(spark, "bench_customers"))


def arrow_transform(spark):
    """events through an Arrow batch function."""
    df = arrow_batches(table(spark, SF_DIR, "events"), lambda batch: batch.drop_columns(["props"]))
    return write_export(df, scratch_dir(spark, "bench_arrow"))


def unload_csv(spark):
    return unload(table(spark, SF_DIR, "lineitem"), scratch_dir(spark, "bench_csv"), UnloadOptions(format="csv"))


def unload_ordered(spark):
    options = UnloadOptions(single=True, order_by=("l_shipdate", "l_orderkey", "l_linenumber"))
    return unload(table(spark, SF_DIR, "lineitem"), scratch_dir(spark, "bench_ordered"), options)


def dedup_latest(spark):
    latest = latest_per_key(table(spark, SF_DIR, "events"), ["user_id"], ["ts", "event_id"])
    return write_export(latest, scratch_dir(spark, "bench_dedup"))


def inventory(spark, written):
    return files(spark, written, ModShards("l_orderkey", 8)).agg(F.sum("rows")).first()


def reconcile_lineitem(spark, written):
    source = ModShards("l_orderkey", 8).assign(table(spark, SF_DIR, "lineitem"))
    return reconcile(source, read_export(spark, written)).filter("NOT matches").count()


QUERIES = (
    full_export,
    full_export_one_task,
    full_export_checked,
    sharded_export,
    sharded_lineitem,
    incremental_window,
    incremental_job,
    day_partitions,
    documents_masked,
    customers_masked,
    arrow_transform,
    unload_csv,
    unload_ordered,
    dedup_latest,
)


def best_of(run, *args):
    """``(seconds, result)`` of the fastest repetition, after one warm-up."""
    run(*args)
    best = (float("inf"), None)
    for _ in range(REPEAT):
        started = time.perf_counter()
        result = run(*args)
        best = min(best, (time.perf_counter() - started, result), key=lambda pair: pair[0])
    return best


def landed_bytes(spark, written) -> int:
    return files(spark, written).agg(F.sum("bytes")).first()[0] if written.format == "parquet" else 0


def main() -> None:
    spark = session()
    seconds, rates = {}, {}
    for query in QUERIES:
        name = query.__name__
        seconds[name], result = best_of(query, spark)
        rows = getattr(result, "rows", None)
        if rows:
            rates[name] = {"rows_s": round(rows / seconds[name])}
            size = landed_bytes(spark, result)
            if size:
                rates[name]["mb_s"] = round(size / 1048576 / seconds[name], 2)
        if query is sharded_lineitem:
            sharded = result
    seconds["file_inventory"], _ = best_of(inventory, spark, sharded)
    seconds["reconcile_lineitem"], differing = best_of(reconcile_lineitem, spark, sharded)
    if differing:
        sys.exit("reconcile found differences")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline exports (best of %d)" % REPEAT,
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 4) for name, value in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cores": int(CPUS),
                "rates": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
