"""Registered queries: windows, state, repeated runs, overlap removal."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import Bounds, ModShards, latest_per_key, upper_bound, window
from ..operators.windows import FIRST_RUN
from ..options import ParquetOptions
from ..plans import Catalog, ExportJob, Incremental, StateTable, read_files
from ..session import delete_path, scratch_dir
from ..sources import FrameSource, SqlSource
from .tables import table, views

PREV, NOW = "2024-01-10 00:00:00", "2024-01-12 12:00:00"
EXACT = ParquetOptions(coerce_timestamps=None)


def _events(sf_dir):
    return FrameSource(partial(table, sf_dir=sf_dir, name="events"))


def _job(spark, sf_dir, name, rule, **options):
    root = scratch_dir(spark, name)
    return ExportJob(
        name=name,
        source=options.pop("source", None) or _events(sf_dir),
        base=f"{root}/data",
        catalog=f"{root}/catalog",
        incremental=rule,
        parquet=EXACT,
        **options,
    )


def _exported(spark, job, *runs, schema):
    """All rows of some runs, found through the catalog."""
    catalog = Catalog(spark, job.catalog)
    frames = [read_files(catalog.run_files(job.name, r), f"{job.base}/{r}", schema) for r in runs]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def inc_window(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return window(events, "ts", Bounds(PREV, NOW, "timestamp_ntz"))


def inc_logical(spark, sf_dir):
    """Upper bound given as a logical time, lower bound from a committed run."""
    views(spark, sf_dir, "events")
    template = "SELECT * FROM events WHERE ts > :watermark_prev AND ts <= :watermark_now"
    job = _job(spark, sf_dir, "inc_logical", Incremental(now=NOW), source=SqlSource(template=template))
    StateTable(spark, job.catalog).commit(job.name, "before", Bounds(FIRST_RUN, PREV, "string"))
    run = job.run(spark, "r1")
    return _exported(spark, job, "r1", schema=run.schema)


def inc_first_run(spark, sf_dir):
    job = _job(spark, sf_dir, "inc_first_run", Incremental(column="ts"))
    run = job.run(spark, "r1")
    return _exported(spark, job, "r1", schema=run.schema)


def inc_lateness(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return window(events, "ts", Bounds(PREV, NOW, "timestamp_ntz"), lateness="6 hours")


def inc_two_runs(spark, sf_dir):
    """Two windows in a row: together they hold every row once."""
    views(spark, sf_dir, "events")
    first = _job(spark, sf_dir, "inc_two_runs", Incremental(column="ts", now=PREV))
    second = ExportJob(
        name=first.name,
        source=first.source,
        base=first.base,
        catalog=first.catalog,
        parquet=EXACT,
        incremental=Incremental(column="ts", watermark_query="SELECT MAX(ts) FROM events"),
    )
    schema = first.run(spark, "r1").schema
    second.run(spark, "r2")
    one = _exported(spark, first, "r1", schema=schema).withColumn("run_id", F.lit("r1"))
    two = _exported(spark, first, "r2", schema=schema).withColumn("run_id", F.lit("r2"))
    return one.unionByName(two)


def inc_replay(spark, sf_dir):
    """A run started again under its id replays its planned window, not a newer one."""
    first = _job(spark, sf_dir, "inc_replay", Incremental(column="ts", now=PREV))
    again = ExportJob(
        name=first.name,
        source=first.source,
        base=first.base,
        catalog=first.catalog,
        parquet=EXACT,
        incremental=Incremental(column="ts", now=NOW),
    )
    schema = first.run(spark, "r1").schema
    again.run(spark, "r1")
    return _exported(spark, first, "r1", schema=schema)


def state_latest(spark, sf_dir):
    """Newest committed window bound of two jobs; bounds are taken from the data."""
    events = table(spark, sf_dir, "events")
    state = StateTable(spark, scratch_dir(spark, "state_latest"))
    low = upper_bound(events.filter("event_type = 'click'"), "ts")
    high = upper_bound(events, "ts")
    state.commit("all_events", "r1", Bounds(FIRST_RUN, PREV, "timestamp_ntz"))
    state.commit("all_events", "r2", Bounds(PREV, high, "timestamp_ntz"))
    state.commit("clicks", "r1", Bounds(FIRST_RUN, low, "timestamp_ntz"))
    state.plan("clicks", "r2", Bounds(low, high, "timestamp_ntz"))
    return state.latest().select("job", "run_id", "watermark")


def wm_max(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.max("ts").cast("string").alias("watermark"))


def dedup_latest(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def dedup_overlap(spark, sf_dir):
    """Two overlapping windows in a row, each event kept once."""
    events = table(spark, sf_dir, "events")
    first = window(events, "ts", Bounds(FIRST_RUN, PREV, "timestamp_ntz"))
    second = window(events, "ts", Bounds(PREV, NOW, "timestamp_ntz"), lateness="2 days")
    return latest_per_key(first.unionAll(second), ["event_id"], ["ts"])


def skip_existing(spark, sf_dir):
    """Second run of a sharded job after one shard was lost: only that shard is written."""
    views(spark, sf_dir, "orders")
    root = scratch_dir(spark, "skip_existing")
    job = ExportJob(
        name="skip_existing",
        source=SqlSource(query="SELECT * FROM orders"),
        base=f"{root}/data",
        path="orders",
        catalog=f"{root}/catalog",
        shards=ModShards("o_orderkey", 4),
        skip_existing=True,
    )
    first = job.run(spark, "r1")
    delete_path(spark, f"{first.path}/shard_index=2")
    job.run(spark, "r2")
    entries = Catalog(spark, job.catalog).run(job.name, "r2")
    return entries.groupBy("shard_index", "skipped").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("b")).select(
        "shard_index", "skipped", "rows", (F.col("b") > 0).alias("wrote_bytes")
    )


QUERIES = {
    f.__name__: f
    for f in (
        inc_window,
        inc_logical,
        inc_first_run,
        inc_lateness,
        inc_two_runs,
        inc_replay,
        state_latest,
        wm_max,
        dedup_latest,
        dedup_overlap,
        skip_existing,
    )
}

ORACLE = {
    "inc_window": f"SELECT * FROM events WHERE ts > TIMESTAMP '{PREV}' AND ts <= TIMESTAMP '{NOW}'",
    "inc_logical": f"SELECT * FROM events WHERE ts > TIMESTAMP '{PREV}' AND ts <= TIMESTAMP '{NOW}'",
    "inc_first_run": "SELECT * FROM events WHERE ts > TIMESTAMP '1970-01-01 00:00:00'",
    "inc_lateness": f"""
        SELECT * FROM events WHERE ts > TIMESTAMP '{PREV}' - INTERVAL 6 HOUR AND ts <= TIMESTAMP '{NOW}'
    """,
    "inc_two_runs": f"""
        SELECT *, CASE WHEN ts <= TIMESTAMP '{PREV}' THEN 'r1' ELSE 'r2' END AS run_id FROM events
    """,
    "inc_replay": f"SELECT * FROM events WHERE ts <= TIMESTAMP '{PREV}'",
    "state_latest": """
        SELECT 'all_events' AS job, 'r2' AS run_id, CAST(MAX(ts) AS VARCHAR) AS watermark FROM events
        UNION ALL
        SELECT 'clicks', 'r1', CAST(MAX(ts) AS VARCHAR) FROM events WHERE event_type = 'click'
    """,
    "wm_max": "SELECT CAST(MAX(ts) AS VARCHAR) AS watermark FROM events",
    "dedup_latest": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
        ) WHERE rn = 1
    """,
    "dedup_overlap": f"SELECT * FROM events WHERE ts <= TIMESTAMP '{NOW}'",
    "skip_existing": """
        SELECT CAST(o_orderkey % 4 AS INTEGER) AS shard_index, o_orderkey % 4 <> 2 AS skipped,
               CAST(SUM(CASE WHEN o_orderkey % 4 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS rows,
               o_orderkey % 4 = 2 AS wrote_bytes
        FROM orders GROUP BY 1, 2, 4
    """,
}
