"""Registered queries: inventory, manifest, validation, reconciliation, metrics, streaming."""

from __future__ import annotations

from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import functions as F

from ..operators import (
    ModShards,
    differing_rows,
    file_md5,
    files,
    footers,
    landed_files,
    metrics,
    read_export,
    reconcile,
    unload,
    validate,
    write_export,
)
from ..options import ParquetOptions, UnloadOptions
from ..plans import Catalog, ExportJob, RunLog, latest_per_uri, read_files, read_manifest
from ..session import hadoop_path, path_exists, scratch_dir, small_table
from ..sources import SqlSource
from ..streaming import StreamExport
from .tables import table, views

EXACT = ParquetOptions(coerce_timestamps=None)
QUARTERS = ModShards("o_orderkey", 4)


def _orders_export(spark, sf_dir, label):
    return write_export(table(spark, sf_dir, "orders"), scratch_dir(spark, label), QUARTERS, parquet=EXACT)


def _orders_job(spark, sf_dir, name, query="SELECT * FROM orders", **options):
    views(spark, sf_dir, "orders")
    root = scratch_dir(spark, name)
    return ExportJob(
        name=name,
        source=SqlSource(query=query),
        base=f"{root}/data",
        catalog=f"{root}/catalog",
        shards=QUARTERS,
        parquet=EXACT,
        **options,
    )


def file_inventory(spark, sf_dir):
    listing = landed_files(spark, _orders_export(spark, sf_dir, "file_inventory"), QUARTERS)
    return listing.groupBy("shard_index").agg(F.sum("rows").alias("rows"), (F.min("bytes") > 0).alias("has_bytes"))


def file_checksums(spark, sf_dir):
    """MD5 of every file of an export, one line per shard."""
    written = _orders_export(spark, sf_dir, "file_md5")
    sums = files(spark, written, QUARTERS).join(file_md5(spark, written.path), "uri")
    return sums.select("shard_index", "uri", "rows", "bytes", "md5")


def file_md5_csv(spark, sf_dir):
    """MD5 of an ordered CSV file, whose bytes SQL can spell out."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    options = UnloadOptions(format="csv", compression="none", header=False, single=True, order_by=("p_partkey",))
    written = unload(rows, scratch_dir(spark, "file_md5_csv"), options)
    return file_md5(spark, written.path).select("md5")


def overwrite_failed(spark, sf_dir):
    """A second run on the same path fails in its tasks; the first run's rows are still there."""
    job = _orders_job(spark, sf_dir, "overwrite_failed", path="orders")
    first = job.run(spark, "r1")
    failing = F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("stop"))).otherwise(F.col("o_totalprice"))
    broken = replace(job, transforms=[lambda df: df.withColumn("o_totalprice", failing.cast("double"))])
    try:
        broken.run(spark, "r2")
    except Exception:
        return read_files(Catalog(spark, job.catalog).run_files(job.name, "r1"), first.path, first.schema)
    raise AssertionError("the second run was meant to fail")


def read_during_rerun(spark, sf_dir):
    """A reader resolves a run, a second run on the same path goes through, then the reader reads: it gets
    the rows of the first run, and one that comes now those of the second. No data file is renamed."""
    job = _orders_job(spark, sf_dir, "read_during_rerun", path="orders")
    first = job.run(spark, "r1")
    catalog = Catalog(spark, job.catalog)
    before = read_files(catalog.run_files(job.name, "r1"), first.path, first.schema)
    doubled = replace(job, transforms=[lambda df: df.withColumn("o_totalprice", F.col("o_totalprice") * 2)])
    second = doubled.run(spark, "r2")
    after = read_files(catalog.run_files(job.name, "r2"), second.path, second.schema)
    return before.withColumn("reader", F.lit("before")).unionAll(after.withColumn("reader", F.lit("after")))


def attempts_pruned(spark, sf_dir):
    """Five runs on one path: the last two attempts are there, with all rows; older ones are gone."""
    job = _orders_job(spark, sf_dir, "attempts_pruned", path="orders")
    runs = [job.run(spark, f"r{i}") for i in range(5)]
    there = [F.lit(path_exists(spark, run.path)) for run in runs]
    rows = Catalog(spark, job.catalog).run_files(job.name, "r4").groupBy("shard_index").agg(F.sum("rows").alias("rows"))
    return rows.withColumns({f"attempt_{i}": found for i, found in enumerate(there)})


def read_superseded(spark, sf_dir):
    """A run that a later one replaced is refused by name; the later one reads whole."""
    job = _orders_job(spark, sf_dir, "read_superseded", path="orders")
    job.run(spark, "r1")
    job.run(spark, "r2")
    catalog = Catalog(spark, job.catalog)
    try:
        catalog.run_files(job.name, "r1")
        refused = False
    except ValueError as error:
        refused = "'r2'" in str(error)
    rows = catalog.run_files(job.name, "r2").groupBy("shard_index").agg(F.sum("rows").alias("rows"))
    return rows.withColumn("refused", F.lit(refused))


def manifest_build(spark, sf_dir):
    """The published document, read back."""
    job = _orders_job(spark, sf_dir, "manifest_build", md5=True)
    run = job.run(spark, "r1")
    return (
        read_manifest(spark, run.manifest)
        .groupBy("shard_index", "skipped")
        .agg(F.sum("rows").alias("rows"), F.max(F.length("md5")).alias("md5_length"))
    )


def manifest_read(spark, sf_dir):
    job = _orders_job(spark, sf_dir, "manifest_read")
    run = job.run(spark, "r1")
    return read_files(Catalog(spark, job.catalog).run_files(job.name, "r1"), run.path, run.schema)


def manifest_union(spark, sf_dir):
    """Two runs of two manifests over a cheap and a dear half; one manifest is listed twice."""
    cheap = _orders_job(spark, sf_dir, "manifest_union", "SELECT * FROM orders WHERE o_totalprice < 150000")
    first = cheap.run(spark, "cheap")
    dear = ExportJob(
        name=cheap.name,
        source=SqlSource(query="SELECT * FROM orders WHERE o_totalprice >= 150000"),
        base=cheap.base,
        catalog=cheap.catalog,
        shards=QUARTERS,
        parquet=EXACT,
    )
    second = dear.run(spark, "dear")
    listed = [read_manifest(spark, m) for m in (first.manifest, second.manifest, first.manifest)]
    combined = latest_per_uri(listed[0].unionAll(listed[1]).unionAll(listed[2]).withColumnRenamed("remote_uri", "uri"))
    return combined.groupBy("shard_index").agg(F.sum("rows").alias("rows"))


def catalog_current(spark, sf_dir):
    """A rewritten path: the cumulative catalog lists only what is still in place."""
    job = _orders_job(spark, sf_dir, "catalog_current", path="orders")
    job.run(spark, "r1")
    job.run(spark, "r2")
    current = Catalog(spark, job.catalog).latest_files()
    return current.groupBy("run_id", "shard_index").agg(F.sum("rows").alias("rows"))


def catalog_compacted(spark, sf_dir):
    """Six runs on two paths, compacted twice with runs in between: the cumulative catalog is the same as
    before, and few files have to be read for it."""
    root = scratch_dir(spark, "catalog_compacted")
    views(spark, sf_dir, "orders")
    job = lambda half: ExportJob(
        name=f"half_{half}", source=SqlSource(query=f"SELECT * FROM orders WHERE o_orderkey % 2 = {half}"), base=f"{root}/{half}",
        path="orders", catalog=f"{root}/catalog", shards=QUARTERS, parquet=EXACT,
    )
    catalog = Catalog(spark, f"{root}/catalog")
    state = lambda: catalog.latest_files().groupBy("job", "run_id", "shard_index").agg(F.sum("rows").alias("rows"))
    same = []
    for half, run in ((0, "r1"), (1, "r1"), (0, "r2")):
        job(half).run(spark, run)
    for half, run in ((1, "r2"), (0, "r3"), (1, "r3")):
        before = small_table(spark, list(map(tuple, state().collect())), "job string, run_id string, shard_index int, rows bigint")
        catalog.compact()
        same.append(differing_rows(before, state()).isEmpty())
        job(half).run(spark, run)
    catalog.compact()
    catalog.compact()
    found = state().withColumn("same", F.lit(all(same)))
    return found.withColumn("few_files", F.lit(len(catalog.entries().inputFiles()) <= 4))


def validate_export(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    written = write_export(orders, scratch_dir(spark, "validate_export"), QUARTERS, checksum=True)
    checks = validate(spark, written, landed_files(spark, written, QUARTERS), level="full")
    return checks.select("check_name", "ok")


def _damage(spark, uri, offset, size):
    """Overwrite some bytes of a file with zeros."""
    fs, path = hadoop_path(spark, unquote(uri))
    stream = fs.open(path)
    try:
        content = bytearray(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()
    content[offset : offset + size] = bytes(size)
    out = fs.create(path, True)
    out.write(content)
    out.close()


def validate_damaged(spark, sf_dir):
    """The third row group of one file is damaged: the default check fails, the footers alone pass."""
    orders = table(spark, sf_dir, "orders").coalesce(1)
    rows = max(1, orders.count() // 5)
    parquet = ParquetOptions(row_group_rows=rows, coerce_timestamps=None)
    written = write_export(orders, scratch_dir(spark, "validate_damaged"), parquet=parquet)
    third = footers(spark, written.path).where("row_group = 2").groupBy("uri").agg(
        F.min("offset").alias("offset"), F.sum("bytes").alias("bytes")
    )
    place = third.first()
    _damage(spark, place["uri"], place["offset"], place["bytes"])
    listing = landed_files(spark, written)
    result = None
    for level in ("footer", "sample"):
        checks = validate(spark, written, listing, level=level)
        checks = checks.select("check_name", "ok", F.lit(level).alias("level"), F.contains("detail", F.lit("row group 2")).alias("named"))
        result = checks if result is None else result.unionAll(checks)
    return result.withColumn("rows", listing.agg(F.sum("rows")).scalar())


def reconcile_shards(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    written = _orders_export(spark, sf_dir, "reconcile")
    return reconcile(QUARTERS.assign(orders), read_export(spark, written))


def reconcile_changed(spark, sf_dir):
    """One value changed, one row doubled and one lost: the three shards are named."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    target = QUARTERS.assign(orders).filter(key != 42)
    target = target.withColumn("o_totalprice", F.when(key == 41, 0.0).otherwise(F.col("o_totalprice")))
    target = target.unionAll(target.filter(key == 43))
    return reconcile(QUARTERS.assign(orders), target)


def reconcile_rows(spark, sf_dir):
    """Two exports of the orders: prices changed, rows lost, added and repeated. The rows that differ."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    source = _orders_export(spark, sf_dir, "reconcile_rows")
    changed = orders.where(key % 500 != 7).withColumn(
        "o_totalprice", F.when(key % 700 == 11, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    changed = changed.unionAll(changed.where(key % 900 == 13)).unionAll(changed.where(key % 900 == 13))
    added = orders.where(key % 800 == 5).withColumn("o_orderkey", -key)
    target = write_export(changed.unionAll(added), scratch_dir(spark, "reconcile_rows"), QUARTERS, parquet=EXACT)
    return differing_rows(read_export(spark, source), read_export(spark, target))


def reconcile_rows_documents(spark, sf_dir):
    """Whole texts: some documents lost a character, some lost their language."""
    documents = table(spark, sf_dir, "documents")
    cut = F.when(F.col("doc_id") % 50 == 3, F.expr("substr(text, 2)")).otherwise(F.col("text"))
    lang = F.when(F.col("doc_id") % 70 == 4, F.lit(None)).otherwise(F.col("lang"))
    return differing_rows(documents, documents.withColumns({"text": cut, "lang": lang}))


def reconcile_documents(spark, sf_dir):
    """Whole texts of an export against their source, per language."""
    documents = table(spark, sf_dir, "documents")
    written = write_export(documents, scratch_dir(spark, "reconcile_documents"), partition_by=["lang"])
    return reconcile(documents, read_export(spark, written), by=["lang"])


def run_summary(spark, sf_dir):
    job = _orders_job(spark, sf_dir, "run_summary")
    job.run(spark, "r1")
    log = RunLog(spark, job.catalog).rows()
    return log.select("job", "run_id", "shards", "total_rows", "watermark", "mode", (F.col("total_bytes") > 0).alias("wrote"))


def metrics_run(spark, sf_dir):
    """Shard figures of a real run, from its catalog entries."""
    job = _orders_job(spark, sf_dir, "metrics_run")
    job.run(spark, "r1")
    figures = metrics.shard_metrics(metrics.by_shard(Catalog(spark, job.catalog).run(job.name, "r1")))
    return figures.select("shard_index", "rows", ((F.col("rows_s") > 0) & (F.col("mb_s") > 0)).alias("has_rates"))


def _supplier_shards(spark, sf_dir):
    """Shard figures made from lineitem: size from quantities, time from the shard number."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_suppkey") % 8).cast("int").alias("shard_index"))
        .agg(
            F.count("*").alias("rows"),
            (F.sum("l_quantity").cast("bigint") * 1048576).alias("bytes"),
        )
        .withColumn("elapsed_s", F.col("shard_index") + 1.0)
    )


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def metrics_shard(spark, sf_dir):
    shards = _supplier_shards(spark, sf_dir)
    return _rounded(metrics.shard_metrics(shards), "bytes_mb", "duration_s", "rows_s", "mb_s")


def metrics_total(spark, sf_dir):
    totals = metrics.totals(_supplier_shards(spark, sf_dir), 8.0)
    return _rounded(totals, "total_bytes_mb", "avg_rows_s", "avg_mb_s")


def metrics_empty(spark, sf_dir):
    return metrics.totals(_supplier_shards(spark, sf_dir).filter("shard_index < 0"), 8.0)


def metrics_slow(spark, sf_dir):
    return metrics.slow_shards(metrics.shard_metrics(_supplier_shards(spark, sf_dir))).select("shard_index", "slow")


def metrics_grade(spark, sf_dir):
    return _rounded(metrics.stability_grade(metrics.shard_metrics(_supplier_shards(spark, sf_dir))), "variation")


def metrics_top3(spark, sf_dir):
    return _rounded(metrics.top_shards(metrics.shard_metrics(_supplier_shards(spark, sf_dir))), "mb_s")


def metrics_levels(spark, sf_dir):
    levels = metrics.relative_levels(metrics.shard_metrics(_supplier_shards(spark, sf_dir)))
    return _rounded(
        levels.select("shard_index", "rows_s_level", "rows_s_share", "mb_s_level", "mb_s_share"),
        "rows_s_share",
        "mb_s_share",
    )


def _dated_back(spark, path, days):
    """Set the files of a folder back in time, as copied or restored ones are."""
    fs, folder = hadoop_path(spark, path)
    for status in fs.listStatus(folder):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def _move_files(spark, source, target):
    fs, folder = hadoop_path(spark, source)
    into = hadoop_path(spark, target)[1]
    fs.mkdirs(into)
    for status in fs.listStatus(folder):
        if status.getPath().getName().startswith("part-"):
            fs.rename(status.getPath(), into)


def stream_old_files(spark, sf_dir):
    """The second wave arrives with modification times ten days older than the first."""
    return stream_available_now(spark, sf_dir, days_back=10)


def stream_available_now(spark, sf_dir, days_back=0):
    """Files arrive in two waves and a run follows each; a third run finds nothing new."""
    root = scratch_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    export = StreamExport(
        name="stream_events",
        source=f"{root}/incoming",
        schema=events.schema,
        base=f"{root}/data",
        catalog=f"{root}/catalog",
        checkpoint=f"{root}/checkpoint",
        parquet=EXACT,
    )
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    batches = []
    for i, wave in enumerate((events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut))):
        arriving = f"{root}/wave-{i}"
        wave.write.parquet(arriving)
        if i:
            _dated_back(spark, arriving, days_back)
        _move_files(spark, arriving, export.source)
        batches += export.run(spark)
    batches += export.run(spark)
    catalog = Catalog(spark, export.catalog)
    result = None
    for batch in batches:
        listed = catalog.run_files(export.name, f"batch-{batch}")
        rows = read_files(listed, f"{export.base}/batch={batch}", events.schema).withColumn("batch", F.lit(batch))
        result = rows if result is None else result.unionByName(rows)
    return result


QUERIES = {
    "file_inventory": file_inventory,
    "file_md5": file_checksums,
    "manifest_build": manifest_build,
    "manifest_read": manifest_read,
    "manifest_union": manifest_union,
    "catalog_current": catalog_current,
    "validate_export": validate_export,
    "reconcile": reconcile_shards,
    "reconcile_changed": reconcile_changed,
    "reconcile_documents": reconcile_documents,
    "run_summary": run_summary,
    "metrics_run": metrics_run,
    "metrics_shard": metrics_shard,
    "metrics_total": metrics_total,
    "metrics_empty": metrics_empty,
    "metrics_slow": metrics_slow,
    "metrics_grade": metrics_grade,
    "metrics_top3": metrics_top3,
    "metrics_levels": metrics_levels,
    "stream_available_now": stream_available_now,
    "stream_old_files": stream_old_files,
    "file_md5_csv": file_md5_csv,
    "overwrite_failed": overwrite_failed,
    "read_superseded": read_superseded,
    "read_during_rerun": read_during_rerun,
    "attempts_pruned": attempts_pruned,
    "catalog_compacted": catalog_compacted,
    "reconcile_rows": reconcile_rows,
    "reconcile_rows_documents": reconcile_rows_documents,
    "validate_damaged": validate_damaged,
}

_PER_SHARD = "SELECT CAST(o_orderkey % 4 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS rows"

_SUPPLIER_METRICS = """
    WITH s AS (
      SELECT CAST(l_suppkey % 8 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS rows,
             CAST(CAST(SUM(l_quantity) AS BIGINT) * 1048576 AS BIGINT) AS bytes, (l_suppkey % 8) + 1.0 AS elapsed_s
      FROM lineitem GROUP BY 1, 4
    ), m AS (
      SELECT shard_index, rows, bytes, bytes / 1048576.0::DOUBLE AS bytes_mb, CAST(elapsed_s AS DOUBLE) AS duration_s,
             rows / greatest(elapsed_s::DOUBLE, 0.001) AS rows_s,
             (bytes / 1048576.0::DOUBLE) / greatest(elapsed_s::DOUBLE, 0.001) AS mb_s
      FROM s
    )
"""

ORACLE = {
    "file_inventory": _PER_SHARD + ", TRUE AS has_bytes FROM orders GROUP BY 1",
    "manifest_build": _PER_SHARD + ", FALSE AS skipped, CAST(32 AS INTEGER) AS md5_length FROM orders GROUP BY 1",
    "manifest_read": "SELECT *, CAST(o_orderkey % 4 AS INTEGER) AS shard_index FROM orders",
    "manifest_union": _PER_SHARD + " FROM orders GROUP BY 1",
    "catalog_current": _PER_SHARD + ", 'r2' AS run_id FROM orders GROUP BY 1",
    "validate_export": """
        SELECT * FROM (VALUES ('files_present', TRUE), ('files_not_empty', TRUE), ('row_total', TRUE),
                              ('all_columns_decode', TRUE), ('content_checksum', TRUE)) AS t(check_name, ok)
    """,
    "reconcile": """
        SELECT CAST(o_orderkey % 4 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS source_rows,
               CAST(COUNT(*) AS BIGINT) AS target_rows, TRUE AS matches
        FROM orders GROUP BY 1
    """,
    "reconcile_changed": """
        SELECT CAST(o_orderkey % 4 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS source_rows,
               CAST(SUM(CASE o_orderkey WHEN 42 THEN 0 WHEN 43 THEN 2 ELSE 1 END) AS BIGINT) AS target_rows,
               o_orderkey % 4 NOT IN (1, 2, 3) AS matches
        FROM orders GROUP BY 1, 4
    """,
    "reconcile_documents": """
        SELECT lang, CAST(COUNT(*) AS BIGINT) AS source_rows, CAST(COUNT(*) AS BIGINT) AS target_rows, TRUE AS matches
        FROM documents GROUP BY 1
    """,
    "run_summary": """
        SELECT 'run_summary' AS job, 'r1' AS run_id, CAST(4 AS BIGINT) AS shards, CAST(COUNT(*) AS BIGINT) AS total_rows,
               CAST(NULL AS VARCHAR) AS watermark, 'export' AS mode, TRUE AS wrote
        FROM orders
    """,
    "metrics_run": _PER_SHARD + ", TRUE AS has_rates FROM orders GROUP BY 1",
    "metrics_shard": _SUPPLIER_METRICS
    + """
        SELECT shard_index, rows, bytes, ROUND(bytes_mb, 6) AS bytes_mb, ROUND(duration_s, 6) AS duration_s,
               ROUND(rows_s, 6) AS rows_s, ROUND(mb_s, 6) AS mb_s
        FROM m
    """,
    "metrics_total": _SUPPLIER_METRICS
    + """
        SELECT CAST(COUNT(*) AS BIGINT) AS shards, CAST(SUM(rows) AS BIGINT) AS total_rows,
               CAST(SUM(bytes) AS BIGINT) AS total_bytes, ROUND(SUM(bytes) / 1048576.0::DOUBLE, 6) AS total_bytes_mb,
               ROUND(SUM(rows) / 8.0::DOUBLE, 6) AS avg_rows_s,
               ROUND(SUM(bytes) / 1048576.0::DOUBLE / 8.0::DOUBLE, 6) AS avg_mb_s
        FROM m
    """,
    "metrics_empty": _SUPPLIER_METRICS
    + """
        SELECT CAST(COUNT(*) AS BIGINT) AS shards, CAST(COALESCE(SUM(rows), 0) AS BIGINT) AS total_rows,
               CAST(COALESCE(SUM(bytes), 0) AS BIGINT) AS total_bytes, 0.0::DOUBLE AS total_bytes_mb,
               0.0::DOUBLE AS avg_rows_s, 0.0::DOUBLE AS avg_mb_s
        FROM m WHERE shard_index < 0
    """,
    "metrics_slow": _SUPPLIER_METRICS + "SELECT shard_index, mb_s < 0.4 * (SELECT AVG(mb_s) FROM m) AS slow FROM m",
    "metrics_grade": _SUPPLIER_METRICS
    + """
        SELECT ROUND(v, 6) AS variation,
               CASE WHEN v < 0.25 THEN 'A+' WHEN v < 0.45 THEN 'A' WHEN v < 0.65 THEN 'B' ELSE 'C' END AS grade
        FROM (SELECT (MAX(mb_s) - MIN(mb_s)) / MAX(mb_s) AS v FROM m)
    """,
    "metrics_top3": _SUPPLIER_METRICS
    + """
        , r AS (
          SELECT shard_index, mb_s, ROW_NUMBER() OVER (ORDER BY mb_s DESC, shard_index) AS fast,
                 ROW_NUMBER() OVER (ORDER BY mb_s, shard_index) AS slow
          FROM m
        )
        SELECT 'fastest' AS kind, CAST(fast AS INTEGER) AS place, shard_index, ROUND(mb_s, 6) AS mb_s FROM r WHERE fast <= 3
        UNION ALL
        SELECT 'slowest', CAST(slow AS INTEGER), shard_index, ROUND(mb_s, 6) FROM r WHERE slow <= 3
    """,
    "metrics_levels": _SUPPLIER_METRICS
    + """
        , x AS (SELECT MAX(rows_s) AS hr, MIN(rows_s) AS lr, MAX(mb_s) AS hm, MIN(mb_s) AS lm FROM m)
        SELECT shard_index, CAST(FLOOR((rows_s - lr) / (hr - lr) * 7) AS INTEGER) AS rows_s_level,
               ROUND(rows_s / hr, 6) AS rows_s_share,
               CAST(FLOOR((mb_s - lm) / (hm - lm) * 7) AS INTEGER) AS mb_s_level, ROUND(mb_s / hm, 6) AS mb_s_share
        FROM m, x
    """,
    "file_md5_csv": """
        SELECT md5(string_agg(concat_ws(',', p_partkey, p_name, p_brand, p_type, p_size) || chr(10), '' ORDER BY p_partkey)) AS md5
        FROM part
    """,
    "overwrite_failed": "SELECT *, CAST(o_orderkey % 4 AS INTEGER) AS shard_index FROM orders",
    "read_superseded": _PER_SHARD + ", TRUE AS refused FROM orders GROUP BY 1",
    "read_during_rerun": """
        SELECT *, CAST(o_orderkey % 4 AS INTEGER) AS shard_index, 'before' AS reader FROM orders
        UNION ALL
        SELECT * REPLACE (o_totalprice * 2 AS o_totalprice), CAST(o_orderkey % 4 AS INTEGER), 'after' FROM orders
    """,
    "catalog_compacted": """
        SELECT 'half_' || (o_orderkey % 2) AS job, 'r3' AS run_id, CAST(o_orderkey % 4 AS INTEGER) AS shard_index,
               CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS same, TRUE AS few_files
        FROM orders GROUP BY 1, 3
    """,
    "attempts_pruned": _PER_SHARD
    + """, FALSE AS attempt_0, FALSE AS attempt_1, FALSE AS attempt_2, TRUE AS attempt_3, TRUE AS attempt_4
        FROM orders GROUP BY 1
    """,
    "reconcile_rows": """
        WITH source AS (SELECT *, CAST(o_orderkey % 4 AS INTEGER) AS shard_index FROM orders),
        changed AS (
          SELECT * REPLACE (CASE WHEN o_orderkey % 700 = 11 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
          FROM orders WHERE o_orderkey % 500 <> 7
        ),
        target AS (
          SELECT *, CAST(((o_orderkey % 4) + 4) % 4 AS INTEGER) AS shard_index FROM (
            SELECT * FROM changed
            UNION ALL SELECT * FROM changed WHERE o_orderkey % 900 = 13
            UNION ALL SELECT * FROM changed WHERE o_orderkey % 900 = 13
            UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM orders WHERE o_orderkey % 800 = 5
          )
        )
        SELECT *, 'source' AS side, COUNT(*) AS copies
        FROM (SELECT * FROM source EXCEPT ALL SELECT * FROM target) GROUP BY ALL
        UNION ALL
        SELECT *, 'target', COUNT(*) FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM source) GROUP BY ALL
    """,
    "reconcile_rows_documents": """
        WITH target AS (
          SELECT * REPLACE (CASE WHEN doc_id % 50 = 3 THEN substr(text, 2) ELSE text END AS text,
                            CASE WHEN doc_id % 70 = 4 THEN NULL ELSE lang END AS lang)
          FROM documents
        )
        SELECT *, 'source' AS side, COUNT(*) AS copies
        FROM (SELECT * FROM documents EXCEPT ALL SELECT * FROM target) GROUP BY ALL
        UNION ALL
        SELECT *, 'target', COUNT(*) FROM (SELECT * FROM target EXCEPT ALL SELECT * FROM documents) GROUP BY ALL
    """,
    "validate_damaged": """
        SELECT check_name, ok, level, named, CAST((SELECT COUNT(*) FROM orders) AS BIGINT) AS rows
        FROM (VALUES ('files_present', TRUE, 'footer', FALSE), ('files_not_empty', TRUE, 'footer', FALSE),
                     ('row_total', TRUE, 'footer', FALSE), ('files_present', TRUE, 'sample', FALSE),
                     ('files_not_empty', TRUE, 'sample', FALSE), ('row_total', TRUE, 'sample', FALSE),
                     ('values_decode', FALSE, 'sample', TRUE)) AS t(check_name, ok, level, named)
    """,
    "stream_old_files": """
        SELECT *, CAST(CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS INTEGER) AS batch FROM events
    """,
    "stream_available_now": """
        SELECT *, CAST(CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS INTEGER) AS batch FROM events
    """,
}
