import json
import os
import random
from datetime import date, datetime
from decimal import Decimal
from functools import partial

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from landed import data_files
from exportkit import Catalog, ExportJob, FrameSource, Incremental, ParquetOptions, RunLog, SqlSource, StateTable, UnloadOptions
from exportkit.functions import BatchTransform, derive, redact
from exportkit.operators import (
    read_export,
    unload,
    write_export,
    Bounds,
    CrossShards,
    ExportInvalid,
    ModShards,
    ValueShards,
    first_run_value,
    latest_per_key,
    upper_bound,
    window,
)
from exportkit.plans import read_files, read_manifest
from exportkit.session import delete_path, read_text, small_table
from exportkit.sources import JdbcSource, scalar


def few_orders(spark, count):
    """Orders as in the small fixtures: id, amount, hourly text time stamp."""
    rows = [(i, i * 10.0, f"2026-05-08 {i:02d}:00:00") for i in range(count)]
    return small_table(spark, rows, "id bigint, amount double, updated_at string")


def make_job(spark, root, count=20, **options):
    few_orders(spark, count).createOrReplaceTempView("few_orders")
    options.setdefault("source", SqlSource(query="SELECT * FROM few_orders"))
    return ExportJob(name="orders", base=f"{root}/data", catalog=f"{root}/catalog", **options)


def rows_of(spark, job, run_id, run):
    return read_files(Catalog(spark, job.catalog).run_files(job.name, run_id), run.path, run.schema)


# ------------------------------------------------------------------------- sources


def test_literal_query_keeps_names_and_order(spark, root):
    run = make_job(spark, root, 3, source=SqlSource(query="SELECT updated_at, id FROM few_orders")).run(spark, "r1")
    assert run.schema.fieldNames() == ["updated_at", "id"]


def test_template_values_and_precedence(spark):
    few_orders(spark, 5).createOrReplaceTempView("few_orders")
    text = "SELECT id FROM IDENTIFIER(:t) WHERE id >= :low AND id < :high"
    source = SqlSource(template=text, defaults={"t": "few_orders", "low": 0, "high": 1}, params={"low": 2, "high": 3})
    assert [r["id"] for r in source.load(spark, {"high": 5}).collect()] == [2, 3, 4]


def test_unbound_marker_is_an_error(spark):
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        SqlSource(template="SELECT :nothing AS a").load(spark)


def test_bound_values_are_not_pasted(spark):
    few_orders(spark, 3).createOrReplaceTempView("few_orders")
    source = SqlSource(template="SELECT id FROM few_orders WHERE updated_at = :v", params={"v": "x' OR '1'='1"})
    assert source.load(spark).count() == 0


def test_scalar_lookup(spark):
    few_orders(spark, 3).createOrReplaceTempView("few_orders")
    assert scalar(spark, "SELECT MAX(id), 7 FROM few_orders") == "2"
    assert scalar(spark, "SELECT MAX(id) FROM few_orders WHERE id > 9") is None
    assert scalar(spark, "SELECT id FROM few_orders WHERE id > 9") is None


# --------------------------------------------------------------------- whole exports


def test_four_modulo_shards(spark, root):
    job = make_job(spark, root, shards=ModShards("id", 4), md5=True, path="orders/{run_id}")
    run = job.run(spark, "r1")
    assert (run.total_rows, run.shards, run.mode, run.skipped) == (20, 4, "export", ())
    files = data_files(run.path)
    assert len(files) == 4
    manifest = json.loads(read_text(spark, run.manifest))
    assert manifest["version"] == 1 and manifest["total_rows"] == 20
    assert [f["shard_index"] for f in manifest["files"]] == [0, 1, 2, 3]
    assert all(f["rows"] == 5 and len(f["md5"]) == 32 and not f["skipped"] for f in manifest["files"])
    assert manifest["total_bytes"] == sum(os.path.getsize(p) for p in files) == run.total_bytes
    assert StructType.fromJson(json.loads(manifest["extra"]["schema"])) == run.schema


def test_manifest_place_and_extra(spark, root):
    job = make_job(spark, root, 2, manifest_path=f"{root}/elsewhere.json", extra={"tags": {"team": "a"}})
    run = job.run(spark, "r1")
    assert run.manifest == f"{root}/elsewhere.json"
    assert json.loads(read_text(spark, run.manifest))["extra"]["tags"] == {"team": "a"}
    assert make_job(spark, root, 2, manifest=False, path="quiet").run(spark, "r1").manifest is None


def test_manifest_is_replaced_whole_and_leaves_no_temporary_file(spark, root):
    job = make_job(spark, root, 4, path="same")
    first = job.run(spark, "r1")
    few_orders(spark, 2).createOrReplaceTempView("few_orders")
    second = job.run(spark, "r2")
    assert first.manifest == second.manifest
    assert json.loads(read_text(spark, second.manifest))["total_rows"] == 2
    assert not [n for n in os.listdir(second.path) if n.endswith(".tmp")]


def test_awkward_names_through_catalog_and_manifest(spark, root):
    names = ["a b", "50%", "x/y", "q+r", "ü", "c:d", "plain"]
    df = small_table(spark, [(i, names[i % 7]) for i in range(70)], "id int, region string")
    job = ExportJob(
        "orders", FrameSource(lambda s: df), f"{root}/data", f"{root}/catalog", path="by region/{run_id}",
        shards=ValueShards("region", names), skip_existing=True, md5=True,
    )
    run = job.run(spark, "r 1")
    back = rows_of(spark, job, "r 1", run)
    assert sorted(r["region"] for r in back.collect()) == sorted(names * 10)
    listed = read_manifest(spark, run.manifest).collect()
    assert all(os.path.exists(r["remote_uri"].removeprefix("file:")) and r["md5"] for r in listed)
    delete_path(spark, f"{run.path}/{job.shards.directory(2)}")
    again = job.run(spark, "r 1")
    assert again.skipped == (0, 1, 3, 4, 5, 6) and again.total_rows == 10
    assert rows_of(spark, job, "r 1", again).count() == 70


def test_reading_checks_the_row_total(spark, root):
    job = make_job(spark, root)
    run = job.run(spark, "r1")
    listed = Catalog(spark, job.catalog).run_files("orders", "r1").withColumn("rows", F.lit(99))
    with pytest.raises(ValueError, match="files hold 20"):
        read_files(listed, run.path, run.schema)


def test_empty_export(spark, root):
    job = make_job(spark, root, 0, shards=ModShards("id", 3))
    run = job.run(spark, "r1")
    assert (run.total_rows, run.total_bytes, run.shards) == (0, 0, 3)
    document = json.loads(read_text(spark, run.manifest))
    assert [f["remote_uri"] for f in document["files"]] == ["", "", ""]
    back = rows_of(spark, job, "r1", run)
    assert back.count() == 0 and back.columns == ["id", "amount", "updated_at", "shard_index"]


def test_transform_doubles_amounts(spark, root):
    job = make_job(spark, root, 3, transforms=[partial(derive, column="amount", expression="amount * 2")])
    run = job.run(spark, "r1")
    assert sorted(r["amount"] for r in rows_of(spark, job, "r1", run).collect()) == [0.0, 20.0, 40.0]


def test_masked_shard_key_and_arrow_step(spark, root):
    """Shards are cut before the transforms; the Arrow step never sees the shard column."""

    def keep_even(batch: pa.Table) -> pa.Table:
        assert "shard_index" not in batch.column_names
        mask = [v % 20 == 0 for v in batch["amount"].to_pylist()]
        return batch.filter(pa.array(mask, pa.bool_())).drop_columns(["updated_at"])

    job = make_job(
        spark, root, shards=ModShards("id", 4), transforms=[partial(redact, column="id"), BatchTransform(keep_even)]
    )
    run = job.run(spark, "r1")
    back = rows_of(spark, job, "r1", run)
    assert back.columns == ["id", "amount", "shard_index"]
    assert {r["id"] for r in back.collect()} == {"<redacted>"}
    assert {r[0]: r[1] for r in back.groupBy("shard_index").count().collect()} == {0: 5, 2: 5}


def test_target_schema(spark, root):
    target = StructType().add("id", StringType()).add("score", LongType())
    job = make_job(spark, root, 4, shards=ModShards("id", 2), target_schema=target)
    run = job.run(spark, "r1")
    assert run.schema.fieldNames() == ["id", "score", "shard_index"]
    assert sorted(r["id"] for r in rows_of(spark, job, "r1", run).collect()) == ["0", "1", "2", "3"]


def test_failing_shard_publishes_nothing(spark, root):
    def explode(batch: pa.Table) -> pa.Table:
        if 7 in batch["id"].to_pylist():
            raise ValueError("bad row")
        return batch

    rule = Incremental(column="updated_at")
    job = make_job(spark, root, shards=ModShards("id", 4), transforms=[BatchTransform(explode)], incremental=rule)
    with pytest.raises(Exception, match="bad row"):
        job.run(spark, "r1")
    assert not os.path.exists(f"{root}/data/r1/_manifest.json")
    assert Catalog(spark, job.catalog).entries().count() == 0
    assert StateTable(spark, job.catalog).watermark("orders") is None


def test_failed_check_publishes_nothing(spark, root, monkeypatch):
    from exportkit.operators import inventory as inv

    real = inv.validate
    monkeypatch.setattr(inv, "validate", lambda *a, **k: real(*a, **k).withColumn("ok", F.lit(False)))
    job = make_job(spark, root)
    with pytest.raises(ExportInvalid):
        job.run(spark, "r1")
    assert not os.path.exists(f"{root}/data/r1/_manifest.json")
    assert Catalog(spark, job.catalog).entries().count() == 0


def test_bulk_unload_through_the_job(spark, root):
    job = make_job(spark, root, bulk=UnloadOptions(format="csv"), check="full", shards=ModShards("id", 4))
    run = job.run(spark, "r1")
    assert (run.mode, run.total_rows, run.shards) == ("unload", 20, 1)
    assert all(p.endswith(".csv.gz") for p in data_files(run.path))


def test_bulk_unload_is_skipped_when_it_landed(spark, root):
    job = make_job(spark, root, bulk=UnloadOptions(), path="bulk", skip_existing=True)
    assert job.run(spark, "r1").total_rows == 20
    again = job.run(spark, "r2")
    assert again.skipped == (0,) and again.total_rows == 0


def test_run_log(spark, root):
    job = make_job(spark, root, shards=ModShards("id", 4))
    job.run(spark, "r1")
    job.run(spark, "r2")
    log = {r["run_id"]: r for r in RunLog(spark, job.catalog).rows().collect()}
    assert set(log) == {"r1", "r2"} and log["r1"]["total_rows"] == 20 and log["r1"]["elapsed_s"] > 0


# ---------------------------------------------------------------------------- skip


def untouchable(spark):
    raise AssertionError("the source was read")


def test_everything_landed_reads_no_source(spark, root):
    job = make_job(spark, root, shards=ModShards("id", 4), skip_existing=True, path="orders", md5=True)
    first = job.run(spark, "r1")
    again = make_job(
        spark, root, shards=ModShards("id", 4), skip_existing=True, path="orders", source=FrameSource(untouchable)
    )
    second = again.run(spark, "r2")
    assert second.skipped == (0, 1, 2, 3) and (second.total_rows, second.total_bytes) == (0, 0)
    entries = Catalog(spark, job.catalog).run("orders", "r2").collect()
    assert all(e["skipped"] and e["rows"] == 0 and e["bytes"] == 0 and e["md5"] is None and e["uri"] for e in entries)
    back = read_files(Catalog(spark, job.catalog).run_files("orders", "r2"), first.path, first.schema)
    assert back.count() == 20


def test_lost_shard_is_written_again_and_only_that(spark, root):
    job = make_job(spark, root, shards=ModShards("id", 4), skip_existing=True, path="orders")
    first = job.run(spark, "r1")
    kept = set(data_files(f"{first.path}/shard_index=1"))
    delete_path(spark, f"{first.path}/shard_index=2")
    second = job.run(spark, "r1")
    assert second.skipped == (0, 1, 3) and second.total_rows == 5
    assert set(data_files(f"{first.path}/shard_index=1")) == kept
    assert rows_of(spark, job, "r1", second).count() == 20


def test_partly_lost_shard_and_crash_leftovers(spark, root):
    """A shard with one of its files gone is redone; files nobody recorded do not count."""
    job = make_job(spark, root, shards=ModShards("id", 2), skip_existing=True, path="orders")
    first = job.run(spark, "r1")
    target = data_files(f"{first.path}/shard_index=0")[0]
    stray = os.path.join(os.path.dirname(target), "part-99999-stray.zstd.parquet")
    with open(target, "rb") as source, open(stray, "wb") as copy:
        copy.write(source.read())
    os.remove(target)
    second = job.run(spark, "r2")
    assert second.skipped == (1,)
    assert not os.path.exists(stray)
    assert rows_of(spark, job, "r2", second).count() == 20


def test_empty_shard_is_tried_again(spark, root):
    job = make_job(spark, root, 3, shards=ModShards("id", 4), skip_existing=True, path="orders")
    job.run(spark, "r1")
    few_orders(spark, 4).createOrReplaceTempView("few_orders")
    second = job.run(spark, "r2")
    assert second.skipped == (0, 1, 2) and second.total_rows == 1


def test_hive_shards_skip(spark, root):
    layout = CrossShards({"id": [1, 2, 3], "amount": [10.0, 20.0, 30.0]})
    job = make_job(spark, root, 5, shards=layout, skip_existing=True, path="orders")
    first = job.run(spark, "r1")
    assert first.total_rows == 3
    delete_path(spark, f"{first.path}/{layout.directory(4)}")
    second = job.run(spark, "r2")
    assert second.skipped == (0, 8) and second.total_rows == 1


def test_full_rewrite_with_fewer_shards_drops_old_entries(spark, root):
    job = make_job(spark, root, shards=ModShards("id", 4), path="orders")
    job.run(spark, "r1")
    fewer = make_job(spark, root, shards=ModShards("id", 2), path="orders")
    fewer.run(spark, "r2")
    current = Catalog(spark, job.catalog).latest_files()
    assert {(r["run_id"], r["shard_index"]) for r in current.collect()} == {("r2", 0), ("r2", 1)}
    assert all(os.path.exists(r["uri"].removeprefix("file:")) for r in current.collect())


def test_no_overwrite(spark, root):
    job = make_job(spark, root, path="orders", overwrite=False)
    job.run(spark, "r1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        job.run(spark, "r2")


# ---------------------------------------------------------------------- incremental

TEMPLATE = SqlSource(
    template="SELECT * FROM few_orders WHERE updated_at > :watermark_prev AND updated_at <= :watermark_now"
)
BY_QUERY = Incremental(watermark_query="SELECT MAX(updated_at) FROM few_orders")


def test_first_run_takes_all(spark, root):
    job = make_job(spark, root, 5, source=TEMPLATE, incremental=BY_QUERY)
    run = job.run(spark, "r1")
    assert (run.total_rows, run.watermark) == (5, "2026-05-08 04:00:00")
    assert StateTable(spark, job.catalog).watermark("orders") == "2026-05-08 04:00:00"


def test_second_run_takes_the_rest(spark, root):
    job = make_job(spark, root, 5, source=TEMPLATE, incremental=BY_QUERY)
    StateTable(spark, job.catalog).commit("orders", "r0", Bounds("", "2026-05-08 02:00:00", "string"))
    run = job.run(spark, "r1")
    assert sorted(r["id"] for r in rows_of(spark, job, "r1", run).collect()) == [3, 4]


def test_empty_source_keeps_the_window(spark, root):
    job = make_job(spark, root, 0, source=TEMPLATE, incremental=BY_QUERY)
    run = job.run(spark, "r1")
    assert (run.total_rows, run.watermark) == (0, "1970-01-01 00:00:00")


def test_window_on_a_numeric_column_needs_a_default(spark, root):
    with pytest.raises(ValueError, match="explicit default"):
        make_job(spark, root, 5, incremental=Incremental(column="id")).run(spark, "r1")
    job = make_job(spark, root, 12, incremental=Incremental(column="id", default="1"))
    run = job.run(spark, "r1")
    assert sorted(r["id"] for r in rows_of(spark, job, "r1", run).collect()) == list(range(2, 12))


def test_query_may_use_the_lower_bound(spark, root):
    rule = Incremental(watermark_query="SELECT MAX(updated_at) FROM few_orders WHERE updated_at > :watermark_prev")
    assert make_job(spark, root, 5, source=TEMPLATE, incremental=rule).run(spark, "r1").total_rows == 5


def test_random_windows_cover_every_row_once(spark, root):
    rng = random.Random(11)
    few_orders(spark, 24).createOrReplaceTempView("few_orders")
    source = SqlSource(query="SELECT * FROM few_orders")
    seen = []
    for n, hour in enumerate(sorted(rng.sample(range(23), 3)) + [23]):
        rule = Incremental(column="updated_at", now=f"2026-05-08 {hour:02d}:00:00")
        job = ExportJob("orders", source, f"{root}/data", f"{root}/catalog", incremental=rule)
        run = job.run(spark, f"r{n}")
        seen += [r["id"] for r in rows_of(spark, job, f"r{n}", run).collect()]
    assert sorted(seen) == list(range(24))


def test_crash_before_commit_replays_the_same_window(spark, root, monkeypatch):
    job = make_job(spark, root, 5, source=TEMPLATE, incremental=BY_QUERY, skip_existing=True)
    with monkeypatch.context() as m:
        m.setattr(StateTable, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            job.run(spark, "r1")
    few_orders(spark, 9).createOrReplaceTempView("few_orders")
    again = job.run(spark, "r1")
    assert again.skipped == (0,) and again.watermark == "2026-05-08 04:00:00"
    assert StateTable(spark, job.catalog).watermark("orders") == "2026-05-08 04:00:00"
    nxt = job.run(spark, "r2")
    assert sorted(r["id"] for r in rows_of(spark, job, "r2", nxt).collect()) == [5, 6, 7, 8]


def test_all_skipped_without_a_plan_does_not_move_the_window(spark, root):
    plain = make_job(spark, root, 5, path="orders")
    plain.run(spark, "r1")
    job = make_job(spark, root, 5, path="orders", source=TEMPLATE, incremental=BY_QUERY, skip_existing=True)
    assert job.run(spark, "r2").skipped == (0,)
    assert StateTable(spark, job.catalog).watermark("orders") is None


def test_watermark_never_moves_back(spark, root):
    state = StateTable(spark, root)
    assert state.commit("j", "r1", Bounds("0", "10", "bigint"))
    assert not state.commit("j", "r2", Bounds("0", "9", "bigint"))
    assert state.watermark("j") == "10"
    assert state.watermark("other") is None


def test_planned_window_is_kept(spark, root):
    state = StateTable(spark, root)
    first = state.plan("j", "r1", Bounds("0", "5", "bigint"))
    assert state.plan("j", "r1", Bounds("0", "9", "bigint")) == first
    assert state.watermark("j") is None


def test_rules_are_checked(spark, root):
    with pytest.raises(ValueError):
        Incremental()
    with pytest.raises(ValueError):
        Incremental(watermark_query="SELECT 1", now="x")
    with pytest.raises(ValueError):
        Incremental(now="x", lateness="1 hour")
    with pytest.raises(ValueError, match="literal query"):
        make_job(spark, root, 1, incremental=BY_QUERY)
    with pytest.raises(ValueError, match=":watermark_now"):
        make_job(
            spark, root, 1, source=SqlSource(template="SELECT 1 WHERE 1 > :watermark_prev"), incremental=BY_QUERY
        )
    with pytest.raises(ValueError):
        make_job(spark, root, 1, path="../x")


def test_values_as_text(spark):
    rows = [(datetime(2026, 5, 8, 1, 2, 3, 4000), date(2026, 5, 8), 7, Decimal("1.50"), "x")]
    df = small_table(spark, rows, "a timestamp_ntz, b date, c bigint, d decimal(5,2), e string")
    assert [upper_bound(df, c) for c in "abcde"] == ["2026-05-08 01:02:03.004", "2026-05-08", "7", "1.50", "x"]
    assert upper_bound(df.limit(0), "a") is None


def test_first_run_values():
    from pyspark.sql.types import BooleanType, DateType, TimestampNTZType, TimestampType

    assert first_run_value(DateType()) == "1970-01-01"
    for kind in (TimestampType(), TimestampNTZType(), StringType()):
        assert first_run_value(kind) == "1970-01-01 00:00:00"
    for kind in (LongType(), BooleanType()):
        with pytest.raises(ValueError):
            first_run_value(kind)


def test_window_edges_and_nulls(spark):
    df = small_table(spark, [(v,) for v in (1, 2, 3, 4, None)], "v int")
    assert sorted(r["v"] for r in window(df, "v", Bounds("1", "3", "int")).collect()) == [2, 3]


def test_latest_per_key_with_a_hot_key(spark):
    rows = [(1, i, f"a{i}") for i in range(900)] + [(k, 0, "b") for k in range(2, 50)] + [(None, 5, "n"), (None, 6, "m")]
    df = small_table(spark, rows, "k int, t int, v string").repartition(8)
    result = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["t", "v"]).collect()}
    assert result[1] == "a899" and result[None] == "m" and len(result) == 50


def test_exact_timestamps_option(spark, events, root):
    job = ExportJob(
        "events", FrameSource(lambda s: events), f"{root}/data", f"{root}/catalog", parquet=ParquetOptions(coerce_timestamps=None)
    )
    run = job.run(spark, "r1")
    back = read_files(Catalog(spark, job.catalog).run_files("events", "r1"), run.path, run.schema)
    assert back.exceptAll(events).count() == 0


# ------------------------------------------------------- windows, attempts, sessions


@pytest.mark.parametrize("source", [
    FrameSource(lambda s: s.range(3)),
    JdbcSource("jdbc:x", table="t"),
])
def test_sources_without_a_window_are_refused(root, source):
    with pytest.raises(ValueError, match="cannot see the window"):
        ExportJob("w", source, root, root, incremental=Incremental(now="2024-01-01 00:00:00"))


def test_a_windowed_frame_gets_the_bounds(spark, root, events):
    def build(session, values):
        return events.filter((F.col("ts") > F.lit(values["watermark_prev"]).cast("timestamp_ntz"))
                             & (F.col("ts") <= F.lit(values["watermark_now"]).cast("timestamp_ntz")))

    rule = Incremental(now="2024-01-10 00:00:00", default="2024-01-05 00:00:00")
    run = ExportJob("w", FrameSource(build, windowed=True), root, f"{root}/c", incremental=rule).run(spark, "r1")
    assert run.total_rows == events.filter("ts > '2024-01-05' and ts <= '2024-01-10'").count() > 0


def test_bounds_mean_the_same_in_another_zone(spark, root, events):
    instants = events.withColumn("at", F.col("ts").cast("timestamp"))
    instants.write.parquet(f"{root}/in")
    source = FrameSource(lambda s: s.read.parquet(f"{root}/in"))
    first = Incremental(column="at", now="2024-01-12 03:00:00")
    total = ExportJob("z", source, root, f"{root}/c", incremental=first).run(spark, "r1").total_rows
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rest = Incremental(column="at")
        total += ExportJob("z", source, root, f"{root}/c", incremental=rest).run(spark, "r2").total_rows
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert total == events.count()


def test_failed_rerun_leaves_no_attempt_behind(spark, root, orders):
    path = f"{root}/out"
    write_export(orders, path)
    with pytest.raises(Exception, match="stop"):
        write_export(orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("stop"))).cast("double")), path)
    assert spark.read.parquet(path).count() == orders.count()
    assert os.listdir(root) == ["out"]


def test_nested_timestamps_and_null_rows_survive(spark, root):
    nested = spark.sql("SELECT struct(TIMESTAMP '2024-01-01 00:00:00.123456' AS t) AS s")
    write_export(nested, f"{root}/n", parquet=ParquetOptions(coerce_timestamps="ms"))
    assert spark.read.parquet(f"{root}/n").collect() == nested.collect()
    lone = small_table(spark, [("a",), (None,), ("",), ("b",)], "x string")
    back = read_export(spark, unload(lone, f"{root}/c", UnloadOptions(format="csv")))
    assert sorted(map(repr, back.collect())) == sorted(map(repr, lone.collect()))
    with pytest.raises(Exception, match="directory name"):
        write_export(small_table(spark, [("", 3), ("a", 4)], "k string, v int"), f"{root}/p", partition_by=["k"])
