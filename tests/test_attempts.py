"""Attempts and their pointer, session settings, files of a measured size, rows that differ."""

import json
import os
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from landed import data_files
from pyspark.sql import functions as F

from exportkit import Catalog, ExportJob, FrameSource, Incremental, LayoutOptions, ParquetOptions, UnloadOptions
from exportkit.functions import differences
from exportkit.operators import (
    ModShards,
    differing_rows,
    file_facts,
    files,
    footers,
    landed_schemas,
    listed,
    read_export,
    reconcile,
    unload,
    write_export,
)
from exportkit.operators import cut
from exportkit.operators.cut import file_place
from exportkit.plans import read_files, read_manifest
from exportkit.session import read_text, small_table, with_settings

EXACT = ParquetOptions(coerce_timestamps=None)


def order_job(orders, root, **options):
    options.setdefault("source", FrameSource(lambda s: orders))
    return ExportJob(name="orders", base=f"{root}/data", catalog=f"{root}/catalog", parquet=EXACT, path="orders", **options)


def rows_of(spark, job, run_id, run):
    return read_files(Catalog(spark, job.catalog).run_files(job.name, run_id), run.path, run.schema)


# --- attempts


def test_every_attempt_has_a_folder_and_one_entry_file(spark, orders, root):
    job = order_job(orders, root, shards=ModShards("o_orderkey", 4))
    first, second = job.run(spark, "r1"), job.run(spark, "r2")
    assert first.path != second.path and os.path.dirname(first.path) == os.path.dirname(second.path)
    assert sorted(os.listdir(f"{root}/data/orders")) == sorted(["_manifest.json", "._manifest.json.crc", *map(os.path.basename, (first.path, second.path))])
    assert len(data_files(f"{root}/catalog/files")) == 2
    listed_files = json.loads(read_text(spark, second.manifest))["files"]
    assert all(os.path.basename(second.path) in f["remote_uri"] for f in listed_files)
    assert Catalog(spark, job.catalog).folder_of("orders", f"{root}/data/orders").endswith(second.path)


def test_a_reader_keeps_its_attempt(spark, orders, root):
    job = order_job(orders, root)
    first = job.run(spark, "r1")
    reader = rows_of(spark, job, "r1", first)
    few = replace(job, source=FrameSource(lambda s: orders.limit(3)))
    few.run(spark, "r2")
    assert reader.count() == 1_500
    few.run(spark, "r3")
    assert not os.path.exists(first.path)


def test_nothing_is_renamed_by_a_rerun(spark, orders, root):
    """Files of the first attempt keep their names and times through a second one."""
    job = order_job(orders, root, shards=ModShards("o_orderkey", 2), keep_attempts=2)
    first = job.run(spark, "r1")
    before = {p: os.stat(p).st_ino for p in data_files(first.path)}
    job.run(spark, "r2")
    assert {p: os.stat(p).st_ino for p in data_files(first.path)} == before


@pytest.mark.parametrize("check", ["sample", None])
def test_a_failed_attempt_leaves_no_folder(spark, orders, root, check, monkeypatch):
    job = order_job(orders, root, check=check)
    first = job.run(spark, "r1")
    stop = lambda df: df.withColumn("o_custkey", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        replace(job, transforms=[stop]).run(spark, "r2")
    assert [n for n in os.listdir(f"{root}/data/orders") if n.startswith("attempt")] == [os.path.basename(first.path)]
    assert rows_of(spark, job, "r1", first).count() == 1_500
    assert read_manifest(spark, first.manifest).agg(F.sum("rows")).first()[0] == 1_500


def test_a_listed_file_that_is_gone_is_named(spark, orders, root):
    job = order_job(orders, root, shards=ModShards("o_orderkey", 4))
    run = job.run(spark, "r1")
    os.remove(data_files(run.path)[0])
    with pytest.raises(ValueError, match="1 files that the catalog lists"):
        rows_of(spark, job, "r1", run)


def test_files_that_nobody_listed_are_left_out(spark, orders, root):
    job = order_job(orders, root, shards=ModShards("o_orderkey", 4))
    run = job.run(spark, "r1")
    path = data_files(run.path)[0]
    with open(path, "rb") as source, open(path.replace("part-", "part-9"), "wb") as stray:
        stray.write(source.read())
    assert rows_of(spark, job, "r1", run).count() == 1_500


def test_window_and_values_in_the_path(spark, events, root):
    rule = Incremental(column="ts", now="2024-01-10 00:00:00", default="2024-01-05 00:00:00")
    job = ExportJob("w", FrameSource(lambda s: events), root, f"{root}/c", incremental=rule, path="{team}/{watermark_now}/{run_id}")
    run = job.run(spark, "r1", {"team": "a"})
    assert run.path.startswith(f"{root}/a/2024-01-10 00:00:00/r1/") and run.total_rows > 0
    assert rows_of(spark, job, "r1", run).count() == run.total_rows
    with pytest.raises(ValueError, match="team"):
        job.run(spark, "r2")
    with pytest.raises(ValueError, match="must not contain"):
        job.run(spark, "r3", {"team": "../.."})


def test_manifest_has_one_line_per_file(spark, orders, root):
    job = order_job(orders, root, shards=ModShards("o_orderkey", 7), extra={"note": "x\ny"})
    run = job.run(spark, "r1")
    text = read_text(spark, run.manifest)
    document = json.loads(text)
    assert len(document["files"]) == 7 == sum('"shard_index"' in line for line in text.splitlines())
    assert document["extra"]["note"] == "x\ny" and document["total_rows"] == 1_500
    empty = replace(job, source=FrameSource(lambda s: orders.limit(0))).run(spark, "r2")
    assert [f["rows"] for f in json.loads(read_text(spark, empty.manifest))["files"]] == [0] * 7


# --- settings


def test_exports_leave_the_session_as_it_was(spark, orders, root):
    before = spark.conf.getAll
    write_export(orders, f"{root}/a", ModShards("o_orderkey", 3), layout=LayoutOptions(target_file_bytes=1 << 20))
    unload(orders, f"{root}/b", UnloadOptions(max_file_bytes=8 << 10, single=True))
    order_job(orders, root).run(spark, "r1")
    assert spark.conf.getAll == before


def test_overlapping_scopes_do_not_meet(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    df = spark.range(3)
    with with_settings(df, {key: "1b"}) as first:
        with with_settings(df, {key: "2b"}) as second:
            assert first.sparkSession.conf.get(key) == "1b" and second.sparkSession.conf.get(key) == "2b"
        assert first.count() == 3
    assert spark.conf.get(key, None) == before
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("exportkit_")]


def test_settings_of_the_caller_go_along(spark, events, root):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with with_settings(events, {}) as other:
            assert other.sparkSession.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# --- files of a measured size


def ordered_rows(path, column):
    found = []
    for name in data_files(path):
        found += pq.read_table(name, columns=[column])[column].to_pylist()
    return found


@pytest.mark.parametrize("cap", [3_000, 8 << 10, 20 << 10])
@pytest.mark.parametrize("options", [{}, {"single": True}, {"order_by": ("o_totalprice",)}, {"single": True, "order_by": ("o_totalprice",)}, {"spread": False}])
def test_any_cap_holds(spark, orders, root, cap, options):
    written = unload(orders.repartition(5), root, UnloadOptions(max_file_bytes=cap, **options), checksum=True)
    sizes = [os.path.getsize(p) for p in data_files(root)]
    assert max(sizes) <= cap and len(sizes) > 1
    assert reconcile(orders, read_export(spark, written), by=[]).first()["matches"]
    assert written.rows == files(spark, written).agg(F.sum("rows")).first()[0] == 1_500
    if "order_by" in options:
        prices = ordered_rows(root, "o_totalprice")
        assert prices == sorted(prices)


@pytest.mark.parametrize("format, codec", [("csv", "none"), ("csv", "gzip"), ("json", "none"), ("json", "gzip")])
def test_caps_of_text_formats(spark, root, format, codec):
    """Rows of very different lengths, the longest ones at the end of the order."""
    wide = F.expr("repeat(sha2(cast(id as string), 256), cast(id * id / 4000 as int) + 1)")
    source = spark.range(0, 900, 1, 3).select("id", wide.alias("text"))
    options = UnloadOptions(format=format, compression=codec, max_file_bytes=64 << 10, order_by=("id",))
    written = unload(source, root, options)
    assert max(os.path.getsize(p) for p in data_files(root)) <= 64 << 10
    assert reconcile(source, read_export(spark, written), by=[]).first()["matches"]
    spans = read_export(spark, written).groupBy(file_place(F.col("_metadata.file_name")).alias("p")).agg(F.min("id").alias("a"), F.max("id").alias("b"))
    edges = [(r["a"], r["b"]) for r in spans.orderBy("p").collect()]
    assert all(b < c for (_, b), (c, _) in zip(edges, edges[1:])) and edges[-1][1] == 899


def test_a_row_above_the_cap_stands_alone(spark, root):
    source = small_table(spark, [(i, "x" * (9_000 if i == 4 else 10)) for i in range(9)], "id int, text string")
    written = unload(source, root, UnloadOptions(format="json", compression="none", max_file_bytes=4_000))
    sizes = sorted(os.path.getsize(p) for p in data_files(root))
    assert sizes[-1] > 9_000 and all(s <= 4_000 for s in sizes[:-1])
    assert reconcile(source, read_export(spark, written), by=[]).first()["matches"]


def test_a_single_sequence_is_filled_up(spark, orders, root):
    unload(orders.repartition(9), root, UnloadOptions(single=True, order_by=("o_totalprice",), max_file_bytes=9_000))
    sizes = [os.path.getsize(p) for p in data_files(root)]
    assert max(sizes) <= 9_000 and min(sizes[:-1]) >= 4_500


def test_a_large_single_file_is_written_from_packs(spark, root, monkeypatch):
    """Rows of all kinds come back in order; the task that writes the file sorts packs, not rows."""
    taken = []
    unpack = cut.unpacked
    monkeypatch.setattr(cut, "PACK_ABOVE", 64 << 10)
    monkeypatch.setattr(cut, "PACK_BYTES", 8 << 10)
    monkeypatch.setattr(cut, "unpacked", lambda packs, schema: taken.append(packs.columns) or unpack(packs, schema))
    source = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("a text"),
        (F.col("id") / 3).cast("decimal(12,4)").alias("price"),
        F.timestamp_micros(F.col("id") * 1_000_003).alias("at"),
        F.array(F.struct("id", F.lit(None).cast("string").alias("none"))).alias("nested"),
        F.col("id").cast("string").cast("binary").alias("raw"),
    )
    options = UnloadOptions(single=True, order_by=("a text",), max_file_bytes=600_000)
    written = unload(source, root, options)
    assert taken and "pack" in taken[0]
    back = read_export(spark, written)
    assert back.exceptAll(source).isEmpty() and source.exceptAll(back).isEmpty()
    assert ordered_rows(root, "a text") == sorted(r["a text"] for r in source.select("a text").collect())
    assert max(os.path.getsize(p) for p in data_files(root)) <= 600_000


def test_many_small_files_come_from_few_tasks(spark, orders, root):
    """Each task costs the driver some kilobytes, so a file that is far below a task's share has no task of its own."""
    written = unload(orders.repartition(5), root, UnloadOptions(max_file_bytes=3_000))
    names = [os.path.basename(p) for p in data_files(root)]
    writers = {(n.split("-c")[0]) for n in names}
    assert len(names) > 3 * len(writers)
    assert max(os.path.getsize(p) for p in data_files(root)) <= 3_000
    assert reconcile(orders, read_export(spark, written), by=[]).first()["matches"]


@pytest.mark.parametrize("rows, size, capacity, most", [(10, 101, 100, 5), (10, 1_000, 100, 1), (2, 101, 100, 1), (3, 9_000, 100, 1), (1_000, 1_000_000, 90_000, 84)])
def test_parts_of_a_file_are_even_and_smaller(rows, size, capacity, most):
    assert cut.even_rows(rows, size, capacity) == most


def test_nothing_to_unload(spark, orders, root):
    written = unload(orders.limit(0), root, UnloadOptions(single=True, order_by=("o_totalprice",), max_file_bytes=100))
    assert written.rows == 0 and read_export(spark, written).count() == 0


def test_overwriting_unload_holds_the_cap(spark, orders, root):
    for cap in (1 << 20, 6_000):
        written = unload(orders, root, UnloadOptions(max_file_bytes=cap))
    assert max(os.path.getsize(p) for p in data_files(root)) <= 6_000
    assert read_export(spark, written).count() == 1_500


# --- hot directories


def test_a_hot_shard_from_one_task_splits(spark, root):
    rows = spark.range(0, 50_000, 1, 1).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 3 + 1).otherwise(F.lit(None)).alias("k"))
    layout = LayoutOptions(hot_rows=4_000, target_file_bytes=20_000)
    written = write_export(rows, root, partition_by=["k"], layout=layout)
    assert reconcile(rows, read_export(spark, written), by=[]).first()["matches"]
    hot = [r["rows"] for r in files(spark, written).where(F.col("uri").contains("HIVE_DEFAULT")).collect()]
    assert sum(hot) == 45_000 and max(hot) <= 12_000 and len(hot) >= 5
    cold = files(spark, written).where(~F.col("uri").contains("HIVE_DEFAULT")).count()
    assert cold == 3


# --- footers


def test_footer_facts(spark, orders, root):
    write_export(orders.coalesce(1), root, parquet=ParquetOptions(row_group_rows=400, compression="gzip", dictionary=False))
    chunks = footers(spark, root)
    assert chunks.count() == 4 * len(orders.columns)
    (fact,) = file_facts(chunks).collect()
    assert (fact["row_groups"], fact["largest_group"], fact["codecs"], fact["with_dictionary"]) == (4, 400, ["GZIP"], [])
    assert fact["with_statistics"] == sorted(orders.columns)
    assert chunks.groupBy("row_group").agg(F.first("group_rows")).orderBy("row_group").collect()[3][1] == 300
    assert chunks.agg(F.min("offset"), F.min("bytes")).first()[0] >= 4


def test_landed_schemas_come_back_whole(spark, root):
    nested = spark.sql("SELECT 1 AS a, named_struct('x', array(map('k', DECIMAL(2.5)))) AS s, TIMESTAMP_NTZ '2024-01-01' AS t")
    write_export(nested, f"{root}/1", parquet=EXACT)
    nested.limit(0).withColumn("b", F.lit(True)).write.mode("append").parquet(f"{root}/1")
    (most, n), *_ = landed_schemas(spark, f"{root}/1")
    assert n == 1
    found = [schema.simpleString() for schema, _ in landed_schemas(spark, f"{root}/1")]
    assert nested.schema.simpleString() in found
    assert listed(spark, f"{root}/1").count() == len(data_files(f"{root}/1"))


def test_differences_go_as_deep_as_types_do(spark):
    before = spark.sql("SELECT 1 AS a, named_struct('x', 1, 'y', array(named_struct('p', 1, 'q', 2))) AS s, map('k', 1) AS m, 'v' AS gone").schema
    after = spark.sql("SELECT 1L AS a, named_struct('y', array(named_struct('p', 'z', 'r', 2)), 'x', 1) AS s, map('k', 1.5D) AS m, array(1) AS n").schema
    assert differences(before, after) == [
        ("a", "int", "bigint", "retyped"),
        ("s.y.element.p", "int", "string", "retyped"),
        ("s.y.element.q", "int", None, "removed"),
        ("s.y.element.r", None, "int", "added"),
        ("m.value", "int", "double", "retyped"),
        ("gone", "string", None, "removed"),
        ("n", None, "array<int>", "added"),
    ]
    assert differences(before, before) == []


# --- rows that differ


def test_differing_rows_count_copies(spark):
    schema = "a int, b string, m map<string,int>, d double"
    base = [(1, None, {"x": 1, "y": 2}, 0.0), (1, None, {"x": 1, "y": 2}, 0.0), (2, "q", None, float("nan")), (3, "r", {}, 1.0)]
    other = [(1, None, {"y": 2, "x": 1}, 0.0), (2, "q", None, float("nan")), (3, "r", {"z": 1}, 1.0), (4, "", {}, None), (4, "", {}, None)]
    left, right = small_table(spark, base, schema), small_table(spark, other, schema)
    found = sorted(((r["a"], r["b"], r["m"], r["side"], r["copies"]) for r in differing_rows(left, right).collect()), key=repr)
    assert found == sorted(
        [(1, None, {"x": 1, "y": 2}, "source", 1), (3, "r", {}, "source", 1), (3, "r", {"z": 1}, "target", 1), (4, "", {}, "target", 2)], key=repr
    )
    assert differing_rows(left, left.repartition(3)).count() == 0
    assert differing_rows(left.limit(0), right.limit(0)).count() == 0


@pytest.mark.parametrize("levels", [1, 3])
def test_differing_rows_of_many(spark, levels):
    left = spark.range(0, 60_000, 1, 6).selectExpr("id", "id % 7 AS k", "cast(id AS string) AS t")
    right = left.selectExpr("id", "CASE WHEN id % 10007 = 3 THEN 9 ELSE k END AS k", "t").where("id <> 77").repartition(4)
    found = sorted((r["id"], r["k"], r["side"]) for r in differing_rows(left, right, levels).collect())
    expected = [(77, 0, "source")]
    for i in range(3, 60_000, 10007):
        expected += [(i, i % 7, "source"), (i, 9, "target")]
    assert found == sorted(expected)


def test_only_differing_buckets_go_on(spark):
    """The comparison value by value sees the rows of differing buckets, not all rows."""
    left = spark.range(0, 40_000, 1, 4).selectExpr("id", "id * 2 AS v")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    right = left.where("id <> 5")
    differing_rows(left.mapInArrow(count, "id bigint, v bigint"), right)
    assert seen.value == 4 * 40_000  # three levels and the comparison read the source, nothing more
