import os
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from landed import data_files
from exportkit import LayoutOptions, ParquetOptions, UnloadOptions
from exportkit.operators import (
    ExportInvalid,
    ModShards,
    SingleShard,
    file_md5,
    files,
    landed_files,
    read_export,
    reconcile,
    require_valid,
    unload,
    validate,
    write_export,
)
from exportkit.operators.fingerprint import fingerprint
from exportkit.operators.shards import DAY_COLUMNS, day_columns
from exportkit.session import small_table

EXACT = ParquetOptions(coerce_timestamps=None)


def same(source, target):
    rows = reconcile(source, target, by=[]).collect()
    return len(rows) == 1 and rows[0]["matches"] and rows[0]["source_rows"] > 0


@pytest.mark.parametrize(
    "codec, stored",
    [("zstd", "ZSTD"), ("snappy", "SNAPPY"), ("gzip", "GZIP"), ("lz4", "LZ4"), ("none", "UNCOMPRESSED")],
)
def test_codec_reaches_the_file(spark, orders, root, codec, stored):
    written = write_export(orders, root, parquet=ParquetOptions(compression=codec, coerce_timestamps=None))
    assert pq.read_metadata(data_files(root)[0]).row_group(0).column(0).compression == stored
    assert same(orders, read_export(spark, written))


def test_row_group_limit(orders, root):
    write_export(orders.coalesce(1), root, parquet=ParquetOptions(row_group_rows=100))
    meta = pq.read_metadata(data_files(root)[0])
    assert meta.num_row_groups == 15 and meta.row_group(0).num_rows == 100


@pytest.mark.parametrize("on", [True, False])
def test_statistics_and_dictionary_switches(orders, root, on):
    write_export(orders, root, parquet=ParquetOptions(statistics=on, dictionary=on))
    column = pq.read_metadata(data_files(root)[0]).row_group(0).column(5)
    assert column.is_stats_set == on
    assert any("DICT" in e for e in column.encodings) == on


def test_written_rows_are_counted_behind_the_shuffle(orders, root):
    assert write_export(orders.repartition(13), root, ModShards("o_orderkey", 4)).rows == 1_500


@pytest.mark.parametrize("layout", [SingleShard(), ModShards("o_orderkey", 4)])
def test_statically_empty_source(spark, orders, root, layout):
    written = write_export(orders.filter("1 = 0"), root, layout)
    assert written.rows == 0
    assert read_export(spark, written).count() == 0
    listing = landed_files(spark, written, layout)
    assert [r["uri"] for r in listing.collect()] == [""] * layout.count
    require_valid(validate(spark, written, listing, level="full"))


def test_spread_uses_every_core(spark, root):
    one_task = spark.range(0, 400_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    written = write_export(one_task, f"{root}/a", layout=LayoutOptions(spread=True))
    assert same(one_task, read_export(spark, written)) and len(data_files(f"{root}/a")) > 4
    unload(one_task, f"{root}/b")
    assert len(data_files(f"{root}/b")) > 4
    unload(one_task, f"{root}/c", UnloadOptions(spread=False))
    assert len(data_files(f"{root}/c")) == 1


def test_copies_of_one_row_spread(spark, root):
    """One task reads rows of which nine in ten are copies: no file holds them all."""
    wide = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 256) for i in range(8)])
    text = F.when(F.col("id") % 10 == 0, wide).otherwise("x")
    copies = spark.range(0, 200_000, 1, 1).select(text.alias("text"))
    written = write_export(copies, root, layout=LayoutOptions(spread=True, target_file_bytes=1 << 20))
    sizes = [r["rows"] for r in files(spark, written).collect()]
    assert len(sizes) > 4 and max(sizes) < 2 * min(sizes)


def test_unload_reads_its_source_once(spark, root):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = spark.range(0, 5_000, 1, 4).mapInArrow(count, "id bigint")
    unload(source, root, UnloadOptions(max_file_bytes=4_096))
    assert read.value == 5_000


def test_wide_rows_at_the_end_do_not_break_the_size_cap(spark, root):
    """The first thousands of rows are narrow; random texts hardly compress."""
    wide = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 256) for i in range(40)])
    source = spark.range(0, 20_000, 1, 16).select("id", F.when(F.col("id") > 10_000, wide).otherwise("").alias("text"))
    cap = 1 << 20
    unload(source, root, UnloadOptions(max_file_bytes=cap))
    sizes = [os.path.getsize(path) for path in data_files(root)]
    assert len(sizes) > 8 and max(sizes) <= cap


def test_directories_are_written_side_by_side(spark, root, monkeypatch):
    """A task sorts no directory; one with more of them than it keeps open still writes each row where it belongs."""
    open_at_once = []
    write = DataFrameWriter.parquet

    def noted(writer, *args, **named):
        open_at_once.append(int(writer._spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return write(writer, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    source = spark.range(0, 5_000, 1, 3).select("id", (F.col("id") % 61).alias("key"))
    layout = ModShards("key", 50)
    written = write_export(source.coalesce(1), root, layout, layout=LayoutOptions(shuffle=False))
    assert open_at_once[0] > 1
    back = read_export(spark, written)
    assert back.where("shard_index <> key % 50").count() == 0 and same(source, back.drop("shard_index"))
    assert len(data_files(root)) == 50


def test_error_mode_refuses_an_existing_target(orders, root):
    write_export(orders, root)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_export(orders, root, mode="errorifexists")


def test_day_directories_keep_their_zeros(spark, events, root):
    written = write_export(day_columns(events, "ts"), root, partition_by=DAY_COLUMNS)
    days = [r["day"] for r in read_export(spark, written).select("day").distinct().collect()]
    assert "01" in days and all(len(d) == 2 for d in days)


def test_shards_and_hive_columns_together(spark, events, root):
    layout = ModShards("event_id", 3)
    written = write_export(events, root, layout, partition_by=["event_type"], parquet=EXACT)
    assert same(layout.assign(events), read_export(spark, written))
    assert files(spark, written, layout).agg(F.sum("rows")).first()[0] == 1_000


# ------------------------------------------------------------------------- unload


@pytest.mark.parametrize("format, codec", [("parquet", None), ("csv", None), ("csv", "none"), ("json", "gzip")])
def test_unload_formats_round_trip(spark, orders, root, format, codec):
    written = unload(orders, root, UnloadOptions(format=format, compression=codec))
    assert same(orders, read_export(spark, written))
    assert files(spark, written).agg(F.sum("rows")).first()[0] == written.rows == 1_500


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_unload_content_checksum(spark, events, root, format):
    """Microseconds, doubles and texts of every format read back exactly."""
    instant = events.withColumn("instant", F.col("ts").cast("timestamp") + F.expr("INTERVAL '0.000123' SECOND"))
    written = unload(instant, root, UnloadOptions(format=format), checksum=True)
    checks = validate(spark, written, landed_files(spark, written), level="full")
    require_valid(checks)
    assert "content_checksum" in {r["check_name"] for r in checks.collect()}


@pytest.mark.parametrize("layout", [SingleShard(), ModShards("event_id", 4)])
@pytest.mark.parametrize("unit", ["ms", "s", None])
def test_export_content_checksum(spark, events, root, layout, unit):
    instant = events.withColumn("instant", F.col("ts").cast("timestamp") + F.expr("INTERVAL '0.000123' SECOND"))
    written = write_export(
        instant, root, layout, parquet=ParquetOptions(coerce_timestamps=unit), checksum=True, partition_by=["event_type"]
    )
    require_valid(validate(spark, written, landed_files(spark, written, layout), level="full"))


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
@pytest.mark.parametrize("header", [True, False])
def test_awkward_texts_survive(spark, root, format, header):
    texts = ['say "hi"', " padded ", "two\nlines", "a,b", "back\\slash", "", None, "tab\t", "'", "\\", '\\"', "ü"]
    df = small_table(spark, list(enumerate(texts)), "id int, text string")
    written = unload(df, root, UnloadOptions(format=format, header=header))
    back = [r["text"] for r in read_export(spark, written).orderBy("id").collect()]
    assert back == texts


def test_size_cap_splits_files(spark, orders, root):
    written = unload(orders.coalesce(1), root, UnloadOptions(max_file_bytes=32 * 1024))
    sizes = [r["bytes"] for r in files(spark, written).collect()]
    assert len(sizes) > 1 and max(sizes) <= 32 * 1024


def test_single_file_is_ordered(spark, orders, root):
    unload(orders.repartition(9), root, UnloadOptions(single=True, order_by=("o_totalprice",)))
    (only,) = data_files(root)
    prices = pq.read_table(only)["o_totalprice"].to_pylist()
    assert len(prices) == 1_500 and prices == sorted(prices)


def test_single_without_order(orders, root):
    unload(orders.repartition(9), root, UnloadOptions(single=True))
    assert len(data_files(root)) == 1


def test_single_above_the_cap_is_an_ordered_sequence(spark, root):
    wide = spark.range(0, 200_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    unload(wide, root, UnloadOptions(single=True, order_by=("text",), max_file_bytes=4 * 1024 * 1024))
    paths = data_files(root)
    spans = [pq.read_table(p, columns=["text"])["text"].to_pylist() for p in paths]
    assert len(paths) > 1 and sum(map(len, spans)) == 200_000
    flat = [t for span in spans for t in span]
    assert flat == sorted(flat)


# ------------------------------------------------------------- inventory and checks


def test_inventory_lists_empty_shards(spark, orders, root):
    layout = ModShards("o_orderkey", 4)
    written = write_export(orders.filter("o_orderkey % 4 <> 1"), root, layout)
    rows = {r["shard_index"]: r for r in landed_files(spark, written, layout, md5=True).collect()}
    assert rows[1]["uri"] == "" and rows[1]["rows"] == 0 and rows[1]["bytes"] == 0 and rows[1]["md5"] is None
    assert rows[0]["rows"] == 375 and rows[0]["elapsed_s"] >= 0 and not rows[0]["skipped"]


def test_md5_matches_the_bytes(spark, orders, root):
    import hashlib

    write_export(orders, root, ModShards("o_orderkey", 2))
    sums = {r["uri"].removeprefix("file:"): r["md5"] for r in file_md5(spark, root).collect() if "part-" in r["uri"]}
    for path in data_files(root):
        with open(path, "rb") as f:
            assert sums[path] == hashlib.md5(f.read()).hexdigest()


def test_validation_passes_and_names_failures(spark, orders, root):
    written = write_export(orders, root, ModShards("o_orderkey", 4))
    layout = ModShards("o_orderkey", 4)
    require_valid(validate(spark, written, landed_files(spark, written, layout), level="full"))
    os.remove(data_files(root)[0])
    with pytest.raises(ExportInvalid, match="row_total"):
        require_valid(validate(spark, written, landed_files(spark, written, layout)))


def test_validation_of_a_broken_footer(spark, orders, root):
    written = write_export(orders, root)
    with open(data_files(root)[0], "wb") as f:
        f.write(b"not parquet at all")
    checks = validate(spark, written, landed_files(spark, written))
    assert [(r["check_name"], r["ok"]) for r in checks.collect()] == [("readable", False)]


def test_full_validation_decodes_columns(spark, orders, root):
    """Damage inside a column chunk leaves the footer fine; the content check finds it, here
    also where the codec does not notice."""
    written = write_export(orders, root, parquet=ParquetOptions(compression="gzip"), checksum=True)
    target = data_files(root)[0]
    with open(target, "rb") as f:
        payload = bytearray(f.read())
    payload[200:600] = bytes(400)
    with open(target, "wb") as f:
        f.write(payload)
    crc = os.path.join(os.path.dirname(target), "." + os.path.basename(target) + ".crc")
    os.remove(crc)
    require_valid(validate(spark, written, landed_files(spark, written), level="footer"))
    with pytest.raises(ExportInvalid, match="values_decode"):
        require_valid(validate(spark, written, landed_files(spark, written)))
    with pytest.raises(ExportInvalid, match="readable|content_checksum"):
        require_valid(validate(spark, written, landed_files(spark, written), level="full"))


def test_fingerprint_sees_swaps_nulls_and_copies(spark):
    base = small_table(spark, [(1, None, "x"), (2, "x", None)], "id int, a string, b string")
    swapped = base.select("id", F.col("b").alias("a"), F.col("a").alias("b"))
    assert not reconcile(base, swapped, by=[]).first()["matches"]
    assert not reconcile(base, base.unionAll(base), by=[]).first()["matches"]
    assert reconcile(base, base.repartition(3), by=[]).first()["matches"]
    doubled, halved = base.unionAll(base), base.filter("id = 1")
    assert fingerprint(doubled).first()["rows"] == 4 and fingerprint(halved).first()["rows"] == 1


def test_fingerprint_takes_maps(spark):
    one = spark.sql("SELECT 1 AS id, map('a', 1, 'b', 2) AS m, array(map('k', 1)) AS n")
    two = spark.sql("SELECT 1 AS id, map('b', 2, 'a', 1) AS m, array(map('k', 1)) AS n")
    other = spark.sql("SELECT 1 AS id, map('b', 2, 'a', 9) AS m, array(map('k', 1)) AS n")
    assert reconcile(one, two, by=["id"]).first()["matches"]
    assert not reconcile(one, other, by=["id"]).first()["matches"]


def test_reconcile_lists_groups_missing_on_one_side(spark):
    left = small_table(spark, [(0, 1), (1, 2), (None, 3)], "shard_index int, v int")
    right = small_table(spark, [(0, 1), (2, 2), (None, 3)], "shard_index int, v int")
    rows = {r["shard_index"]: r for r in reconcile(left, right).collect()}
    assert rows[0]["matches"] and rows[None]["matches"]
    assert (rows[1]["source_rows"], rows[1]["target_rows"], rows[1]["matches"]) == (1, 0, False)
    assert (rows[2]["source_rows"], rows[2]["target_rows"], rows[2]["matches"]) == (0, 1, False)
