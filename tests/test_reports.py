import json
import math

import pytest
from pyspark.sql import functions as F

from landed import data_files
from exportkit import Catalog, LayoutOptions, StreamExport
from exportkit.functions import BatchTransform, redact
from exportkit.operators import ModShards, metrics, read_export, write_export
from exportkit.plans import latest_per_uri, manifest_location, publish, read_files, read_manifest
from exportkit.session import small_table, write_text_atomically

FIGURES = [(0, 1000, 2_000_000, 1.0), (1, 500, 1_000_000, 0.5)]
SCHEMA = "shard_index int, rows bigint, bytes bigint, elapsed_s double"


def shards(spark, rows):
    return small_table(spark, rows, SCHEMA)


def listing(spark):
    rows = [(i, f"file:/x/{i}.parquet", (i + 1) * 100, (i + 1) * 200, None, 1.0, False) for i in (2, 0, 1)]
    schema = "shard_index int, uri string, rows bigint, bytes bigint, md5 string, elapsed_s double, skipped boolean"
    return small_table(spark, rows, schema)


# ------------------------------------------------------------------------ metrics


def test_shard_figures(spark):
    rows = {r["shard_index"]: r for r in metrics.shard_metrics(shards(spark, FIGURES)).collect()}
    assert rows[0]["bytes_mb"] == pytest.approx(2_000_000 / 1048576)
    assert rows[0]["rows_s"] == 1000 and rows[1]["rows_s"] == 1000
    assert rows[1]["mb_s"] == pytest.approx(1_000_000 / 1048576 / 0.5)


def test_duration_floor(spark):
    row = metrics.shard_metrics(shards(spark, [(0, 5, 1048576, 0.0)])).first()
    assert (row["rows_s"], row["mb_s"]) == (5000.0, 1000.0)


def test_totals(spark):
    row = metrics.totals(shards(spark, FIGURES), 3.0).first()
    assert (row["shards"], row["total_rows"], row["total_bytes"]) == (2, 1500, 3_000_000)
    assert row["avg_rows_s"] == 500
    nothing = metrics.totals(shards(spark, []), 3.0).first()
    assert (nothing["shards"], nothing["total_rows"], nothing["total_bytes"], nothing["avg_mb_s"]) == (0, 0, 0, 0.0)


def by_speed(spark, *speeds):
    """Shards with the given MB/s over one second each."""
    rows = [(i, 10 * (i + 1), int(s * 1048576), 1.0) for i, s in enumerate(speeds)]
    return metrics.shard_metrics(shards(spark, rows))


def test_slow_shards(spark):
    flagged = metrics.slow_shards(by_speed(spark, 10, 10, 10, 1))
    assert [r["shard_index"] for r in flagged.filter("slow").collect()] == [3]


@pytest.mark.parametrize(
    "speeds, grade",
    [((100, 80), "A+"), ((100, 75), "A"), ((100, 55), "B"), ((100, 35), "C"), ((0, 0), "C"), ((7,), "A+")],
)
def test_grades(spark, speeds, grade):
    assert metrics.stability_grade(by_speed(spark, *speeds)).first()["grade"] == grade


def test_grade_without_shards_has_no_row(spark):
    assert metrics.stability_grade(by_speed(spark).filter("1 = 0")).count() == 0


def test_top_three_breaks_ties_by_shard(spark):
    rows = metrics.top_shards(by_speed(spark, 5, 9, 5, 1, 9)).collect()
    fastest = [(r["place"], r["shard_index"]) for r in rows if r["kind"] == "fastest"]
    slowest = [(r["place"], r["shard_index"]) for r in rows if r["kind"] == "slowest"]
    assert sorted(fastest) == [(1, 1), (2, 4), (3, 0)]
    assert sorted(slowest) == [(1, 3), (2, 0), (3, 2)]


def test_levels_match_the_arithmetic(spark):
    speeds = [3, 8, 8, 1, 4.5]
    rows = {r["shard_index"]: r for r in metrics.relative_levels(by_speed(spark, *speeds)).collect()}
    for i, s in enumerate(speeds):
        assert rows[i]["mb_s_level"] == math.floor((s - 1) / 7 * 7 + 1e-12)
        assert rows[i]["mb_s_share"] == pytest.approx(s / 8)
    flat = metrics.relative_levels(by_speed(spark, 2, 2)).collect()
    assert [r["mb_s_level"] for r in flat] == [0, 0]
    zero = metrics.relative_levels(by_speed(spark, 0, 0)).collect()
    assert [r["mb_s_share"] for r in zero] == [0.0, 0.0]


def test_files_are_summed_per_shard(spark):
    rows = [(0, 1, 10, 1.0), (0, 2, 20, 3.0), (1, 5, 50, 2.0)]
    found = {r["shard_index"]: tuple(r)[1:] for r in metrics.by_shard(shards(spark, rows)).collect()}
    assert found == {0: (3, 30, 3.0), 1: (5, 50, 2.0)}


# ----------------------------------------------------------------------- manifests


def test_manifest_totals_and_order(spark, root):
    document = publish(listing(spark), f"{root}/_manifest.json", extra={"a": 1})
    assert (document["total_rows"], document["total_bytes"]) == (600, 1200)
    assert document["extra"] == {"a": 1} and document["exported_at"].endswith("+00:00")
    with open(f"{root}/_manifest.json") as f:
        landed = json.load(f)
    assert [f["shard_index"] for f in landed.pop("files")] == [0, 1, 2]
    assert landed == document


def test_manifest_without_files(spark, root):
    document = publish(listing(spark).filter("1 = 0"), f"{root}/_manifest.json")
    assert (document["total_rows"], document["total_bytes"]) == (0, 0)
    with open(f"{root}/_manifest.json") as f:
        landed = json.load(f)
    assert landed["files"] == [] and "extra" not in landed


def test_foreign_manifest(spark, root):
    text = json.dumps(
        {
            "version": 1,
            "exported_at": "2026-05-08T12:34:56+00:00",
            "total_rows": 1,
            "total_bytes": 2,
            "files": [{"shard_index": 0, "remote_uri": "s3://b/k", "rows": 1, "bytes": 2, "md5": None, "skipped": False}],
            "unknown": {"ignored": True},
        }
    )
    write_text_atomically(spark, f"{root}/_manifest.json", text)
    row = read_manifest(spark, f"{root}/_manifest.json").first()
    assert row["remote_uri"] == "s3://b/k" and row["rows"] == 1
    assert str(row["exported_at"]).startswith("2026-05-08")


def test_newest_entry_per_file(spark):
    rows = [("u1", 1, "2024-01-01"), ("u1", 2, "2024-01-02"), ("u2", 3, "2024-01-01"), ("", 0, "2024-01-03")]
    df = small_table(spark, rows, "uri string, rows bigint, at string").select(
        "uri", "rows", F.col("at").cast("timestamp").alias("exported_at"), F.lit(False).alias("skipped")
    )
    assert {r["uri"]: r["rows"] for r in latest_per_uri(df).collect()} == {"u1": 2, "u2": 3}


def test_manifest_location():
    assert manifest_location("s3a://b/x/") == "s3a://b/x/_manifest.json"
    assert manifest_location("s3a://b/x", "s3a://b/m.json") == "s3a://b/m.json"
    assert manifest_location(None) is None


# ----------------------------------------------------------------------- streaming


def stream(events, root, **options):
    return StreamExport(
        name="s",
        source=f"{root}/in",
        schema=events.schema,
        base=f"{root}/out",
        catalog=f"{root}/catalog",
        checkpoint=f"{root}/checkpoint",
        **options,
    )


def test_stream_takes_only_new_files(spark, events, root):
    export = stream(events, root, shards=ModShards("event_id", 3))
    events.filter("event_id < 300").write.parquet(export.source)
    first = export.run(spark)
    assert export.run(spark) == []
    events.filter("event_id >= 300").write.mode("append").parquet(export.source)
    second = export.run(spark)
    assert len(first) == len(second) == 1 and first != second
    current = Catalog(spark, export.catalog).latest_files()
    assert current.agg(F.sum("rows")).first()[0] == 1_000
    assert len(data_files(export.base)) == 6


def test_stream_in_several_batches_with_a_transform(spark, events, root):
    export = stream(events, root, max_files=1, transforms=[lambda df: redact(df, "props")])
    events.repartition(3).write.parquet(export.source)
    batches = export.run(spark)
    assert len(batches) == 3
    catalog = Catalog(spark, export.catalog)
    ids = []
    for b in batches:
        rows = read_files(catalog.run_files("s", f"batch-{b}"), f"{export.base}/batch={b}", events.schema)
        ids += [r["event_id"] for r in rows.filter("props = '<redacted>'").select("event_id").collect()]
    assert sorted(ids) == list(range(1_000))


def test_stream_with_a_batch_transform(spark, events, root):
    names = list(events.columns)

    def slim(batch):
        assert batch.column_names == names
        return batch.select(["event_id", "value"])

    export = stream(events, root, shards=ModShards("user_id", 2), transforms=[BatchTransform(slim)])
    events.write.parquet(export.source)
    export.run(spark)
    back = spark.read.parquet(f"{root}/out/batch=0")
    assert back.columns == ["event_id", "value", "shard_index"] and back.count() == 1_000


def test_hot_shard_of_a_stream_is_split_too(spark, root):
    """Streams switch adaptive execution off; the sink has to switch it on again."""
    rows = spark.range(0, 200_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.write.parquet(f"{root}/in")
    export = stream(rows, root, shards=ModShards("id", 1), layout=LayoutOptions(target_file_bytes=1024 * 1024))
    export.run(spark)
    assert len(data_files(f"{root}/out/batch=0/shard_index=0")) > 3
    assert spark.read.parquet(f"{root}/out").count() == 200_000


def test_replayed_batch_replaces_its_first_attempt(spark, events, root):
    export = stream(events, root)
    export._batch(events.filter("event_id < 10"), 0)
    export._batch(events, 0)
    current = Catalog(spark, export.catalog).latest_files()
    assert current.agg(F.sum("rows")).first()[0] == 1_000
    assert spark.read.parquet(export.base).count() == 1_000


# ------------------------------------------------------------------------ read-back


def test_partition_pruning_on_read_back(spark, orders, root):
    written = write_export(orders, root, ModShards("o_orderkey", 4))
    plan = read_export(spark, written).filter("shard_index = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(shard_index" in plan
