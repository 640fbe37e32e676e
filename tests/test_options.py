from dataclasses import replace

import pytest

from exportkit import JdbcSource, LayoutOptions, ParquetOptions, SqlSource, UnloadOptions
from exportkit.operators import ModShards, checked_path, coverage, equal_depth_shards
from exportkit.sources import jdbc


def test_parquet_defaults():
    options = ParquetOptions()
    assert options.compression == "zstd"
    assert options.row_group_rows == 512_000
    assert options.coerce_timestamps == "ms"
    assert options.writer_options() == {
        "compression": "zstd",
        "parquet.block.row.count.limit": "512000",
        "parquet.column.statistics.enabled": "true",
        "parquet.enable.dictionary": "true",
    }


@pytest.mark.parametrize(
    "build",
    [
        lambda: ParquetOptions(compression="rar"),
        lambda: ParquetOptions(row_group_rows=0),
        lambda: ParquetOptions(coerce_timestamps="ns"),
        lambda: LayoutOptions(target_file_bytes=0),
        lambda: LayoutOptions(max_records_per_file=-1),
        lambda: UnloadOptions(format="xml"),
        lambda: UnloadOptions(max_file_bytes=0),
        lambda: SqlSource(),
        lambda: SqlSource(query="SELECT 1", template="SELECT 1"),
        lambda: JdbcSource(url="jdbc:x"),
        lambda: JdbcSource(url="jdbc:x", table="t", query="SELECT 1"),
        lambda: JdbcSource(url="jdbc:x", table="t", column="id"),
        lambda: JdbcSource(url="jdbc:x", table="t", column="id", lower=0, upper=9, partitions=2, predicates=["1=1"]),
        lambda: JdbcSource(url="jdbc:x", table="t", fetch_rows=0),
    ],
)
def test_bad_options(build):
    with pytest.raises(ValueError):
        build()


def test_options_are_frozen():
    with pytest.raises(AttributeError):
        ParquetOptions().compression = "gzip"


def test_jdbc_properties_and_relation():
    source = JdbcSource(url="jdbc:x", query="SELECT 1 AS a", properties={"user": "u", "fetchsize": "1"})
    assert source.relation == "(SELECT 1 AS a) src"
    assert source.connection_properties() == {"pushDownPredicate": "true", "user": "u", "fetchsize": "50000"}


class Recorder:
    """Stands in for a session and takes down what ``read.jdbc`` is given."""

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        return url, table, options


def test_jdbc_reads_one_task_per_predicate():
    layout = ModShards("id", 3)
    source = JdbcSource(url="jdbc:x", table="t", predicates=layout.sql_predicates(), fetch_rows=7)
    url, table, options = source.load(Recorder())
    assert (url, table) == ("jdbc:x", "t")
    assert options["predicates"] == layout.sql_predicates() and len(options["predicates"]) == 3
    assert options["properties"]["fetchsize"] == "7"


def test_jdbc_reads_a_column_range():
    source = JdbcSource(url="jdbc:x", table="t", column="id", lower=0, upper=90, partitions=9)
    options = source.load(Recorder())[2]
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", 0, 90, 9)


def test_jdbc_plain_read():
    source = JdbcSource(url="jdbc:x", query="SELECT 1 AS a")
    with pytest.raises(ValueError, match="one_task"):
        source.load(Recorder())
    assert replace(source, one_task=True).load(Recorder())[1] == "(SELECT 1 AS a) src"


def test_jdbc_query_with_a_window():
    source = JdbcSource(url="jdbc:x", query="SELECT * FROM t WHERE at > :watermark_prev AND at <= :watermark_now", one_task=True)
    assert source.windowed and not JdbcSource(url="jdbc:x", table="t").windowed
    relation = source.load(Recorder(), {"watermark_prev": "a'b", "watermark_now": "c"})[1]
    assert relation == "(SELECT * FROM t WHERE at > 'a''b' AND at <= 'c') src"
    with pytest.raises(ValueError, match="watermark_prev"):
        source.load(Recorder())


def test_jdbc_takes_equal_depth_ranges(spark):
    """Quoted names, doubled quotes, and every value in one range."""
    rows = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 3 WHEN id = 999 THEN NULL ELSE id END AS `a``b`", "id AS other")
    layout = equal_depth_shards(rows, "a`b", 5, then="other", quote='"')
    texts = layout.sql_predicates()
    assert all('"a`b"' in text for text in texts) and any('"other"' in text for text in texts)
    source = JdbcSource(url="jdbc:x", table="t", predicates=texts)
    assert source.load(Recorder())[2]["predicates"] == texts
    back = equal_depth_shards(rows.withColumnRenamed("a`b", "ab"), "ab", 5, then="other")
    sizes = [r["count"] for r in back.assign(rows.withColumnRenamed("a`b", "ab")).groupBy("shard_index").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 2 * 1000 / 5


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_equal_depth_without_or_with_few_values(spark, parts):
    for expression in ("NULL", "5", "id % 2", "-id", "CAST(id AS DOUBLE) / 7", "CASE WHEN id > 3 THEN id END"):
        rows = spark.range(300).selectExpr(f"CAST({expression} AS DOUBLE) AS k", "id")
        layout = equal_depth_shards(rows, "k", parts)
        assert coverage(rows, layout).collect()[0].asDict() == {"hits": 1, "rows": 300}
        assert coverage(rows, layout).count() == 1
    assert equal_depth_shards(rows.limit(0), "k", parts).count == 1
    with pytest.raises(ValueError):
        equal_depth_shards(rows, "k", 0)


def test_jdbc_bounds_are_asked_of_the_database(monkeypatch):
    monkeypatch.setattr(jdbc, "first_text", lambda asked: asked[1])
    source = JdbcSource(url="jdbc:x", table="t")
    assert source.upper_bound(Recorder(), "at") == "(SELECT MAX(at) AS bound_value FROM t) bound"
    asked = source.scalar(Recorder(), "SELECT MAX(at) FROM t WHERE at > :watermark_prev", {"watermark_prev": "x"})
    assert asked == "(SELECT MAX(at) FROM t WHERE at > 'x') bound"


@pytest.mark.parametrize("relative", ["/abs/x", "../up", "a/../b", "a/.."])
def test_paths_cannot_leave_the_base(relative):
    with pytest.raises(ValueError):
        checked_path("file:/data", relative)


def test_paths_are_joined():
    assert checked_path("file:/data/", "a/b/") == "file:/data/a/b"


def test_codecs_per_format():
    assert UnloadOptions().codec == "zstd"
    assert UnloadOptions(format="csv").codec == "gzip"
    assert UnloadOptions(format="json", compression="none").codec == "uncompressed"
