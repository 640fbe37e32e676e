import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from landed import data_files
from exportkit.operators import (
    CrossShards,
    ModShards,
    PredicateShards,
    RangeShards,
    SingleShard,
    ValueShards,
    coverage,
    files,
    read_export,
    write_export,
)
from exportkit.operators.shards import hive_value, sql_literal
from exportkit.options import LayoutOptions
from exportkit.session import small_table

SEEDS = (1, 7, 42)


def random_keys(seed, count=400):
    """Positive, negative, zero and NULL keys with many repeats; one key holds a third."""
    rng = random.Random(seed)
    keys = [5] * (count // 3)
    keys += [rng.choice([None, 0, -1, -7, rng.randint(-10**12, 10**12), rng.randint(-30, 30)]) for _ in range(count)]
    rng.shuffle(keys)
    return keys


@pytest.fixture(params=SEEDS)
def keys(request, spark):
    values = random_keys(request.param)
    return values, small_table(spark, [(i, k) for i, k in enumerate(values)], "id bigint, key bigint")


def counted(df, column="shard_index"):
    return {r[column]: r["count"] for r in df.groupBy(column).count().collect()}


def test_modulo_keeps_every_row(keys):
    values, df = keys
    expected = Counter(0 if k is None else k % 8 for k in values)
    assert counted(ModShards("key", 8).assign(df)) == dict(expected)


def test_modulo_sql_text_agrees_with_the_layout(keys):
    values, df = keys
    layout = ModShards("key", 5)
    by_text = counted(PredicateShards(layout.sql_predicates()).assign(df))
    assert by_text == counted(layout.assign(df))
    assert [r.asDict() for r in coverage(df, layout).collect()] == [{"hits": 1, "rows": len(values)}]


def test_ranges_match_brute_force(keys):
    values, df = keys
    layout = RangeShards("key", [(-10, 0), (0, 5), (5, 6), (6, None)])

    def place(k):
        if k is None or k < -10:
            return None
        return 0 if k < 0 else 1 if k < 5 else 2 if k < 6 else 3

    expected = Counter(place(k) for k in values)
    outside = expected.pop(None, 0)
    assert counted(layout.assign(df)) == dict(expected)
    hits = {r["hits"]: r["rows"] for r in coverage(df, layout).collect()}
    assert hits == {0: outside, 1: sum(expected.values())}
    assert counted(layout.assign(df, only=[1, 3])) == {i: expected[i] for i in (1, 3) if expected[i]}


def test_closed_last_range(spark):
    df = small_table(spark, [(k,) for k in (0, 9, 10, 11, None)], "key bigint")
    assert counted(RangeShards("key", [(0, 5), (5, 10)]).assign(df)) == {0: 1, 1: 1}


@pytest.mark.parametrize(
    "ranges, message",
    [
        ([], "must not be empty"),
        ([(0, 5), (6, None)], "gap"),
        ([(0, 5), (4, None)], "overlap"),
        ([(0, None), (5, 9)], "only the last"),
        ([(5, 5)], "is empty"),
        ([(None, 5)], "no lower bound"),
    ],
)
def test_bad_ranges(ranges, message):
    with pytest.raises(ValueError, match=message):
        RangeShards("key", ranges)


@pytest.mark.parametrize("values", [[], ["a", "a"], ["a", None], ["a", ""]])
def test_bad_values(values):
    with pytest.raises(ValueError, match="distinct"):
        ValueShards("c", values)
    with pytest.raises(ValueError, match="distinct"):
        CrossShards({"c": values})


def test_overlapping_conditions_repeat_rows_as_separate_queries_would(keys):
    _, df = keys
    conditions = ["key > 0", "key > 10", "key IS NULL", "key = 5"]
    separate = {i: n for i, c in enumerate(conditions) if (n := df.filter(c).count())}
    assert counted(PredicateShards(conditions).assign(df)) == separate
    part = {i: n for i, n in separate.items() if i in (0, 3)}
    assert counted(PredicateShards(conditions).assign(df, only=[0, 3])) == part


def test_cross_shards_number_and_directories(spark, root):
    rows = [(i, c, y) for i, (c, y) in enumerate([("US", 2025), ("US", 2026), ("DE", 2026), ("FR", 2025)] * 3)]
    df = small_table(spark, rows, "id int, country string, year int")
    layout = CrossShards({"country": ["US", "DE"], "year": [2025, 2026]})
    written = write_export(df, root, layout)
    listing = {r["shard_index"]: r["uri"] for r in files(spark, written, layout).collect()}
    assert sorted(listing) == [0, 1, 3]
    for shard, uri in listing.items():
        assert layout.directory(shard) in uri
    assert read_export(spark, written).filter("country = 'US'").count() == 6


def test_awkward_partition_values_come_back(spark, root):
    values = ["a b", "50%", "x/y", "q=1", "it's", "ü", "#1", "a:b", "[z]"]
    df = small_table(spark, [(i, v) for i, v in enumerate(values * 2)], "id int, region string")
    layout = ValueShards("region", values)
    written = write_export(df, root, layout)
    assert sorted(r["region"] for r in read_export(spark, written).collect()) == sorted(values * 2)
    import os

    for shard in range(layout.count):
        assert os.path.isdir(os.path.join(root, layout.directory(shard)))


def test_a_hot_shard_is_split_over_tasks_and_a_small_one_is_one_file(spark, root):
    """Shard 0 holds nearly everything; it is written by several tasks in parallel."""
    df = spark.range(0, 400_000, 1, 16).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.when(F.col("id") % 50 == 0, 1).otherwise(0).alias("k")
    )
    layout = ValueShards("k", [0, 1])
    written = write_export(df, root, layout, layout=LayoutOptions(target_file_bytes=2 * 1024 * 1024))
    listing = files(spark, written, layout).groupBy("shard_index").agg(F.count("*").alias("n"), F.sum("rows").alias("rows"))
    found = {r["shard_index"]: (r["n"], r["rows"]) for r in listing.collect()}
    assert found[0][0] > 3 and found[0][1] == 392_000
    assert found[1] == (1, 8_000)


def test_small_shards_are_one_file_each(orders, root, spark):
    written = write_export(orders.repartition(16), root, ModShards("o_orderkey", 4))
    assert len(data_files(root)) == 4
    assert read_export(spark, written).count() == orders.count()


def test_single_shard_writes_to_the_path_itself(orders, root, spark):
    write_export(orders, root, SingleShard())
    assert all("shard_index" not in f for f in data_files(root))


def test_source_split_by_shard_needs_no_shuffle(orders, root, spark):
    layout = ModShards("o_orderkey", 4)
    by_shard = [layout.assign(orders, only=[i]).drop("shard_index") for i in range(4)]
    union = by_shard[0].unionAll(by_shard[1]).unionAll(by_shard[2]).unionAll(by_shard[3])
    write_export(union, root, layout, layout=LayoutOptions(shuffle=False))
    assert len(data_files(root)) == 4


def test_literals_and_directory_escapes():
    assert [sql_literal(v) for v in (1, "a'b", None, True, 2.5)] == ["1", "'a''b'", "NULL", "TRUE", "2.5"]
    assert hive_value("a/b=c") == "a%2Fb%3Dc"
    assert hive_value(True) == "true"
