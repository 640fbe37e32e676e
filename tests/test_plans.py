"""What Spark makes of the operators: pushed filters, pruned columns, no task that sees all."""

import re

import pytest
from pyspark.sql import functions as F

from landed import SMALL
from exportkit.operators import (
    Bounds,
    CrossShards,
    RangeShards,
    ValueShards,
    day_slice,
    file_facts,
    footers,
    latest_per_key,
    listed,
    metrics,
    read_export,
    window,
    with_facts,
    write_export,
)
from exportkit.operators.cut import cut_again
from exportkit.operators.fingerprint import fingerprint
from exportkit.operators.shards import PredicateShards
from exportkit.queries import ORACLE, QUERIES


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pushed(df):
    (line,) = [part for part in physical(df).split("PushedFilters: ")[1:]][:1]
    return line.split("], ReadSchema")[0]


def test_window_bounds_reach_the_scan(events):
    filters = pushed(window(events, "ts", Bounds("2024-01-10 00:00:00", "2024-01-12 00:00:00", "timestamp_ntz")))
    assert "GreaterThan(ts,2024-01-10T00:00)" in filters and "LessThanOrEqual(ts,2024-01-12T00:00)" in filters


def test_lateness_is_folded_into_the_bound(events):
    bounds = Bounds("2024-01-10 00:00:00", "2024-01-12 00:00:00", "timestamp_ntz")
    assert "GreaterThan(ts,2024-01-09T18:00)" in pushed(window(events, "ts", bounds, "6 hours"))


def test_day_slice_reaches_the_scan(events):
    filters = pushed(day_slice(events, "ts", "2024-01-05"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in filters and "LessThan(ts,2024-01-06T00:00)" in filters


def test_shard_lists_and_ranges_reach_the_scan(orders, events):
    assert "In(o_orderstatus, [F,P])" in pushed(ValueShards("o_orderstatus", ["F", "P"]).assign(orders))
    layout = CrossShards({"event_type": ["click", "view"], "user_id": [1, 2]})
    filters = pushed(layout.assign(events))
    assert "In(event_type, [click,view])" in filters and "In(user_id, [1,2])" in filters
    ranges = RangeShards("o_orderkey", [(0, 100), (100, 500), (500, None)])
    assert "LessThan(o_orderkey,500)" in pushed(ranges.assign(orders, only=[1]))


def test_wanted_conditions_and_combinations_reach_the_scan(events):
    layout = PredicateShards(["event_id > 5", "value > 1", "user_id = 3"])
    filters = pushed(layout.assign(events, only=[0, 1]))
    assert "Or(GreaterThan(event_id,5),GreaterThan(value,1.0))" in filters and "user_id" not in filters
    assert layout.assign(events, only=[]).count() == 0
    cross = CrossShards({"event_type": ["click", "view"], "user_id": [1, 2]})
    filters = pushed(cross.assign(events, only=[0, 1]))
    assert "view" not in filters and "In(user_id, [1,2])" in filters


def test_shards_are_cut_in_one_pass_without_a_join(events):
    layout = CrossShards({"event_type": ["click", "view"], "user_id": [1, 2]})
    for df in (layout.assign(events), PredicateShards(["event_id > 5", "value > 1"]).assign(events)):
        plan = physical(df)
        assert "Join" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1


def test_latest_per_key_thins_out_before_the_shuffle(events):
    plan = physical(latest_per_key(events, ["user_id"], ["ts", "event_id"]))
    final, exchange, partial = plan.index("Final"), plan.index("Exchange"), plan.index("Partial")
    assert "WindowGroupLimit" in plan and final < exchange < partial


def test_fingerprint_aggregates_before_the_shuffle(orders):
    plan = physical(fingerprint(orders, ["o_orderstatus"]))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_metrics_never_gather_all_shards_in_one_window(spark):
    shards = spark.range(1_000).selectExpr("CAST(id AS INT) AS shard_index", "id AS rows", "id AS bytes", "1D AS elapsed_s")
    figures = metrics.shard_metrics(shards)
    for df in (metrics.slow_shards(figures), metrics.relative_levels(figures)):
        assert "Window" not in physical(df) and "CartesianProduct" not in physical(df)
    assert "TakeOrderedAndProject" in physical(metrics.top_shards(figures))


def test_inventory_reads_no_column(spark, orders, root):
    from exportkit.operators import files, write_export

    plan = physical(files(spark, write_export(orders, root)))
    assert "ReadSchema: struct<>" in plan


def test_transforms_stay_in_one_codegen_stage(spark):
    from exportkit.functions import clamp, full_hash, redact, short_hash

    customers = spark.read.parquet(f"{SMALL}/customer.parquet")
    df = clamp(full_hash(short_hash(redact(customers, "c_mktsegment"), "c_name"), "c_mktsegment"), "c_acctbal")
    plan = physical(df)
    assert "Python" not in plan and plan.count("Project") == 1
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double>" in plan


def test_every_query_but_checksums_has_sql():
    assert set(QUERIES) - set(ORACLE) == {"file_md5"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query_matches_its_sql(spark, name):
    import duckdb

    from check_queries import compare

    got = QUERIES[name](spark, SMALL).toArrow()
    assert got.num_columns
    if name in ORACLE:
        db = duckdb.connect()
        for table in ("region nation customer supplier part orders lineitem events documents embeddings conversations").split():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
        assert compare(got, db.execute(ORACLE[name]).to_arrow_table()) == ""


def test_smoke_entry(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).agg(F.count("*"), F.sum("rows")).first()
    assert tuple(rows) == (4, 1_500)


def test_facts_of_files_go_to_the_rows(spark, orders, root):
    """Dealt out by file, all rows of a file would be sorted in one task."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        written = write_export(orders, root)
        plan = physical(with_facts(read_export(spark, written), file_facts(footers(spark, written.path))))
    finally:
        spark.conf.set(threshold, before)
    rows = plan[plan.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
    assert "o_orderkey" in rows and "Exchange" not in rows and "Sort" not in rows


def test_sums_of_chunks_go_to_the_rows_of_a_cut(spark, orders, root):
    """Not the rows to the sums over files, which one task has."""
    written = write_export(orders, root)
    plan = physical(cut_again(read_export(spark, written), listed(spark, written.path), 10_000.0))
    assert re.search(r"BroadcastHashJoin \[_cut_file#\d+, _cut_block#\d+L, _cut_chunk#\d+L\][^\n]*BuildRight", plan)
