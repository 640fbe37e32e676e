"""Registered queries: sinks and unloads, read back from the files they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (
    ModShards,
    file_facts,
    file_place,
    files,
    footers,
    landed_files,
    listed,
    read_export,
    unload,
    with_facts,
    write_export,
)
from ..options import LayoutOptions, ParquetOptions, UnloadOptions
from ..session import scratch_dir
from .tables import table

EXACT = ParquetOptions(coerce_timestamps=None)
FACTS = ("row_groups", "largest_group", "codecs", "with_statistics", "with_dictionary")


def _roundtrip(spark, sf_dir, name, label, **options):
    written = write_export(table(spark, sf_dir, name), scratch_dir(spark, label), **options)
    return read_export(spark, written)


def sink_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "orders", "sink_roundtrip", parquet=EXACT)


def sink_roundtrip_lineitem(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "lineitem", "sink_roundtrip_lineitem", parquet=EXACT)


def sink_roundtrip_documents(spark, sf_dir):
    """Whole texts through the sink and back."""
    return _roundtrip(spark, sf_dir, "documents", "sink_roundtrip_documents")


def sink_roundtrip_conversations(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "conversations", "sink_roundtrip_conversations")


def _with_facts(spark, written):
    """The rows that were written, each with what the footer of its file says."""
    return with_facts(read_export(spark, written), file_facts(footers(spark, written.path)))


def sink_codecs(spark, sf_dir):
    """Every codec gives back the same rows, and it is the one that the footers name."""
    result = None
    for codec in ("zstd", "snappy", "gzip", "lz4", "none"):
        path = scratch_dir(spark, f"sink_codec_{codec}")
        parquet = ParquetOptions(compression=codec, coerce_timestamps=None)
        written = write_export(table(spark, sf_dir, "orders"), path, parquet=parquet)
        part = _with_facts(spark, written)
        part = part.withColumns({"codec": F.lit(codec), "stored": F.array_join("codecs", "+")}).drop(*FACTS)
        result = part if result is None else result.unionAll(part)
    return result


def sink_row_groups(spark, sf_dir):
    """Whole rows; how many rows the largest row group of their file has, and whether all are as full."""
    small = ParquetOptions(row_group_rows=1_000, coerce_timestamps=None)
    written = write_export(table(spark, sf_dir, "orders").coalesce(1), scratch_dir(spark, "sink_row_groups"), parquet=small)
    return _with_facts(spark, written).drop("codecs", "with_statistics", "with_dictionary")


def _by_flag(spark, sf_dir, flag):
    result = None
    for on in (True, False):
        parquet = ParquetOptions(coerce_timestamps=None, **{flag: on})
        written = write_export(table(spark, sf_dir, "lineitem"), scratch_dir(spark, f"sink_{flag}_{on}"), parquet=parquet)
        part = _with_facts(spark, written).withColumns({"asked": F.lit(on), "found": F.array_join(f"with_{flag}", ",")})
        part = part.drop(*FACTS)
        result = part if result is None else result.unionAll(part)
    return result


def sink_statistics(spark, sf_dir):
    """Whole rows; the columns that have statistics in every row group of their file, switched on and off."""
    return _by_flag(spark, sf_dir, "statistics")


def sink_dictionary(spark, sf_dir):
    """Whole rows; whether the flags of a line, which have few values, are stored by a dictionary."""
    found = _by_flag(spark, sf_dir, "dictionary")
    stored = F.split("found", ",")
    flags = F.array_contains(stored, "l_returnflag") & F.array_contains(stored, "l_linestatus")
    return found.withColumn("found", flags)


def sink_max_records(spark, sf_dir):
    """A row limit per file on top of shards: counts survive the splitting."""
    layout = ModShards("o_orderkey", 3)
    written = write_export(
        table(spark, sf_dir, "orders"),
        scratch_dir(spark, "sink_max_records"),
        layout,
        layout=LayoutOptions(max_records_per_file=1_000),
    )
    listing = files(spark, written, layout)
    return listing.groupBy("shard_index").agg(F.sum("rows").alias("rows"), (F.max("rows") <= 1_000).alias("within_limit"))


def sink_overwrite(spark, sf_dir):
    """A second full write replaces the first; a partial one replaces only its shards."""
    orders = table(spark, sf_dir, "orders")
    path, layout = scratch_dir(spark, "sink_overwrite"), ModShards("o_orderkey", 4)
    write_export(orders, path, layout, parquet=EXACT)
    write_export(orders.filter("o_totalprice > 50000"), path, layout, parquet=EXACT)
    doubled = orders.filter("o_totalprice > 50000").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    written = write_export(doubled, path, layout, only=[1, 3], parquet=EXACT, keep_other_partitions=True)
    return read_export(spark, written)


def sink_empty(spark, sf_dir):
    """A shard without rows writes no file and is still listed."""
    layout = ModShards("o_orderkey", 4)
    orders = table(spark, sf_dir, "orders").filter("o_orderkey % 4 <> 2")
    written = write_export(orders, scratch_dir(spark, "sink_empty"), layout)
    return (
        landed_files(spark, written, layout)
        .groupBy("shard_index")
        .agg(F.sum("rows").alias("rows"), F.bool_and(F.col("uri") == "").alias("no_file"))
    )


def sink_nothing(spark, sf_dir):
    """An export without any row reads back as no rows with the full schema."""
    orders = table(spark, sf_dir, "orders").filter("o_orderkey < 0")
    layout = ModShards("o_orderkey", 4)
    return read_export(spark, write_export(orders, scratch_dir(spark, "sink_nothing"), layout, parquet=EXACT))


def _unloaded(spark, sf_dir, name, label, **options):
    return read_export(spark, unload(table(spark, sf_dir, name), scratch_dir(spark, label), UnloadOptions(**options)))


def unload_parquet(spark, sf_dir):
    return _unloaded(spark, sf_dir, "orders", "unload_parquet")


def unload_csv(spark, sf_dir):
    return _unloaded(spark, sf_dir, "orders", "unload_csv", format="csv", compression="gzip")


def unload_csv_conversations(spark, sf_dir):
    """Texts with quotes, commas and line breaks survive the CSV quoting."""
    return _unloaded(spark, sf_dir, "conversations", "unload_csv_text", format="csv", header=False)


def unload_csv_documents(spark, sf_dir):
    return _unloaded(spark, sf_dir, "documents", "unload_csv_documents", format="csv")


def unload_json_documents(spark, sf_dir):
    return _unloaded(spark, sf_dir, "documents", "unload_json_documents", format="json")


def unload_json(spark, sf_dir):
    return _unloaded(spark, sf_dir, "orders", "unload_json", format="json", compression="none")


def _within_cap(spark, written, cap):
    """The rows read back, each with whether its file is within the cap, and whether there are several."""
    sizes = listed(spark, written.path)
    some = sizes.agg(F.count(F.lit(1)) > 1).scalar()
    fits = sizes.select("uri", (F.col("bytes") <= cap).alias("within_cap"))
    rows = read_export(spark, written).withColumn("uri", F.col("_metadata.file_path"))
    return rows.join(F.broadcast(fits), "uri").drop("uri").withColumn("several", some)


def unload_max_records(spark, sf_dir):
    """Far more rows than the cap of a file takes."""
    options = UnloadOptions(max_file_bytes=24 * 1024)
    written = unload(table(spark, sf_dir, "orders"), scratch_dir(spark, "unload_max_records"), options)
    return _within_cap(spark, written, options.max_file_bytes)


def unload_capped_text(spark, sf_dir):
    """Documents of very different lengths as uncompressed JSON, no file above the cap."""
    options = UnloadOptions(format="json", compression="none", max_file_bytes=96 * 1024)
    written = unload(table(spark, sf_dir, "documents"), scratch_dir(spark, "unload_capped_text"), options)
    return _within_cap(spark, written, options.max_file_bytes)


def unload_capped_order(spark, sf_dir):
    """Ordered and capped: rows per file, whether it is within the cap, and where it stands in the order."""
    orders = table(spark, sf_dir, "orders").repartition(8)
    options = UnloadOptions(single=True, order_by=("o_totalprice", "o_orderkey"), max_file_bytes=24 * 1024)
    written = unload(orders, scratch_dir(spark, "unload_capped_order"), options)
    name = F.col("_metadata.file_name")
    rows = read_export(spark, written).withColumns({"place": file_place(name), "uri": F.col("_metadata.file_path")})
    spans = rows.groupBy("place", "uri").agg(F.max(F.struct("o_totalprice", "o_orderkey")).alias("last"))
    fits = listed(spark, written.path).select("uri", (F.col("bytes") <= options.max_file_bytes).alias("within_cap"))
    before = spans.select((F.col("place") + 1_000_000).alias("place"), F.col("last").alias("before"))
    spans = spans.join(fits, "uri").join(before, "place", "left").select("uri", "within_cap", "before")
    later = F.coalesce(F.struct("o_totalprice", "o_orderkey") > F.col("before"), F.lit(True))
    return rows.join(F.broadcast(spans), "uri").withColumn("in_order", later).drop("uri", "place", "before")


def unload_single(spark, sf_dir):
    """Ordered, and one file while the result is below the size cap."""
    orders = table(spark, sf_dir, "orders")
    options = UnloadOptions(single=True, order_by=("o_totalprice", "o_orderkey"))
    written = unload(orders, scratch_dir(spark, "unload_single"), options)
    return files(spark, written).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


def unload_ordered(spark, sf_dir):
    """Above the cap: several files; each starts where the file before it ends, or later."""
    orders = table(spark, sf_dir, "orders").repartition(8)
    options = UnloadOptions(order_by=("o_totalprice", "o_orderkey"), max_file_bytes=64 * 1024)
    written = unload(orders, scratch_dir(spark, "unload_ordered"), options)
    place = file_place(F.col("_metadata.file_name"))
    spans = (
        read_export(spark, written)
        .groupBy(place.alias("place"))
        .agg(F.count("*").alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    )
    following = spans.select((F.col("place") - 1_000_000).alias("place"), F.col("low").alias("next_low"))
    crossing = spans.join(following, "place").filter("next_low < high")
    return spans.agg(F.sum("n").alias("rows"), (F.count("*") > 1).alias("several")).withColumn(
        "out_of_order", crossing.agg(F.count("*")).scalar()
    )


def shard_hot(spark, sf_dir):
    """Nine in ten rows in one shard, all from one task: its rows lie in several files, none of which
    holds more than a third of it; the other shards have one file each."""
    orders = table(spark, sf_dir, "orders").coalesce(1)
    skewed = orders.withColumn("half", F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderkey") % 3 + 1).otherwise(F.lit(0)))
    total = orders.count()
    layout = LayoutOptions(hot_rows=max(1, total // 20), target_file_bytes=total)
    written = write_export(skewed, scratch_dir(spark, "shard_hot"), ModShards("half", 4), layout=layout, parquet=EXACT)
    listing = files(spark, written, ModShards("half", 4))
    shares = listing.groupBy("shard_index").agg((F.max("rows") / F.sum("rows")).alias("share"), F.count("*").alias("files"))
    split = shares.select("shard_index", (F.col("share") <= 1 / 3).alias("split"), (F.col("files") == 1).alias("one_file"))
    return read_export(spark, written).join(split, "shard_index")


QUERIES = {
    f.__name__: f
    for f in (
        sink_roundtrip,
        sink_roundtrip_lineitem,
        sink_roundtrip_documents,
        sink_roundtrip_conversations,
        sink_codecs,
        sink_row_groups,
        sink_statistics,
        sink_dictionary,
        shard_hot,
        sink_max_records,
        sink_overwrite,
        sink_empty,
        sink_nothing,
        unload_parquet,
        unload_csv,
        unload_csv_conversations,
        unload_csv_documents,
        unload_json,
        unload_json_documents,
        unload_max_records,
        unload_capped_text,
        unload_capped_order,
        unload_single,
        unload_ordered,
    )
}

ORACLE = {
    "sink_roundtrip": "SELECT * FROM orders",
    "sink_roundtrip_lineitem": "SELECT * FROM lineitem",
    "sink_roundtrip_documents": "SELECT * FROM documents",
    "sink_roundtrip_conversations": "SELECT * FROM conversations",
    "sink_codecs": """
        SELECT orders.*, codec, stored
        FROM orders, (VALUES ('zstd', 'ZSTD'), ('snappy', 'SNAPPY'), ('gzip', 'GZIP'), ('lz4', 'LZ4'), ('none', 'UNCOMPRESSED'))
                     AS c(codec, stored)
    """,
    "sink_row_groups": """
        SELECT *, CAST((SELECT (COUNT(*) + 999) // 1000 FROM orders) AS INTEGER) AS row_groups,
               CAST((SELECT least(COUNT(*), 1000) FROM orders) AS BIGINT) AS largest_group
        FROM orders
    """,
    "sink_statistics": """
        SELECT lineitem.*, asked, found
        FROM lineitem, (VALUES
          (TRUE, 'l_discount,l_extendedprice,l_linenumber,l_linestatus,l_orderkey,l_partkey,l_quantity,l_returnflag,'
                 || 'l_shipdate,l_suppkey,l_tax'), (FALSE, '')) AS s(asked, found)
    """,
    "sink_dictionary": """
        SELECT lineitem.*, asked, found FROM lineitem, (VALUES (TRUE, TRUE), (FALSE, FALSE)) AS s(asked, found)
    """,
    "shard_hot": """
        SELECT *, CAST(half AS INTEGER) AS shard_index, half = 0 AS split, half > 0 AS one_file
        FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey % 3 + 1 ELSE 0 END AS half FROM orders)
    """,
    "sink_max_records": """
        SELECT CAST(o_orderkey % 3 AS INTEGER) AS shard_index, CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS within_limit
        FROM orders GROUP BY 1
    """,
    "sink_overwrite": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority, CAST(o_orderkey % 4 AS INTEGER) AS shard_index
        FROM orders WHERE o_totalprice > 50000
    """,
    "sink_empty": """
        SELECT CAST(o_orderkey % 4 AS INTEGER) AS shard_index,
               CAST(SUM(CASE WHEN o_orderkey % 4 = 2 THEN 0 ELSE 1 END) AS BIGINT) AS rows,
               o_orderkey % 4 = 2 AS no_file
        FROM orders GROUP BY 1, 3
    """,
    "sink_nothing": "SELECT *, CAST(0 AS INTEGER) AS shard_index FROM orders WHERE o_orderkey < 0",
    "unload_parquet": "SELECT * FROM orders",
    "unload_csv": "SELECT * FROM orders",
    "unload_csv_conversations": "SELECT * FROM conversations",
    "unload_csv_documents": "SELECT * FROM documents",
    "unload_json": "SELECT * FROM orders",
    "unload_json_documents": "SELECT * FROM documents",
    "unload_max_records": "SELECT *, TRUE AS within_cap, TRUE AS several FROM orders",
    "unload_capped_text": "SELECT *, TRUE AS within_cap, TRUE AS several FROM documents",
    "unload_capped_order": "SELECT *, TRUE AS within_cap, TRUE AS in_order FROM orders",
    "unload_single": "SELECT CAST(1 AS BIGINT) AS files, CAST(COUNT(*) AS BIGINT) AS rows FROM orders",
    "unload_ordered": """
        SELECT CAST(COUNT(*) AS BIGINT) AS rows, TRUE AS several, CAST(0 AS BIGINT) AS out_of_order FROM orders
    """,
}
