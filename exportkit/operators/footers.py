"""What Parquet files say about themselves: row groups, codecs, statistics, dictionaries."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from .cut import listed
from .inventory import arrow_place

FOOTERS = (
    "uri string, row_group int, group_rows bigint, column string, physical_type string, codec string, "
    "offset bigint, bytes bigint, raw_bytes bigint, statistics boolean, nulls bigint, dictionary boolean"
)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and column chunk below ``path``.

    Tasks open the files and read their footers only. ``statistics`` says whether the chunk has a
    smallest and largest value or a number of nulls; ``dictionary`` whether a page of it is encoded by
    one. ``offset`` and ``bytes`` say where in the file the chunk lies. A file without row groups has no row.
    """
    # A fixed number of partitions, or adaptive execution would open all files in one task.
    places = listed(spark, path).select("uri").repartition(spark.sparkContext.defaultParallelism, "uri")
    return places.mapInArrow(_chunks_of, FOOTERS)


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in FOOTERS.split(", ")]
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            store, path = arrow_place(uri)
            with store.open_input_file(path) as source:
                rows = list(_facts(uri, pq.ParquetFile(source).metadata))
            if rows:
                kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 3, *[pa.int64()] * 3, pa.bool_(), pa.int64(), pa.bool_()]
                arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def _facts(uri: str, meta: pq.FileMetaData) -> Iterator[tuple]:
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            chunk = group.column(c)
            known = chunk.statistics if chunk.is_stats_set else None
            yield (
                uri, g, group.num_rows, chunk.path_in_schema, chunk.physical_type, chunk.compression,
                chunk.dictionary_page_offset or chunk.data_page_offset, chunk.total_compressed_size, chunk.total_uncompressed_size,
                known is not None and (known.has_min_max or known.has_null_count),
                known.null_count if known is not None and known.has_null_count else None,
                any("DICTIONARY" in encoding for encoding in chunk.encodings),
            )


def file_facts(chunks: DataFrame) -> DataFrame:
    """One row per file: row groups, the largest of them, codecs in use, and which columns have
    statistics or a dictionary in every row group."""
    columns = chunks.groupBy("uri", "column").agg(
        F.bool_and("statistics").alias("statistics"), F.bool_and("dictionary").alias("dictionary")
    )
    named = lambda flag: F.sort_array(F.collect_list(F.when(F.col(flag), F.col("column")))).alias(f"with_{flag}")
    columns = columns.groupBy("uri").agg(named("statistics"), named("dictionary"))
    groups = chunks.groupBy("uri").agg(
        (F.max("row_group") + 1).alias("row_groups"),
        F.max("group_rows").alias("largest_group"),
        F.sort_array(F.collect_set("codec")).alias("codecs"),
    )
    return groups.join(columns, "uri")


def with_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows read from files, each with the facts of the file it comes from.

    The facts go to the rows: dealt out by file, all rows of a file would meet in one task, to be sorted.
    """
    own = rows.withColumn("uri", F.col("_metadata.file_path"))
    return own.join(F.broadcast(facts), "uri").drop("uri")


# -------------------------------------------------------------------- schemas of landed files


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``(uri, schema)``: the Spark schema that each Parquet file below ``path`` was written with.

    Spark keeps it in the footer, so nested types and nullability come back as they were; files of other
    writers get the schema that Arrow makes of theirs.
    """
    places = listed(spark, path).select("uri").repartition(spark.sparkContext.defaultParallelism, "uri")
    return places.mapInArrow(_schemas_of, "uri string, schema string")


# Fixed value: where Spark's Parquet writer leaves the schema.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _schemas_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for uri in batch.column("uri").to_pylist():
            store, path = arrow_place(uri)
            with store.open_input_file(path) as source:
                file = pq.ParquetFile(source)
                kept = (file.metadata.metadata or {}).get(SPARK_SCHEMA)
                texts.append(kept.decode() if kept else from_arrow_schema(file.schema_arrow).json())
        yield pa.RecordBatch.from_arrays([batch.column("uri").cast(pa.string()), pa.array(texts, pa.string())], names=["uri", "schema"])


def landed_schemas(spark: SparkSession, path: str) -> list[tuple[StructType, int]]:
    """The different schemas of the files below ``path``, each with the number of its files; most first."""
    found = file_schemas(spark, path).groupBy("schema").agg(F.count(F.lit(1)).alias("files"))
    rows = found.orderBy(F.desc("files"), "schema").collect()
    return [(StructType.fromJson(json.loads(r["schema"])), r["files"]) for r in rows]
