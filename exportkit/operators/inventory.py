"""What landed: files, checksums, validation and source/target reconciliation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyarrow import fs as pa_fs
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, small_table
from .cut import listed
from .fingerprint import SUMS, fingerprint
from .shards import SHARD, Shards, SingleShard
from .sink import Written, read_export

MD5_PIECE_BYTES = 8 << 20
# Rows that the default check decodes of every row group but the first, which it decodes whole.
ROWS_PER_GROUP = 1_024

INVENTORY_SCHEMA = (
    "shard_index int, uri string, rows bigint, bytes bigint, md5 string, elapsed_s double, skipped boolean"
)


def files(
    spark: SparkSession, written: Written, shards: Shards | None = None, only: Sequence[int] | None = None
) -> DataFrame:
    """``(shard_index, uri, rows, bytes, modified)`` per data file, from the files themselves.

    For Parquet no column is read: row counts come from the footers. Files without rows and
    names starting with ``_`` or ``.`` do not appear. ``only`` prunes to some shards.
    """
    index = (shards or SingleShard()).index()
    rows = read_export(spark, written)
    if only is not None:
        rows = rows.filter(index.isin(*only))
    return (
        rows.groupBy(
            index.cast("int").alias(SHARD),
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(SHARD, "uri", "rows", "bytes", "modified")
    )


def file_md5(spark: SparkSession, *paths: str) -> DataFrame:
    """``(uri, md5)`` of every file under ``paths``.

    Files of any size are read piece by piece inside the tasks, through Arrow's filesystems; a store that
    Arrow cannot open is an error.
    """
    places = reduce(DataFrame.unionAll, [listed(spark, path).select("uri") for path in paths])
    # A fixed number of partitions, or adaptive execution would read all files in one task.
    spread = places.repartition(spark.sparkContext.defaultParallelism, "uri")
    return spread.mapInArrow(_md5_by_pieces, "uri string, md5 string")


def arrow_place(uri: str) -> tuple[pa_fs.FileSystem, str]:
    """Arrow's filesystem for a file that Spark has named, and the path in it.

    Spark leaves letters beyond ASCII as they are; Arrow wants them escaped like the others.
    """
    return pa_fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe="%/:?#[]@!$&'()*+,;=~"))


def _md5_by_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uris, sums = batch.column(0), []
        for uri in uris.to_pylist():
            store, path = arrow_place(uri)
            digest = hashlib.md5()
            with store.open_input_stream(path) as stream:
                while piece := stream.read(MD5_PIECE_BYTES):
                    digest.update(piece)
            sums.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([uris.cast(pa.string()), pa.array(sums, pa.string())], names=["uri", "md5"])


def landed_files(
    spark: SparkSession,
    written: Written,
    shards: Shards | None = None,
    *,
    md5: bool = False,
    only: Sequence[int] | None = None,
) -> DataFrame:
    """One row per file, plus one row per shard that wrote none (URI ``""``, zero rows).

    ``elapsed_s`` runs from the start of the write until the file was complete. ``only``
    limits the listing to some shards.
    """
    shards = shards or SingleShard()
    found = files(spark, written, shards, only)
    elapsed = F.unix_micros("modified") / 1_000_000 - F.lit(written.started)
    found = found.withColumn("elapsed_s", F.greatest(elapsed, F.lit(0.0)))
    if md5:
        places = [written.path]
        if only is not None:
            places = [f"{written.path}/{shards.directory(s)}" for s in only]
            places = [p for p in places if path_exists(spark, p)]
        found = found.join(file_md5(spark, *places), "uri", "left") if places else found
    if "md5" not in found.columns:
        found = found.withColumn("md5", F.lit(None).cast("string"))
    spec = shards.spec(spark)
    if only is not None:
        spec = spec.filter(F.col(SHARD).isin(*only))
    return spec.join(found, SHARD, "left").select(
        SHARD,
        F.coalesce("uri", F.lit("")).alias("uri"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
        "md5",
        F.coalesce("elapsed_s", F.lit(0.0)).alias("elapsed_s"),
        F.lit(False).alias("skipped"),
    )


def reconcile(source: DataFrame, target: DataFrame, by: Sequence[str] = (SHARD,)) -> DataFrame:
    """Compare two sides group by group: ``(by..., source_rows, target_rows, matches)``.

    Both sides shrink to one row per group before they meet, so the join is tiny.
    """
    parts = ["rows", *SUMS]

    def side(df: DataFrame, label: str) -> DataFrame:
        return fingerprint(df, by).withColumnsRenamed({p: f"{label}_{p}" for p in parts})

    left, right = side(source.select(*target.columns), "source"), side(target, "target")
    keys = list(by)
    if not keys:
        left, right, keys = left.withColumn("_all", F.lit(1)), right.withColumn("_all", F.lit(1)), ["_all"]
    same = [F.col(f"source_{p}").eqNullSafe(F.col(f"target_{p}")) for p in parts]
    everything = reduce(lambda a, b: a & b, same)
    condition = [left[k].eqNullSafe(right[k]) for k in keys]
    return left.join(right, condition, "full_outer").select(
        *[F.coalesce(left[k], right[k]).alias(k) for k in by],
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        everything.alias("matches"),
    )


# ------------------------------------------------------------------ validation


class ExportInvalid(RuntimeError):
    """A finished write did not pass its checks; nothing may be published from it."""


def _with_problem(files: DataFrame) -> DataFrame:
    """``files`` with the ``problem`` met when some of every row group of each is decoded, in the tasks."""
    spark = files.sparkSession
    # A fixed number of partitions, or adaptive execution would read all files in one task.
    spread = files.select("uri", "rows", "bytes").repartition(spark.sparkContext.defaultParallelism, "uri")
    return spread.mapInArrow(_all_groups, "uri string, rows bigint, bytes bigint, problem string")


def _all_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        problems = pa.array([_problem_of(uri) for uri in batch.column("uri").to_pylist()], pa.string())
        yield batch.append_column("problem", problems)


def _problem_of(uri: str) -> str | None:
    """What goes wrong when the first row group, and the first pages of every other, are decoded."""
    group = 0
    try:
        store, path = arrow_place(uri)
        with store.open_input_file(path) as source:
            parquet = pq.ParquetFile(source, buffer_size=64 << 10)
            for group in range(parquet.num_row_groups):
                rows = parquet.iter_batches(batch_size=8192 if group == 0 else ROWS_PER_GROUP, row_groups=[group])
                for _ in rows if group == 0 else islice(rows, 1):
                    pass
    except (OSError, pa.ArrowException) as error:
        return f"{uri}, row group {group}: {error}".splitlines()[0]
    return None


def validate(spark: SparkSession, written: Written, listing: DataFrame, *, level: str = "sample") -> DataFrame:
    """``(check_name, ok, detail)`` for one finished write. Never raises for bad files.

    ``listing`` is the write's ``landed_files``. ``footer`` is content with it: it opened every
    footer, so files exist, none is empty, and their row counts add up to what the writing
    tasks took in. ``sample`` also decodes the first row group of every Parquet file and the first
    pages of every other, through Arrow's filesystems; on a store that Arrow cannot open, ask for another
    level. ``full``
    decodes every column of every row and, when the write was made with ``checksum``, compares
    the hash sums with those of the rows being written.
    """
    if level not in ("footer", "sample", "full"):
        raise ValueError(f"level must be 'footer', 'sample' or 'full', got {level!r}")
    sampled = level == "sample" and written.format == "parquet"
    try:
        data = listing.filter(F.col("uri") != "")
        seen = _with_problem(data) if sampled else data.withColumn("problem", F.lit(None).cast("string"))
        total = seen.agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.min("bytes"), F.lit(0)).alias("smallest"),
            F.count("problem").alias("broken"),
            F.min("problem").alias("problem"),
        ).first()
        expected = written.rows
        checks = [
            ("files_present", total["files"] > 0 or expected == 0, f"{total['files']} files"),
            ("files_not_empty", total["smallest"] > 0 or total["files"] == 0, f"{total['smallest']} bytes at least"),
            ("row_total", total["rows"] == expected, f"{total['rows']} of {expected} rows"),
        ]
        if sampled:
            detail = total["problem"] or "some of every row group"
            checks.append(("values_decode", total["broken"] == 0, detail))
        if level == "full":
            export = read_export(spark, written).withColumn("_uri", F.col("_metadata.file_path"))
            decoded = fingerprint(export, ["_uri"]).join(data.select(F.col("uri").alias("_uri")), "_uri", "left_semi")
            # The hash sums have to be asked for: without them no column would be read.
            found = decoded.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SUMS],
            ).first()
            checks.append(("all_columns_decode", found["rows"] == total["rows"], f"{found['rows']} rows decoded"))
            if written.checksum is not None:
                same = tuple(found[s] for s in SUMS) == written.checksum
                checks.append(("content_checksum", same, "hash sums of rows written and rows read back"))
    except (PySparkException, Py4JJavaError) as error:
        checks = [("readable", False, str(error).splitlines()[0])]
    return small_table(spark, checks, "check_name string, ok boolean, detail string")


def require_valid(checks: DataFrame) -> None:
    """Raise ``ExportInvalid`` naming every failed check."""
    failed = checks.filter(~F.col("ok")).collect()
    if failed:
        raise ExportInvalid("; ".join(f"{r['check_name']}: {r['detail']}" for r in failed))
