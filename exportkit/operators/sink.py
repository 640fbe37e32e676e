"""Sinks: sharded or partitioned Parquet exports and bulk unloads."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.schema import coerce_timestamps
from ..options import MIB, LayoutOptions, ParquetOptions, UnloadOptions
from ..session import delete_path, hadoop_path, path_exists, small_table, with_settings
from .cut import hold_cap
from .fingerprint import ROW_HASH, SUMS, hash_sums, row_hash
from .shards import Shards, SingleShard

# What an unquoted empty CSV field (NULL) becomes inside the reader. Left at its default it
# could not be told from a quoted empty one (empty text).
UNQUOTED_EMPTY = "\u0000null\u0000"
LONE_NULL = "\\N"
SALT = "_salt"
# Finer than the parts asked for, so that parts of about one size come out of a hash.
SALTS_PER_PART = 8
# Directories that a task writes side by side. Rows of further ones are sorted by directory first, which
# a task that holds one large directory never has to do.
OPEN_DIRECTORIES = 16
# Shuffled bytes that a task of a second cut takes.
CUT_BYTES = 16 * MIB
# Shuffled bytes that a task of an unordered unload takes at least, where there are so many.
FIRST_BYTES = 4 * MIB


@dataclass(frozen=True)
class Written:
    """What a write handed to the files: path, schema to read it back with, rows, times, and
    the hash sums of the rows if they were asked for."""

    path: str
    schema: StructType
    rows: int = 0
    started: float = 0.0
    elapsed_s: float = 0.0
    format: str = "parquet"
    header: bool = True
    checksum: tuple[int, ...] | None = None


def checked_path(base: str, relative: str) -> str:
    """``base/relative``. The relative part must not leave ``base``."""
    if relative.startswith("/"):
        raise ValueError(f"relative path must not start with '/': {relative!r}")
    if ".." in relative:
        raise ValueError(f"relative path must not contain '..': {relative!r}")
    return f"{base.rstrip('/')}/{relative}".rstrip("/")


def _run_write(
    df: DataFrame, written: Written, settings: dict[str, str], checksum: bool, write: Callable[[DataFrame], None]
) -> Written:
    """Run ``write`` on ``df`` and take down what the writing tasks took in.

    The counts sit behind the last exchange, in the stage that writes: Spark adds up each of
    its partitions once, also when lost executors make earlier stages run again.
    """
    observed = Observation(f"written-{uuid.uuid4().hex}")
    counts = [F.count(F.lit(1)).alias("rows")]
    settings = {**settings, "spark.sql.adaptive.enabled": "true"}
    started = time.time()
    with with_settings(df, settings) as out:
        if checksum:
            out = out.withColumn(ROW_HASH, row_hash(list(written.schema)))
            out = out.observe(observed, *counts, *hash_sums()).drop(ROW_HASH)
        else:
            out = out.observe(observed, *counts)
        write(out)
    found = observed.get
    sums = tuple(found[s] or 0 for s in SUMS) if checksum else None
    return replace(
        written, rows=found["rows"], started=started, elapsed_s=time.time() - started, checksum=sums
    )


def dealt_out(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly over the cores, copies of one row too.

    Spark sorts the rows of each partition before it deals them round, so that a lost task
    deals them the same way again.
    """
    return df.hint("rebalance")


def salted(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """``df`` with a salt that deals the rows of a directory of more than ``hot_rows`` into parts.

    The salt follows from a row's position in its task, so a repeated task deals its rows the same way.
    There are at most ``rows / hot_rows`` such directories; others have one part.
    """
    counts = df.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.count(F.lit(1)).alias("_held"))
    hot = counts.where(F.col("_held") > hot_rows).select(*(F.col(f"`{k}`") for k in keys), F.ceil(F.col("_held") / hot_rows * SALTS_PER_PART).cast("bigint"))
    names = [f"_hot{i}" for i in range(len(keys))]
    schema = StructType([*(StructField(n, df.schema[k].dataType) for n, k in zip(names, keys)), StructField("_parts", LongType())])
    parts = small_table(df.sparkSession, [tuple(r) for r in hot.collect()], schema)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    salt = F.pmod(F.col("_position"), F.coalesce("_parts", F.lit(1).cast("bigint"))).alias(SALT)
    placed = df.withColumn("_position", F.monotonically_increasing_id())
    return placed.join(parts, same, "left").select(*(F.col(f"`{c}`") for c in df.columns), salt)


def write_export(
    df: DataFrame,
    path: str,
    shards: Shards | None = None,
    *,
    partition_by: Sequence[str] = (),
    only: Sequence[int] | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    parquet: ParquetOptions | None = None,
    layout: LayoutOptions | None = None,
    mode: str = "overwrite",
    keep_other_partitions: bool = False,
    checksum: bool = False,
) -> Written:
    """Write ``df`` as Parquet, one directory per shard (and per ``partition_by`` value).

    Rows are rebalanced by output directory. AQE measures the exchange and splits a
    directory beyond ``layout.target_file_bytes`` over several tasks, so a shard holding a
    third of the data becomes many files written in parallel, while a small shard is one
    file. ``shape`` is applied after the shards are cut, on rows that still carry their
    shard columns, and behind the exchange, where a task holds few shards (before it only if
    ``shape`` makes a directory column itself). Timestamps are cut to ``parquet.coerce_timestamps``.
    ``keep_other_partitions`` replaces only the directories being written. ``checksum`` sums
    up row hashes on the way, for ``validate(level="full")``.
    """
    shards = shards or SingleShard()
    parquet = parquet or ParquetOptions()
    layout = layout or LayoutOptions()
    assigned = shards.assign(df, only)
    keys = list(dict.fromkeys([*shards.partition_columns, *partition_by]))

    def exchanged(rows: DataFrame) -> DataFrame:
        if keys and layout.shuffle and layout.hot_rows:
            return salted(rows, keys, layout.hot_rows).hint("rebalance", *keys, SALT).drop(SALT)
        if keys and layout.shuffle:
            return rows.hint("rebalance", *keys)
        return dealt_out(rows) if layout.spread else rows

    if shape is None:
        assigned = exchanged(assigned)
    elif set(partition_by) <= set(df.columns):
        assigned = shape(exchanged(assigned))
    else:
        assigned = exchanged(shape(assigned))
    data = [f for f in assigned.schema if f.name not in keys]
    schema = StructType(data + [assigned.schema[k] for k in keys])
    assigned = _no_empty_directory(assigned, partition_by)
    # Behind the exchange, so that all writing tasks share the work.
    assigned = coerce_timestamps(assigned, parquet.coerce_timestamps)

    def write(out: DataFrame, target: str) -> None:
        # A writer option, not a session setting: another export that runs in the same
        # session must never turn a partial overwrite into a full one.
        overwrites = "dynamic" if keep_other_partitions else "static"
        writer = out.write.mode(mode).options(**parquet.writer_options(), partitionOverwriteMode=overwrites)
        if layout.max_records_per_file:
            writer = writer.option("maxRecordsPerFile", layout.max_records_per_file)
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(target)

    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(layout.target_file_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min(MIB, layout.target_file_bytes)),
        # The same for every export: values are cut by the projection above, so exports that
        # run side by side cannot cut each other's, and nested values stay as they are.
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_DIRECTORIES),
    }
    whole = mode == "overwrite" and not keep_other_partitions
    written = Written(path, schema)
    if not whole:
        return _run_write(assigned, written, settings, checksum, lambda out: write(out, path))
    with replacing(df.sparkSession, path) as staged:
        return _run_write(assigned, written, settings, checksum, lambda out: write(out, staged))


def _no_empty_directory(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Refuse empty text in a directory column: it would come back as NULL."""
    for name in columns:
        if isinstance(df.schema[name].dataType, StringType):
            refusal = F.raise_error(F.lit(f"empty text in {name} cannot be a directory name"))
            df = df.withColumn(name, F.when(F.col(f"`{name}`") == "", refusal).otherwise(F.col(f"`{name}`")))
    return df


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to, which is ``path`` once the block has succeeded.

    Where nothing was before, that is ``path`` itself. A folder that exists is left untouched by a failed
    attempt and replaced by renaming, which suits file systems; an ``ExportJob`` never renames data, as
    each of its attempts has a folder of its own that its catalog points to.
    """
    if not path_exists(spark, path):
        try:
            yield path
        except BaseException:
            delete_path(spark, path)
            raise
        return
    fs, target = hadoop_path(spark, path)
    staged, before = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}" for kind in ("attempt", "before"))
    try:
        yield staged
    except BaseException:
        delete_path(spark, staged)
        raise
    new, old = hadoop_path(spark, staged)[1], hadoop_path(spark, before)[1]
    if not fs.rename(target, old):
        raise OSError(f"{path} cannot be moved aside for its next attempt, which is complete at {staged}")
    if not fs.rename(new, target):
        raise OSError(f"{staged} cannot be moved to {path}; what was there before is at {before}")
    fs.delete(old, True)


# Microseconds are kept in text formats (Spark's default pattern cuts them).
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def csv_options(header: bool) -> dict:
    """Quoting that gives every text back as it was: blanks, quotes and line breaks too."""
    return {
        **TEXT_TIMES,
        "header": header,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def _lone_null(schema: StructType) -> dict:
    """NULL in a table of one column would be a blank line, which readers skip: it gets a mark."""
    return {"nullValue": LONE_NULL} if len(schema) == 1 else {}


def _lone_text_column(schema: StructType) -> str | None:
    return schema[0].name if len(schema) == 1 and isinstance(schema[0].dataType, StringType) else None


def unload(df: DataFrame, path: str, options: UnloadOptions | None = None, *, checksum: bool = False) -> Written:
    """Distributed write without shards: Spark decides on the files, ``max_file_bytes`` on their size.

    The source is read once. Its rows pass an exchange that AQE measures and cuts into files of about
    the cap; what comes out larger is cut again by its measured size (``cut.hold_cap``), so the cap holds
    for every format and size, but for a row that is larger by itself. ``order_by`` keeps the row order
    across the file names (a range exchange). ``single`` asks for one sequence of files, each filled up
    to the cap before the next begins: one file where the cap allows it. Without ``spread`` (and order)
    there is no exchange at first: one file per task, and the cap.
    """
    options = options or UnloadOptions()
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(options.max_file_bytes),
        # Spark merges partitions up to this size whatever the advisory size says; well below the cap, so
        # that small results are spread over the cores too.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(min(MIB, max(1, options.max_file_bytes // 8))),
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    }
    schema = df.schema
    if not options.order_by and not options.single:
        # Files far below this are cut from larger ones, many to a task.
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(max(FIRST_BYTES, options.max_file_bytes))
    if options.single:
        settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if options.order_by:
        # The row hash settles ties, so that rows sharing one sort value still spread over
        # several ranges (only exact copies of a row stay together).
        df = df.withColumn(ROW_HASH, row_hash(list(schema))).orderBy(*options.order_by, ROW_HASH).drop(ROW_HASH)
    elif options.single or options.spread:
        df = dealt_out(df)

    lone_text = _lone_text_column(schema) if options.format == "csv" else None
    if lone_text:
        mark = F.raise_error(F.lit(f"the text {LONE_NULL!r} stands for NULL in a CSV of one column"))
        df = df.withColumn(lone_text, F.when(F.col(f"`{lone_text}`") == LONE_NULL, mark).otherwise(F.col(f"`{lone_text}`")))

    def write(out: DataFrame, target: str, mode: str = "errorifexists", records: int = 0) -> None:
        writer = out.write.mode(mode)
        writer = writer.option("partitionOverwriteMode", "static").option("maxRecordsPerFile", records)
        if options.format == "parquet":
            writer.options(**ParquetOptions(compression=options.codec).writer_options()).parquet(target)
        elif options.format == "csv":
            writer.options(compression=options.codec, **csv_options(options.header), **_lone_null(schema)).csv(target)
        else:
            writer.options(compression=options.codec, ignoreNullFields=False, **TEXT_TIMES).json(target)

    # Exchanges of the second cut decide on no file, so their tasks need not take a file's worth of rows.
    again = settings | {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(CUT_BYTES, options.max_file_bytes)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    }

    def append(rows: DataFrame, target: str, records: int) -> None:
        with with_settings(rows, again) as out:
            write(out, target, "append", records)

    plan = Written(path, schema, format=options.format, header=options.header)

    def run(target: str) -> Written:
        done = _run_write(df, plan, settings, checksum, lambda out: write(out, target))
        hold_cap(
            df.sparkSession,
            target,
            lambda places: read_export(df.sparkSession, plan, places),
            lambda rows, records: append(rows, target, records),
            options.max_file_bytes,
            in_order=bool(options.order_by),
            fill_up=options.single,
        )
        return replace(done, elapsed_s=time.time() - done.started)

    if not options.overwrite:
        return run(path)
    with replacing(df.sparkSession, path) as staged:
        return run(staged)


def read_export(spark: SparkSession, written: Written, places: Sequence[str] = ()) -> DataFrame:
    """Read an export or unload back with the schema it was written with (no inference), or only the
    files in ``places``."""
    reader, at = spark.read.schema(written.schema), list(places) or [written.path]
    if written.format == "csv":
        options = {**csv_options(written.header), "multiLine": True, "nullValue": UNQUOTED_EMPTY}
        options |= _lone_null(written.schema)
        return reader.options(**options).csv(at)
    if written.format == "json":
        return reader.options(**TEXT_TIMES).json(at)
    return reader.parquet(*at)
