"""Files cut to a size cap by what they measure.

How large a file comes out is only known once it is encoded, so the first write is measured and what
is too large is cut again: the bytes of each file are shared out over its rows by their width, a
running sum over rows and files gives every row its place in bytes, and the cap cuts that line into
files. Rows keep their order across the file names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..session import hadoop_path

# How full files are planned, and how much less in each further attempt: headers and footers, and
# dictionaries that a part of a file no longer shares, are not in the running sum.
FILL, LESS = 0.9, 0.75
PLACE, BLOCK, WITHIN, WIDTH, FILE = "_cut_place", "_cut_block", "_cut_within", "_cut_width", "_cut_file"
CHUNK, TARGET = "_cut_chunk", "_cut_target"
# Rows of a chunk, as a power of two; bytes of a file from which on its rows are packed, and of a pack.
CHUNK_BITS = 12
PACK_ABOVE, PACK_BYTES = 8 << 20, 4 << 20


def listed(spark: SparkSession, path: str) -> DataFrame:
    """``(uri, bytes)`` of the data files below ``path``; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"))


def file_place(name: Column) -> Column:
    """Number of a file among those of one write, in the order of the rows."""
    part, piece = F.regexp_extract(name, r"part-(\d+)-", 1), F.regexp_extract(name, r"-c(\d+)\.", 1)
    return part.cast("bigint") * 1_000_000 + piece.cast("bigint")


def cut_again(rows: DataFrame, sizes: DataFrame, capacity: float) -> DataFrame:
    """``rows`` of the files in ``sizes`` dealt to new files of ``capacity`` bytes, one task per file.

    Sums run over the rows of one chunk of a file, over the chunks of a file, and over the files; no task sees
    all rows of a large file but the one that writes it, which gets them packed (:func:`packed`).
    """
    columns, schema = rows.columns, rows.schema
    width = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)))) + 1
    placed = rows.select(
        *(F.col(f"`{c}`") for c in columns),
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        # Ascending inside one block, and the same again when a task is repeated.
        F.monotonically_increasing_id().alias(WITHIN),
        width.cast("double").alias(WIDTH),
    ).withColumn(CHUNK, F.shiftright(WITHIN, CHUNK_BITS))
    chunks = placed.groupBy(FILE, BLOCK, CHUNK).agg(F.sum(WIDTH).alias("chunk_width"))
    totals = chunks.groupBy(FILE).agg(F.sum("chunk_width").alias("all_width"))
    totals = totals.join(sizes.select(F.col("uri").alias(FILE), "bytes"), FILE)
    totals = totals.withColumn(PLACE, file_place(F.col(FILE)))
    before = Window.orderBy(PLACE, FILE).rowsBetween(Window.unboundedPreceding, -1)
    files = totals.select(
        FILE, PLACE, (F.col("bytes") / F.col("all_width")).alias("rate"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("before"),
    )
    earlier = Window.partitionBy(FILE).orderBy(BLOCK, CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("chunk_starts", F.coalesce(F.sum("chunk_width").over(earlier), F.lit(0.0))).join(files, FILE)
    inside = Window.partitionBy(FILE, BLOCK, CHUNK).orderBy(WITHIN).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_cut_running", F.coalesce(F.sum(WIDTH).over(inside), F.lit(0.0)))
    # The chunks go to the rows: of a result that is small when compressed, the rows would go to the one
    # task that has the sums over the files.
    dealt = running.join(F.broadcast(chunks.drop("chunk_width")), [FILE, BLOCK, CHUNK])
    reached = F.col("before") + (F.col("chunk_starts") + F.col("_cut_running")) * F.col("rate")
    dealt = dealt.withColumn(TARGET, F.floor(reached / F.lit(capacity)).cast("int"))
    parts = ceil(sizes.agg(F.sum("bytes")).first()[0] / capacity) + 1
    order = (PLACE, FILE, BLOCK, WITHIN)
    if capacity < PACK_ABOVE or not packs(schema):
        dealt = dealt.repartitionById(parts, TARGET).sortWithinPartitions(*order)
        return dealt.select(*(F.col(f"`{c}`") for c in columns))
    body = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns))).alias("body")
    dealt = packed(dealt.select(TARGET, *order, body).sortWithinPartitions(TARGET, *order), order)
    return unpacked(dealt.repartitionById(parts, TARGET).sortWithinPartitions(*order), schema)


def packs(schema: StructType) -> bool:
    """Whether Arrow has all types of ``schema``."""
    try:
        to_arrow_schema(schema)
    except PySparkException:
        return False
    return True


def packed(dealt: DataFrame, order: Sequence[str]) -> DataFrame:
    """Neighbouring rows of one target as compressed Arrow batches, each with the place of its first row.

    A task that writes a large file sorts these, about as many bytes as the file has, instead of its rows.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [pc.run_end_encode(batch.column(k)).run_ends.to_pylist() for k in (TARGET, FILE, BLOCK)]
            chunk = pc.run_end_encode(pc.shift_right(batch.column(WITHIN), CHUNK_BITS)).run_ends.to_pylist()
            ends = sorted({end for found in (*keys, chunk) for end in found})
            for start, end in zip([0, *ends], ends):
                step = max(1, (end - start) // max(1, batch.slice(start, end - start).nbytes // PACK_BYTES))
                for at in range(start, end, step):
                    rows = batch.slice(at, min(step, end - at))
                    body, sink = pa.RecordBatch.from_arrays([rows.column("body")], names=["body"]), pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, body.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(body)
                    first = [rows.column(k).slice(0, 1) for k in (TARGET, *order)]
                    content = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([*first, content], names=[TARGET, *order, "pack"])

    kinds = {TARGET: "int", FILE: "string"}
    return dealt.mapInArrow(pack, ", ".join(f"{k} {kinds.get(k, 'bigint')}" for k in (TARGET, *order)) + ", pack binary")


def unpacked(packs: DataFrame, schema: StructType) -> DataFrame:
    """The rows of ``packs``, in their order."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("pack"):
                with pa.ipc.open_stream(content.as_buffer()) as rows:
                    yield from rows

    inner = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])
    rows = packs.select("pack").mapInArrow(unpack, StructType([StructField("body", inner)]))
    return rows.select(*(F.col(f"body.c{i}").alias(f.name) for i, f in enumerate(schema)))


def hold_cap(
    spark: SparkSession,
    path: str,
    read: Callable[[list[str]], DataFrame],
    append: Callable[[DataFrame, int], None],
    cap: int,
    in_order: bool,
    fill_up: bool,
) -> None:
    """Cut the files below ``path`` until none is above ``cap``; a single row is never cut.

    ``append(rows, n)`` adds files of at most ``n`` rows each, 0 for any number.
    Files within the cap stay as they are, unless the order across the file names matters: then all are
    cut anew. With ``fill_up`` they are also cut anew, once, when there are more than the cap asks for.
    The driver holds the names of files above the cap, never those of all files.
    """
    fill, first, lone = FILL, True, set()
    while True:
        found = listed(spark, path)
        total = found.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).first()
        scattered = fill_up and first and total["files"] > ceil((total["bytes"] or 0) / (cap * FILL))
        large = [r["uri"] for r in found.where(F.col("bytes") > cap).select("uri").collect() if r["uri"] not in lone]
        above: dict[str, int] = {}
        if large:
            held = read([unquote(uri) for uri in large]).groupBy(
                F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("bytes")
            )
            counted = held.count().where("count > 1").collect()
            above = {r["uri"]: even_rows(r["count"], r["bytes"], cap * FILL) for r in counted}
            lone |= set(large) - set(above)  # one row or none: as small as they get
        if not above and not scattered:
            return
        if in_order or scattered:
            chosen = found
            append(cut_again(read([path]), chosen, cap * fill), 0)
        else:
            chosen = found.where(F.col("uri").isin(list(above)))
            # Files whose rows are about as wide go together: a task writes many files, no row is moved.
            for size in sorted({n.bit_length() for n in above.values()}):
                alike = {uri: n for uri, n in above.items() if n.bit_length() == size}
                append(read([unquote(uri) for uri in alike]), min(alike.values()))
        for row in chosen.toLocalIterator():  # listed before the new files were there
            fs, old = hadoop_path(spark, unquote(row["uri"]))
            fs.delete(old, False)
        first, fill = False, fill * LESS


def even_rows(rows: int, size: int, capacity: float) -> int:
    """Rows of each part when a file of ``size`` bytes above ``capacity`` is cut into even parts below it."""
    fitting = max(1, int(capacity * rows / size))
    return ceil(rows / ceil(rows / fitting))
