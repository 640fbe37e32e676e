"""What the operators share: batches through Arrow, tables cut from their lineage, column names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from exportkit.session import delete_path, scratch_dir

# ASCII white space that separates words, and the words between it.
SPACES = " \t\n\u000b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

ROWS_OUT = 4096
BYTES_OUT = 8 << 20


def through_arrow(df: DataFrame, each: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``each`` over Arrow batches. It gets a dict of columns and yields dicts of columns.

    Columns come as Arrow arrays and go back as lists, NumPy or Arrow arrays.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            for out in each(columns):
                arrays = [_array(out[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def rows_through_arrow(df: DataFrame, each: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """Like :func:`through_arrow`, for functions that yield rows; rows go out some megabytes at a time."""
    names = StructType.fromDDL(schema).fieldNames()

    def batches(columns):
        rows, size = [], 0
        for row in each(columns):
            rows.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
            if len(rows) >= ROWS_OUT or size >= BYTES_OUT:
                yield dict(zip(names, map(list, zip(*rows))))
                rows, size = [], 0
        if rows:
            yield dict(zip(names, map(list, zip(*rows))))

    return through_arrow(df, batches, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind)


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each value, one at a time; null is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read again.

    The hint to collect garbage lets Spark's cleaner drop the shuffle files of the steps behind the
    table, which nothing needs any more.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def fewer_tasks(df: DataFrame, rows: int, rows_a_task: int) -> DataFrame:
    """``df`` in no more tasks than ``rows`` need, and never in fewer than the cluster runs at once.

    Each task writes a file, and a file of a few rows costs its task more than the rows do: on a local
    store without Hadoop's native code, two processes that the executor starts.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_a_task)))


def drop_written(df: DataFrame) -> None:
    """Remove the files behind a frame of :func:`written` once nothing reads them any more."""
    folders = {path.rsplit("/", 1)[0] for path in df.inputFiles()}
    for folder in folders:
        delete_path(df.sparkSession, folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def narrow(df: DataFrame, carry: bool = False, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; anything else in ``df`` is ignored.

    With ``carry``, all columns but the text travel along in a struct ``carried``, whatever their names.
    """
    kept = [F.col(f"`{source}`").alias(name) for name, source in columns.items()]
    if carry:
        rest = [F.col(f"`{name}`") for name in df.columns if name != columns.get("text")]
        kept.append(F.struct(*rest).alias("carried"))
    return df.select(*kept)


def carried(df: DataFrame) -> list[str]:
    """The column that :func:`narrow` added, if it did."""
    return [name for name in df.columns if name == "carried"]


def carried_schema(df: DataFrame) -> str:
    return "".join(f", carried {df.schema[name].dataType.simpleString()}" for name in carried(df))
