"""Incremental window: bounds, filter and overlap removal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

# Fixed value: where the first run of a job starts.
FIRST_RUN = "1970-01-01 00:00:00"


@dataclass(frozen=True)
class Bounds:
    """``prev < column <= now``, both as text plus the type they are cast to."""

    prev: str
    now: str
    type_name: str

    def value(self, text: str) -> Column:
        return F.lit(text).cast(self.type_name)


def first_run_value(kind: DataType) -> str:
    """Lower bound of a first run for a column type. Numbers have no natural one."""
    if isinstance(kind, DateType):
        return FIRST_RUN[:10]
    if isinstance(kind, (TimestampType, TimestampNTZType, StringType)):
        return FIRST_RUN
    if isinstance(kind, NumericType):
        raise ValueError("a numeric window column needs an explicit default")
    raise ValueError(f"{kind.simpleString()} cannot be a window column")


def as_text(value: Column, type_name: str) -> Column:
    """A bound as text that means the same in every session: instants carry their offset."""
    if type_name == "timestamp":
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
    return value.cast("string")


def fixed_text(spark: SparkSession, text: str, type_name: str) -> str:
    """``text``, read in this session, as a bound that other sessions read alike."""
    if type_name != "timestamp":
        return text
    return spark.range(1).select(as_text(F.lit(text).cast(type_name), type_name)).first()[0] or text


def upper_bound(df: DataFrame, column: str) -> str | None:
    """``MAX(column)`` as text (see ``as_text``), or ``None``."""
    type_name = df.schema[column].dataType.simpleString()
    return df.agg(as_text(F.max(column), type_name).alias("now")).first()["now"]


def window(df: DataFrame, column: str, bounds: Bounds, lateness: str | None = None) -> DataFrame:
    """Rows with ``prev < column <= now``; NULLs never match.

    The bounds are literals of the column's own type, so the filter reaches the scan.
    ``lateness`` (``"1 hour"``) moves the lower bound back; the overlap with the run before
    is then removed with ``latest_per_key``.
    """
    low = bounds.value(bounds.prev)
    if lateness:
        low = (low - F.expr(f"INTERVAL '{lateness}'")).cast(bounds.type_name)
    return df.filter((F.col(column) > low) & (F.col(column) <= bounds.value(bounds.now)))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by``; name a unique column last to settle ties.

    Spark keeps only the best row per key in each task before the shuffle (window group
    limit), so a key that owns a large share of all rows sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_by]))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
