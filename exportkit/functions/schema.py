"""Schema rules: timestamp units, alignment to a target, audit and drift."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DayTimeIntervalType,
    DecimalType,
    MapType,
    StructType,
    TimestampNTZType,
    TimestampType,
    YearMonthIntervalType,
)

from ..options import TIMESTAMP_UNITS
from ..session import small_table

# Microseconds and seconds per unit.
UNIT_MICROS = {"s": 1_000_000, "ms": 1_000}
UNIT_SECONDS = {"s": Decimal("1"), "ms": Decimal("0.001")}
MAX_DECIMAL_DIGITS = 38
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "+00:00")


def _truncate_instant(column: Column, unit: str) -> Column:
    micros = F.unix_micros(column)
    return F.timestamp_micros(micros - micros % UNIT_MICROS[unit])


def _truncate_local(column: Column, unit: str, zone: str) -> Column:
    if zone in UTC_NAMES:
        return _truncate_instant(column.cast("timestamp"), unit).cast("timestamp_ntz")
    # In a session zone with daylight saving, a cast to an instant would move wall-clock
    # times that fall into the spring gap, so the fraction is taken off by interval.
    step = F.lit(UNIT_SECONDS[unit])
    rest = F.date_part(F.lit("SECOND"), column) % step
    before_epoch = (column < F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")) & (rest > 0)
    return F.when(before_epoch, column + F.make_dt_interval(secs=step - rest)).otherwise(
        column - F.make_dt_interval(secs=rest)
    )


def coerce_timestamps(df: DataFrame, unit: str | None) -> DataFrame:
    """Cut every top-level timestamp to ``unit`` (``s``, ``ms``, ``us``), towards the epoch.

    Column types stay as they are. ``us`` is Spark's own resolution and ``None`` switches
    the rule off; both leave the plan untouched.
    """
    if unit is not None and unit not in TIMESTAMP_UNITS:
        raise ValueError(f"unit must be None or one of {', '.join(TIMESTAMP_UNITS)}, got {unit!r}")
    if unit not in UNIT_MICROS:
        return df
    changed = {}
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    for field in df.schema:
        if isinstance(field.dataType, TimestampType):
            changed[field.name] = _truncate_instant(F.col(f"`{field.name}`"), unit)
        elif isinstance(field.dataType, TimestampNTZType):
            changed[field.name] = _truncate_local(F.col(f"`{field.name}`"), unit, zone)
    return df.withColumns(changed) if changed else df


def align(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of ``target`` in its order: cast where present, typed NULL where missing.

    Columns the target does not name are left out.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


def align_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, matched by column name, NULL where one side lacks a column."""
    return left.unionByName(right, allowMissingColumns=True)


def _findings(kind: DataType) -> list[str]:
    found = []
    if isinstance(kind, (ArrayType, StructType)):
        found.append("nested")
    if isinstance(kind, MapType):
        found += ["nested", "map"]
    if isinstance(kind, DecimalType) and kind.precision > MAX_DECIMAL_DIGITS:
        found.append("decimal precision")
    if isinstance(kind, (DayTimeIntervalType, YearMonthIntervalType)):
        found.append("interval")
    return found


def audit(spark: SparkSession, schema: StructType) -> DataFrame:
    """``(column, type, finding)`` for every column some reader may trip over. Never fails."""
    rows = [(f.name, f.dataType.simpleString(), found) for f in schema for found in _findings(f.dataType)]
    return small_table(spark, rows, "column string, type string, finding string")


def _parts(kind: DataType) -> dict[str, DataType] | None:
    """Named parts of a nested type, None for a plain one."""
    if isinstance(kind, StructType):
        return {f.name: f.dataType for f in kind}
    if isinstance(kind, ArrayType):
        return {"element": kind.elementType}
    if isinstance(kind, MapType):
        return {"key": kind.keyType, "value": kind.valueType}
    return None


def differences(before: DataType, after: DataType, path: str = "") -> list[tuple[str, str | None, str | None, str]]:
    """``(column, before_type, after_type, change)`` wherever two types differ, as deep as they differ.

    Parts of a struct, the ``element`` of an array, and the ``key`` and ``value`` of a map are named by
    their path. The order of columns does not count.
    """
    old, new = _parts(before), _parts(after)
    if old is None or new is None or type(before) is not type(after):
        texts = before.simpleString(), after.simpleString()
        return [] if texts[0] == texts[1] else [(path, *texts, "retyped")]
    found = []
    for name in dict.fromkeys([*old, *new]):
        at = f"{path}.{name}" if path else name
        if name not in new:
            found.append((at, old[name].simpleString(), None, "removed"))
        elif name not in old:
            found.append((at, None, new[name].simpleString(), "added"))
        else:
            found += differences(old[name], new[name], at)
    return found


def drift(spark: SparkSession, before: StructType, after: StructType) -> DataFrame:
    """The :func:`differences` of two schemas as a table: columns and nested fields added, removed or
    retyped."""
    return small_table(
        spark, differences(before, after), "column string, before_type string, after_type string, change string"
    )
