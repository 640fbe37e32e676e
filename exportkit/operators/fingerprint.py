"""Order-free checksums of whole DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructField, StructType

SUMS = ("sum_low", "sum_mid", "sum_high")
ROW_HASH = "_row_hash"


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, MapType):
        return True
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind)
    return _has_map(kind.elementType) if hasattr(kind, "elementType") else False


def hashable(field: StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, MapType) and not _has_map(field.dataType.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(column) if _has_map(field.dataType) else column


def row_hash(fields: Sequence[StructField]) -> Column:
    """64-bit hash of a row, in the order of ``fields``.

    Which columns are NULL is part of it, because the hash function itself skips NULLs.
    """
    return F.xxhash64(*[hashable(f) for f in fields], *[F.col(f"`{f.name}`").isNull() for f in fields])


def hash_sums(column: str = ROW_HASH) -> list[Column]:
    """Sums over the hash in slices of 22, 22 and 20 bits: long additions that cannot
    overflow below 2**41 rows, where one sum over whole hashes would."""
    return [F.sum(part).alias(name) for name, part in zip(SUMS, hash_slices(column))]


def hash_slices(column: str = ROW_HASH) -> list[Column]:
    """The three slices of the hash that :func:`hash_sums` adds up."""
    mask = F.lit((1 << 22) - 1).cast("bigint")
    return [
        F.col(column).bitwiseAND(mask),
        F.shiftrightunsigned(column, 22).bitwiseAND(mask),
        F.shiftrightunsigned(column, 44),
    ]


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row count and hash sums per group. Equal multisets of rows give equal values, and
    repeated rows count (unlike a XOR of hashes)."""
    hashed = [f for f in df.schema if f.name not in by]
    return (
        df.select(*by, row_hash(hashed).alias(ROW_HASH))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("rows"), *hash_sums())
    )
