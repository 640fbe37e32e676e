"""Row transforms on DataFrame columns. Every one takes and returns a DataFrame, so they
chain with ``df.transform(fn, ...)`` and stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text a redacted column holds, the length and suffix of a short hash.
REDACTED = "<redacted>"
SHORT_HASH_CHARS = 16
SHORT_HASH_SUFFIX = "@hashed"


def redact(df: DataFrame, column: str, value: str = REDACTED) -> DataFrame:
    """Replace every value, NULLs too, with a constant."""
    if column not in df.columns:
        raise ValueError(f"cannot redact {column!r}: no such column")
    return df.withColumn(column, F.lit(value))


def short_hash(df: DataFrame, column: str) -> DataFrame:
    """First 16 hex digits of SHA-256 plus a suffix; NULL stays NULL."""
    if column not in df.columns:
        return df
    digest = F.sha2(F.col(column).cast("string"), 256)
    return df.withColumn(column, F.concat(F.left(digest, F.lit(SHORT_HASH_CHARS)), F.lit(SHORT_HASH_SUFFIX)))


def full_hash(df: DataFrame, column: str) -> DataFrame:
    """Full SHA-256 in hex; NULL and the empty string both become NULL."""
    if column not in df.columns:
        return df
    text = F.col(column).cast("string")
    return df.withColumn(column, F.when(text != "", F.sha2(text, 256)))


def drop(df: DataFrame, *columns: str) -> DataFrame:
    """Remove columns; absent ones are fine."""
    return df.drop(*columns)


def clamp(df: DataFrame, column: str, floor=0) -> DataFrame:
    """Raise values below ``floor`` to it. NULL is skipped by the maximum, so it becomes the floor."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.greatest(F.col(column), F.lit(floor).cast(df.schema[column].dataType)))


def derive(df: DataFrame, column: str, expression: str | Column) -> DataFrame:
    """Add or replace a column by an expression over the others."""
    return df.withColumn(column, F.expr(expression) if isinstance(expression, str) else expression)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def cast(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Change column types. ``lenient`` turns values that do not convert into NULL."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) if lenient else F.col(c).cast(t) for c, t in types.items()}
    )


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply transforms in the given order."""
    for step in steps:
        df = df.transform(step)
    return df
