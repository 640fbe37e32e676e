"""JDBC source: one connection and one query per shard predicate, all read in parallel."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.shards import sql_literal
from .sql import first_text

_WINDOW_MARKER = re.compile(r":(watermark_prev|watermark_now)\b")


def _with_bounds(query: str, values: dict[str, Any]) -> str:
    """``query`` with its window markers replaced by quoted literals; no other text changes."""

    def literal(marker: re.Match) -> str:
        if marker[1] not in values:
            raise ValueError(f"the query names :{marker[1]}, but the run has no such value")
        return sql_literal(values[marker[1]])

    return _WINDOW_MARKER.sub(literal, query)


@dataclass(frozen=True)
class JdbcSource:
    """A database table or query.

    Give ``predicates`` (SQL text, one per shard; see ``Shards.sql_predicates``) or the
    ``column`` / ``lower`` / ``upper`` / ``partitions`` quartet to read in parallel; for ranges of equal
    depth, take the texts of ``equal_depth_shards``. Without either the table would be read by one task,
    which is refused unless ``one_task`` asks for it. ``lower`` and ``upper`` set the stride of the
    ranges; rows outside them still arrive in the first and last range.
    A ``query`` that names ``:watermark_prev`` and ``:watermark_now`` applies the window itself;
    the bounds are put in as quoted literals.
    """

    url: str
    table: str | None = None
    query: str | None = None
    fetch_rows: int = 50_000
    predicates: Sequence[str] = ()
    column: str | None = None
    lower: str | int | None = None
    upper: str | int | None = None
    partitions: int | None = None
    one_task: bool = False
    properties: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if bool(self.table) == bool(self.query):
            raise ValueError("Provide exactly one of table or query")
        ranged = [v is not None for v in (self.column, self.lower, self.upper, self.partitions)]
        if any(ranged) and not all(ranged):
            raise ValueError("column, lower, upper and partitions go together")
        if any(ranged) and self.predicates:
            raise ValueError("Use predicates or a column range, not both")
        if self.fetch_rows < 1:
            raise ValueError("fetch_rows must be at least 1")

    @property
    def relation(self) -> str:
        return self.table or f"({self.query}) src"

    @property
    def windowed(self) -> bool:
        return {marker[1] for marker in _WINDOW_MARKER.finditer(self.query or "")} == {"watermark_prev", "watermark_now"}

    def scalar(self, spark: SparkSession, query: str, values: dict[str, Any] | None = None) -> str | None:
        """First column of the first row of ``query``, which the database runs, as text."""
        asked = f"({_with_bounds(query, values or {})}) bound"
        return first_text(spark.read.jdbc(self.url, asked, properties=self.connection_properties()))

    def upper_bound(self, spark: SparkSession, column: str) -> str | None:
        """``MAX(column)``, taken in the database: one row is read instead of the column."""
        return self.scalar(spark, f"SELECT MAX({column}) AS bound_value FROM {self.relation}")

    def connection_properties(self) -> dict[str, str]:
        return {"pushDownPredicate": "true", **self.properties, "fetchsize": str(self.fetch_rows)}

    def load(self, spark: SparkSession, run_values=None) -> DataFrame:
        relation = _with_bounds(self.relation, dict(run_values or {}))
        if self.predicates:
            return spark.read.jdbc(
                self.url, relation, predicates=list(self.predicates), properties=self.connection_properties()
            )
        if self.column is not None:
            return spark.read.jdbc(
                self.url,
                relation,
                column=self.column,
                lowerBound=self.lower,
                upperBound=self.upper,
                numPartitions=self.partitions,
                properties=self.connection_properties(),
            )
        if not self.one_task:
            raise ValueError("give predicates or a column range to read in parallel, or one_task=True")
        return spark.read.jdbc(self.url, relation, properties=self.connection_properties())
