"""SQL sources. Any statement Spark SQL accepts is a valid export source."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import as_text


@dataclass(frozen=True)
class SqlSource:
    """A literal ``query`` or a ``template`` with ``:name`` markers, exactly one of them.

    A literal query is sent as it is: neither parameters nor window bounds reach it. A
    template's markers are *bound* (never pasted into the text); ``IDENTIFIER(:name)``
    binds table and column names. A marker without a value is an analysis error.
    Precedence, lowest first: ``defaults`` < ``params`` < values given by the run.
    """

    query: str | None = None
    template: str | None = None
    params: dict[str, Any] = field(default_factory=dict)
    defaults: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        if bool(self.query) == bool(self.template):
            raise ValueError("Provide exactly one of query or template")

    def load(self, spark: SparkSession, run_values: dict[str, Any] | None = None) -> DataFrame:
        if self.query:
            return spark.sql(self.query)
        return spark.sql(self.template, args={**self.defaults, **self.params, **(run_values or {})})


def scalar(spark: SparkSession, query: str, params: dict[str, Any] | None = None) -> str | None:
    """First column of the first row as text; no row or NULL gives ``None``.

    A ``TIMESTAMP`` carries its offset, so that the text means the same in every session.
    """
    return first_text(spark.sql(query, args=params) if params else spark.sql(query))


def first_text(result: DataFrame) -> str | None:
    """First column of the first row, as :func:`scalar` gives it."""
    named = result.toDF(*[f"c{i}" for i in range(len(result.columns))])
    row = named.select(as_text(F.col("c0"), named.schema["c0"].dataType.simpleString())).first()
    return None if row is None else row[0]
