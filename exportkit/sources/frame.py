"""Source given by a function that builds a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class FrameSource:
    """Anything the DataFrame API can read or compute. ``build`` runs once per export.

    With ``windowed``, ``build`` takes the run's values as a second argument and applies the bounds
    ``watermark_prev`` and ``watermark_now`` itself (both are missing while the job looks up the
    column's type or maximum).
    """

    build: Callable[..., DataFrame]
    windowed: bool = False

    def load(self, spark: SparkSession, run_values=None) -> DataFrame:
        return self.build(spark, dict(run_values or {})) if self.windowed else self.build(spark)
