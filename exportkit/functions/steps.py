"""The transform steps of an export, in order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from .arrow import BatchTransform

Step = Callable[[DataFrame], DataFrame] | BatchTransform


def apply_steps(
    df: DataFrame, steps: Sequence[Step], keep: Sequence[str] = (), hide: Sequence[str] | None = None
) -> DataFrame:
    """Run DataFrame functions and batch transforms; the latter leave the ``keep`` columns as they are
    and do not see those in ``hide`` (default: all of ``keep``)."""
    for step in steps:
        df = step.apply(df, keep, hide) if isinstance(step, BatchTransform) else df.transform(step)
    return df
