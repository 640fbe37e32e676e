"""Batch transforms written against ``pyarrow.Table``, run by Spark inside the tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

TableFn = Callable[[pa.Table], "pa.Table | None"]

# Functions of this package travel to the tasks with the query, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])


def output_schema(schema: StructType, fn: TableFn) -> StructType:
    """Schema of ``fn``'s result, found by running it on a table of zero rows."""
    result = fn(to_arrow_schema(schema).empty_table())
    if result is None:
        return schema
    return from_arrow_schema(result.schema, prefer_timestamp_ntz=True)


def _pieces(table: pa.Table, keep: Sequence[str]) -> Iterator[pa.Table]:
    """``table`` cut into pieces in which every ``keep`` column is constant, by one sort."""
    if not keep or not table.num_rows:
        yield table
        return
    codes = [table.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices for k in keep]
    codes = np.array([c.to_numpy(zero_copy_only=False) for c in codes])
    order = np.lexsort(codes)
    table, codes = table.take(pa.array(order)), codes[:, order]
    edges = np.flatnonzero((np.diff(codes, axis=1) != 0).any(axis=0)) + 1
    bounds = [0, *edges.tolist(), table.num_rows]
    for start, end in zip(bounds, bounds[1:]):
        yield table.slice(start, end - start)


def _unchanged(column: pa.ChunkedArray, value: pa.Scalar) -> bool:
    if not value.is_valid:
        return column.null_count == len(column)
    return column.null_count == 0 and bool(pc.all(pc.equal(column, value), min_count=0).as_py())


def arrow_batches(
    df: DataFrame,
    fn: TableFn,
    schema: StructType | None = None,
    keep: Sequence[str] = (),
    hide: Sequence[str] | None = None,
) -> DataFrame:
    """Run ``fn`` on Arrow batches; it may change columns and the number of rows.

    ``None`` or an empty table drops the batch. An error stops the job and names the
    partition. ``schema`` is derived from a dry run on zero rows unless given. Columns in
    ``keep`` (the shard columns of an export) go through unchanged: batches are cut where
    they change and the values are put back behind the result. Those in ``hide`` (default:
    all of them) are not shown to ``fn``; the others it may read and drop, but not alter.
    """
    hidden = [k for k in keep if hide is None or k in hide]
    seen = StructType([f for f in df.schema if f.name not in hidden])
    target = schema if schema is not None else output_schema(seen, fn)
    target = StructType([f for f in target if f.name not in keep])
    arrow_target = to_arrow_schema(target)
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(pa.Table.from_batches([batch]), kept):
                try:
                    result = fn(piece.drop_columns(hidden) if hidden else piece)
                    for k in set(kept) - set(hidden):
                        if result is not None and k in result.column_names and piece.num_rows:
                            if not _unchanged(result.column(k), piece.column(k)[0]):
                                raise ValueError(f"shard column {k!r} must come back unchanged")
                except Exception as error:
                    where = f"partition {TaskContext.get().partitionId()}"
                    if kept and piece.num_rows:
                        where += "".join(f", {k}={piece.column(k)[0].as_py()}" for k in kept)
                    raise RuntimeError(f"batch transform raised on {where}: {error}") from error
                if result is None or not result.num_rows:
                    continue
                result = result.select(arrow_target.names).cast(arrow_target)
                for k in kept:
                    value = piece.column(k)[0]
                    result = result.append_column(k, pa.repeat(value, result.num_rows))
                yield from result.to_batches()

    return df.mapInArrow(run, StructType(list(target) + [df.schema[k] for k in kept]))


@dataclass(frozen=True)
class BatchTransform:
    """An Arrow transform as a step of an export job."""

    fn: TableFn
    schema: StructType | None = None

    def apply(self, df: DataFrame, keep: Sequence[str] = (), hide: Sequence[str] | None = None) -> DataFrame:
        return arrow_batches(df, self.fn, self.schema, keep, hide)
