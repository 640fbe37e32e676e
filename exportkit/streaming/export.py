"""Continuous incremental export: every run takes the files that arrived since the last one.

The stream's checkpoint is the window state, so no watermark column is needed. Batches are
written to their own directory in overwrite mode: a batch that is replayed after a failure
replaces its first attempt, which makes the export exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.steps import Step, apply_steps
from ..operators import inventory as inv
from ..operators.shards import SHARD, Shards, SingleShard
from ..operators.sink import write_export
from ..options import LayoutOptions, ParquetOptions
from ..plans.catalog import Catalog


# Longer than any file is old; Spark's own limit is a week, and older files are never read.
ANY_AGE = "36500d"


@dataclass(frozen=True)
class StreamExport:
    """Export of a growing folder of Parquet files.

    ``checkpoint`` must be on storage that all executors share. ``max_files`` bounds one
    micro-batch; a run still takes everything there is, in several batches.
    """

    name: str
    source: str
    schema: StructType
    base: str
    catalog: str
    checkpoint: str
    shards: Shards = field(default_factory=SingleShard)
    transforms: Sequence[Step] = ()
    parquet: ParquetOptions = field(default_factory=ParquetOptions)
    layout: LayoutOptions = field(default_factory=LayoutOptions)
    max_files: int = 1_000

    def _batch(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        written = write_export(
            df,
            f"{self.base.rstrip('/')}/batch={batch_id}",
            self.shards,
            shape=partial(apply_steps, steps=self.transforms, keep=self.shards.partition_columns, hide=[SHARD]),
            parquet=self.parquet,
            layout=self.layout,
        )
        listing = inv.landed_files(spark, written, self.shards).persist()
        inv.require_valid(inv.validate(spark, written, listing))
        Catalog(spark, self.catalog).append(self.name, f"batch-{batch_id}", written.path, listing)
        listing.unpersist()

    def run(self, spark: SparkSession) -> list[int]:
        """Export what is new, then stop. Returns the batches this run wrote."""
        done: list[int] = []

        def each(df: DataFrame, batch_id: int) -> None:
            self._batch(df, batch_id)
            done.append(batch_id)

        query = (
            spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", self.max_files)
            .option("maxFileAge", ANY_AGE)  # files that were copied or restored come with old times
            .parquet(self.source)
            .writeStream.foreachBatch(each)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return done
