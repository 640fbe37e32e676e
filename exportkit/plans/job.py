"""One export run: window, skip probe, read, transform, write, check, publish, commit."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from string import Formatter
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.schema import align
from ..functions.steps import Step, apply_steps
from ..operators import inventory as inv
from ..operators import metrics
from ..operators.shards import SHARD, Shards, SingleShard
from ..operators.sink import Written, checked_path, unload, write_export
from ..operators.windows import FIRST_RUN, Bounds, first_run_value, fixed_text, upper_bound, window
from ..options import LayoutOptions, ParquetOptions, UnloadOptions
from ..session import delete_path, path_exists
from ..sources.jdbc import JdbcSource
from ..sources.sql import SqlSource, scalar
from .catalog import Catalog, manifest_location, publish
from .runlog import RunLog
from .state import StateTable

WINDOW_MARKERS = ("watermark_prev", "watermark_now")


@dataclass(frozen=True)
class Incremental:
    """Window of an incremental job.

    The upper bound comes from ``watermark_query`` (run before the export, by the database if
    the source is one), from ``now`` (a
    logical time), or, with ``column`` alone, from the column's maximum. With ``column`` the
    window is a filter on the source; without it the source template names the markers
    ``:watermark_prev`` and ``:watermark_now`` itself.
    """

    column: str | None = None
    watermark_query: str | None = None
    now: str | None = None
    default: str | None = None
    lateness: str | None = None

    def __post_init__(self):
        given = (self.watermark_query is not None) + (self.now is not None)
        if given > 1 or (given == 0 and self.column is None):
            raise ValueError("Provide exactly one of watermark_query or now, or a column to take the maximum of")
        if self.lateness and self.column is None:
            raise ValueError("lateness needs a window column")


@dataclass(frozen=True)
class RunResult:
    """Outcome of a run; the same figures are in the run log."""

    job: str
    run_id: str
    path: str
    schema: StructType | None
    shards: int
    skipped: tuple[int, ...]
    total_rows: int
    total_bytes: int
    elapsed_s: float
    watermark: str | None
    mode: str
    manifest: str | None


@dataclass(frozen=True)
class ExportJob:
    """Everything about an export except the run.

    ``path`` is relative to ``base`` and may hold ``{run_id}``, ``{watermark_prev}``, ``{watermark_now}``
    and the names of the run's values. Every attempt writes to a folder of its own below it (the ``path``
    of its result) that the catalog and the manifest point to once it is complete; ``keep_attempts``
    replaced ones stay for readers that have begun. ``catalog`` is the folder of the catalog, state and
    run-log tables. ``bulk`` switches from shards to a bulk unload.
    """

    name: str
    source: Any
    base: str
    catalog: str
    path: str = "{run_id}"
    shards: Shards = field(default_factory=SingleShard)
    partition_by: Sequence[str] = ()
    transforms: Sequence[Step] = ()
    target_schema: StructType | None = None
    incremental: Incremental | None = None
    parquet: ParquetOptions = field(default_factory=ParquetOptions)
    layout: LayoutOptions = field(default_factory=LayoutOptions)
    bulk: UnloadOptions | None = None
    overwrite: bool = True
    skip_existing: bool = False
    md5: bool = False
    check: str | None = "sample"
    manifest: bool = True
    manifest_path: str | None = None
    extra: dict[str, Any] = field(default_factory=dict)
    keep_attempts: int = 1

    def __post_init__(self):
        windowed = self.incremental is not None
        if windowed and isinstance(self.source, SqlSource):
            if self.source.query and self.incremental.column is None:
                raise ValueError("a literal query cannot see the window: use a template or a window column")
            if self.source.template and self.incremental.column is None:
                missing = [m for m in WINDOW_MARKERS if f":{m}" not in self.source.template]
                if missing:
                    raise ValueError(f"the template does not use :{missing[0]}")
        if windowed and self.incremental.column is None and not self._source_sees_window():
            raise ValueError("this source cannot see the window: give a window column")
        checked_path(self.base, self.path)

    def _source_sees_window(self) -> bool:
        if isinstance(self.source, SqlSource):
            return bool(self.source.template)
        return bool(getattr(self.source, "windowed", False))

    # ------------------------------------------------------------------ steps

    def run(self, spark: SparkSession, run_id: str, values: dict[str, Any] | None = None) -> RunResult:
        started = time.time()
        values = dict(values or {})
        catalog, state = Catalog(spark, self.catalog), StateTable(spark, self.catalog)
        shards = SingleShard() if self.bulk else self.shards

        bounds, had_plan = self._plan_window(spark, state, run_id, values)
        path = self._place(run_id, bounds, values)

        folder = catalog.folder_of(self.name, path)
        skipped = catalog.landed_shards(self.name, path, folder) if self.skip_existing and folder else []
        left = [s for s in range(shards.count) if s not in skipped]
        if not skipped:
            if not self.overwrite and path_exists(spark, path):
                raise FileExistsError(f"{path} already exists")
            folder = f"{path}/attempt-{uuid.uuid4().hex}"

        written, listing, cached = None, None, None
        if left:
            try:
                written = self._write(spark, folder, self._rows(spark, bounds, values), skipped, left)
                listing = inv.landed_files(spark, written, shards, md5=self.md5, only=left if skipped else None)
                listing = cached = listing.persist()
                if self.check:
                    inv.require_valid(inv.validate(spark, written, listing, level=self.check))
            except BaseException:
                if not skipped:  # nothing points to this attempt
                    delete_path(spark, folder)
                raise
        if skipped:
            untouched = catalog.files_in(self.name, path).filter(F.col(SHARD).isin(*skipped)).select(
                SHARD,
                "uri",
                F.lit(0).cast("bigint").alias("rows"),
                F.lit(0).cast("bigint").alias("bytes"),
                F.lit(None).cast("string").alias("md5"),
                F.lit(0.0).alias("elapsed_s"),
                F.lit(True).alias("skipped"),
            )
            listing = untouched if listing is None else listing.unionByName(untouched)

        exported_at = catalog.append(self.name, run_id, path, listing, folder=folder)
        location = self._publish(listing, path, written, exported_at)
        if bounds is not None and (left or had_plan):
            state.commit(self.name, run_id, bounds)

        mode = "unload" if self.bulk else "export"
        watermark = bounds.now if bounds else None
        summary = RunLog(spark, self.catalog).append(
            self.name, run_id, metrics.run_summary(listing, time.time() - started, watermark, mode)
        )
        if cached is not None:
            cached.unpersist()
        if not skipped:
            catalog.prune(self.name, path, self.keep_attempts)
        return RunResult(
            job=self.name,
            run_id=run_id,
            path=folder,
            schema=written.schema if written else None,
            skipped=tuple(skipped),
            manifest=location,
            **summary,
        )

    def _place(self, run_id: str, bounds: Bounds | None, values: dict[str, Any]) -> str:
        """The export path of a run: ``path`` with the run, the window and the run's values filled in."""
        known = {k: str(v) for k, v in values.items()} | {"run_id": run_id}
        if bounds is not None:
            known |= {"watermark_prev": bounds.prev, "watermark_now": bounds.now}
        named = {name for _, name, _, _ in Formatter().parse(self.path) if name}
        if missing := sorted(named - set(known)):
            raise ValueError(f"the path names {{{missing[0]}}}, which this run has no value for")
        return checked_path(self.base, self.path.format(**known))

    def _plan_window(self, spark, state: StateTable, run_id: str, values) -> tuple[Bounds | None, bool]:
        """The run's window, and whether an earlier attempt of the same run had planned it."""
        rule = self.incremental
        if rule is None:
            return None, False
        known, prev = state.lookup(self.name, run_id)
        if known is not None:
            return known, True
        type_name = "string"
        source = None
        if rule.column is not None:
            source = self.source.load(spark, values)
            type_name = source.schema[rule.column].dataType.simpleString()
        if prev is None:
            prev = rule.default
        if prev is None:
            prev = first_run_value(source.schema[rule.column].dataType) if source is not None else FIRST_RUN
        if rule.now is not None:
            now = rule.now
        elif rule.watermark_query is not None:
            params = {"watermark_prev": prev} if ":watermark_prev" in rule.watermark_query else None
            asked = self.source.scalar if isinstance(self.source, JdbcSource) else scalar
            now = asked(spark, rule.watermark_query, params)
        elif isinstance(self.source, JdbcSource):
            now = self.source.upper_bound(spark, rule.column)
        else:
            now = upper_bound(source, rule.column)
        prev, now = (fixed_text(spark, text, type_name) for text in (prev, prev if now is None else now))
        return state.record(self.name, run_id, Bounds(prev, now, type_name)), False

    def _rows(self, spark, bounds: Bounds | None, values) -> DataFrame:
        if bounds is not None:
            values = {**values, "watermark_prev": bounds.prev, "watermark_now": bounds.now}
            if not self._source_sees_window():
                values = {k: v for k, v in values.items() if k not in WINDOW_MARKERS}
        df = self.source.load(spark, values)
        if bounds is not None and self.incremental.column is not None:
            df = window(df, self.incremental.column, bounds, self.incremental.lateness)
        return df

    def _shape(self, df: DataFrame) -> DataFrame:
        keep = [] if self.bulk else list(self.shards.partition_columns)
        df = apply_steps(df, self.transforms, keep, hide=[SHARD])
        if self.target_schema is not None:
            named = self.target_schema.fieldNames()
            extra = [df.schema[c] for c in [*keep, *self.partition_by] if c not in named]
            df = align(df, StructType([*self.target_schema, *extra]))
        return df

    def _write(self, spark, path: str, df: DataFrame, skipped: list[int], left: list[int]) -> Written:
        if self.bulk is not None:
            return unload(self._shape(df), path, self.bulk, checksum=self.check == "full")
        # Files of a shard that the catalog does not know are leftovers of a failed attempt.
        # (A single unsharded directory is replaced as a whole.)
        if skipped:
            for directory in filter(None, map(self.shards.directory, left)):
                delete_path(spark, f"{path}/{directory}")
        # Shards are cut on the source columns, before the transforms: the shard filter
        # reaches the scan, and transforms only see rows that will be written.
        return write_export(
            df,
            path,
            self.shards,
            partition_by=self.partition_by,
            only=left if skipped else None,
            shape=self._shape,
            parquet=self.parquet,
            layout=self.layout,
            mode="overwrite" if self.overwrite or skipped else "errorifexists",
            keep_other_partitions=bool(skipped),
            checksum=self.check == "full",
        )

    def _publish(self, entries: DataFrame, path: str, written: Written | None, exported_at) -> str | None:
        if not self.manifest:
            return None
        location = manifest_location(path, self.manifest_path)
        extra = dict(self.extra)
        if written is not None:
            extra["schema"] = written.schema.json()
        publish(entries, location, exported_at, extra)
        return location
