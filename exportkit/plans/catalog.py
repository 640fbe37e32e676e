"""Catalog of everything that landed, and the JSON manifest published from it.

The catalog is a Parquet table partitioned by job and run, written by Spark; it is the source
of truth. Every attempt of a run writes to a folder of its own, and the catalog entry, one file that
appears at once, is the switch that makes it the current one: no data is renamed, and readers of the
attempt before keep their files until they are pruned. A manifest is a document for readers without
Spark, published last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.cut import listed
from ..operators.inventory import INVENTORY_SCHEMA
from ..operators.shards import SHARD
from ..session import (
    delete_path,
    hadoop_path,
    path_exists,
    qualify,
    read_text,
    small_table,
    with_settings,
    write_text_atomically,
)

CATALOG_SCHEMA = f"{INVENTORY_SCHEMA}, path string, folder string, exported_at timestamp, job string, run_id string"

# Manifest format version and file name.
MANIFEST_VERSION = 1
MANIFEST_NAME = "_manifest.json"

SNAPSHOT_NAME = "_snapshot.json"
LOG_FILE = "log_file"

MANIFEST_DOCUMENT = (
    "version int, exported_at string, total_rows bigint, total_bytes bigint, files array<struct<"
    "shard_index: int, remote_uri: string, rows: bigint, bytes: bigint, md5: string, skipped: boolean>>"
)


class Catalog:
    """File entries of all runs of all jobs below ``root``. Append-only.

    ``uri`` is spelled as Spark spells ``_metadata.file_path`` (percent-escaped), so that it
    can be joined with scans; manifests hold the plain form.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.path = f"{self.root}/files"

    def entries(self) -> DataFrame:
        """All entries: those of the last snapshot, and of the log files that came since."""
        return self._recorded().drop(LOG_FILE)

    def _recorded(self) -> DataFrame:
        """The entries, each with the log file it came from."""
        snapshot, log = self._snapshot(), self._log()
        if snapshot is None:
            return log
        return snapshot.unionByName(log.join(snapshot.select(LOG_FILE).distinct(), LOG_FILE, "left_anti"))

    def _log(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return small_table(self.spark, [], f"{CATALOG_SCHEMA}, {LOG_FILE} string")
        found = self.spark.read.schema(CATALOG_SCHEMA).parquet(self.path)
        return found.withColumns({"folder": F.coalesce("folder", "path"), LOG_FILE: F.col("_metadata.file_path")})

    def _head(self) -> dict[str, Any]:
        place = f"{self.root}/{SNAPSHOT_NAME}"
        return json.loads(read_text(self.spark, place)) if path_exists(self.spark, place) else {}

    def _snapshot(self) -> DataFrame | None:
        name = self._head().get("snapshot")
        if name is None:
            return None
        return self.spark.read.schema(f"{CATALOG_SCHEMA}, {LOG_FILE} string").parquet(f"{self.root}/{name}")

    def compact(self) -> int:
        """Merge the entries of all runs into a few files; returns how many log files they replace.

        The new snapshot takes effect by one small document. Log files that it covers are no longer read,
        and what the compaction before replaced is removed now, so that readers which began before a
        compaction still find their files. Runs may go on meanwhile: their entries stay in the log.
        """
        before, snapshot, log = self._head(), self._snapshot(), self._log()
        name = f"snapshot-{uuid.uuid4().hex}"
        dealt = self._recorded().hint("rebalance", "job", "path").sortWithinPartitions("job", "path", "exported_at")
        with with_settings(dealt, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}) as out:
            out.write.parquet(f"{self.root}/{name}")
        covered = log.select(LOG_FILE).distinct().count()
        head = {"snapshot": name, "before": before.get("snapshot")}
        write_text_atomically(self.spark, f"{self.root}/{SNAPSHOT_NAME}", [json.dumps(head)])
        if before:
            old = snapshot.select(LOG_FILE).distinct()
            for row in old.toLocalIterator():
                fs, file = hadoop_path(self.spark, unquote(row[LOG_FILE]))
                fs.delete(file, False)
                if fs.exists(file.getParent()) and not fs.listStatus(file.getParent()):
                    fs.delete(file.getParent(), False)
            if before.get("before"):
                delete_path(self.spark, f"{self.root}/{before['before']}")
        return covered

    def append(
        self,
        job: str,
        run_id: str,
        path: str,
        inventory: DataFrame,
        exported_at: datetime | None = None,
        folder: str | None = None,
    ) -> datetime:
        """Record one attempt of a run, whose files lie in ``folder`` (default: ``path`` itself).

        A repeated run adds a newer attempt. The entries go to one file, so that they all appear at
        once; there is one entry per data file.
        """
        when = exported_at or datetime.now(timezone.utc)
        stamped = inventory.withColumns(
            {
                "path": F.lit(qualify(self.spark, path)),
                "folder": F.lit(qualify(self.spark, folder or path)),
                "exported_at": F.lit(when.isoformat()).cast("timestamp"),
                "job": F.lit(job),
                "run_id": F.lit(run_id),
            }
        )
        with with_settings(stamped.coalesce(1), {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}) as out:
            out.write.mode("append").partitionBy("job", "run_id").parquet(self.path)
        return when

    def run(self, job: str, run_id: str) -> DataFrame:
        """Entries of a run: its newest attempt."""
        attempts = self.entries().filter((F.col("job") == job) & (F.col("run_id") == run_id))
        return attempts.filter(F.col("exported_at") == attempts.agg(F.max("exported_at")).scalar())

    def current(self, job: str | None = None, path: str | None = None) -> DataFrame:
        """Entries that describe what lies in the export paths now, skipped ones left out.

        A full run replaces its whole path; a run that skipped shards replaces only the
        shards it wrote. Everything older is gone from the path and from this view. ``job`` and
        ``path`` limit the history that is read.
        """
        entries = self.entries()
        if job is not None:
            entries = entries.filter(F.col("job") == job)
        if path is not None:
            entries = entries.filter(F.col("path") == qualify(self.spark, path))
        place = ["job", "path"]
        attempts = entries.groupBy(*place, "exported_at").agg(F.max("skipped").alias("partial"))
        since = attempts.filter(~F.col("partial")).groupBy(*place).agg(F.max("exported_at").alias("since"))
        data = entries.filter(~F.col("skipped")).join(since, place).filter(F.col("exported_at") >= F.col("since"))
        newest = data.groupBy(*place, SHARD).agg(F.max("exported_at").alias("exported_at"))
        return data.drop("since").join(newest, [*place, SHARD, "exported_at"], "left_semi").select(*entries.columns)

    def latest_files(self, job: str | None = None, path: str | None = None) -> DataFrame:
        """The cumulative catalog: every data file that is in place, over all jobs and runs."""
        return self.current(job, path).filter(F.col("uri") != "")

    def run_files(self, job: str, run_id: str) -> DataFrame:
        """Files that make up a run, with true row counts also for skipped shards.

        Raises ``ValueError`` when a later run has replaced some of them: what is left would be
        less than the run wrote.
        """
        own = self.run(job, run_id).filter(F.col("uri") != "")
        here = self.latest_files(job)
        gone = own.join(here.select("uri"), "uri", "left_anti").agg(
            F.count("*").alias("files"), F.max("path").alias("path"), F.max("exported_at").alias("at")
        )
        lost = gone.first()
        if lost["files"]:
            later = self.entries().filter((F.col("job") == job) & (F.col("path") == lost["path"]))
            newer = later.filter(F.col("exported_at") > F.lit(lost["at"])).agg(F.max_by("run_id", "exported_at")).first()[0]
            raise ValueError(f"{lost['files']} files of run {run_id!r} of {job!r} were replaced by run {newer!r}")
        return here.join(own.select("uri"), "uri", "left_semi")

    def files_in(self, job: str, path: str) -> DataFrame:
        """Current entries of one export path."""
        return self.latest_files(job, path)

    def folder_of(self, job: str, path: str) -> str | None:
        """Where the current files of an export path lie: the folder of its newest attempt."""
        found = self.current(job, path).agg(F.max_by("folder", "exported_at")).first()[0]
        return found if found is None or path_exists(self.spark, found) else None

    def landed_shards(self, job: str, path: str, folder: str | None = None) -> list[int]:
        """Shards of ``job`` that are complete under ``path``; as long as the shard layout.

        A shard counts when its newest recorded attempt wrote files and all of them are
        still there, so neither leftovers of a crashed write nor stale entries pass.
        """
        folder = folder or self.folder_of(job, path)
        if folder is None:
            return []
        present = listed(self.spark, folder).select("uri", F.lit(True).alias("there"))
        complete = (
            self.files_in(job, path)
            .join(present, "uri", "left")
            .groupBy(SHARD)
            .agg(F.count("there").alias("found"), F.count("uri").alias("recorded"))
            .filter("found = recorded")
        )
        return sorted(r[SHARD] for r in complete.collect())

    def prune(self, job: str, path: str, keep: int = 1) -> list[str]:
        """Remove the folders of replaced attempts, but for the ``keep`` newest of them, whose readers may
        not have finished. Returns the folders removed."""
        place = qualify(self.spark, path)
        own = self.entries().filter((F.col("job") == job) & (F.col("path") == place) & (F.col("folder") != place))
        newest = own.groupBy("folder").agg(F.max("exported_at").alias("at")).orderBy(F.desc("at"))
        old = [r["folder"] for r in newest.offset(keep + 1).collect()]
        return [folder for folder in old if delete_path(self.spark, folder)]


def latest_per_uri(entries: DataFrame) -> DataFrame:
    """The newest entry of every file over several manifests (``read_manifest``)."""
    newest = Window.partitionBy("uri").orderBy(F.desc("exported_at"))
    data = entries.filter((F.col("uri") != "") & ~F.col("skipped"))
    return data.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def read_files(files: DataFrame, base: str, schema: StructType, verify: bool = True) -> DataFrame:
    """Rows of the files listed by ``Catalog.run_files``, not of whatever lies in a folder.

    ``base`` is the folder of the run (the ``path`` of its result), so that partition columns are found;
    where the list names the folder itself, as ``Catalog.run_files`` does, that one is taken.
    The list stays a table: it is compared with what lies in the folder, and rows of files that it does
    not name, if there are any, are left out by a join on the file they come from. A listed file that is
    gone is a ``ValueError``. ``verify`` compares the row total with the catalog (footers only).
    """
    spark = files.sparkSession
    places = F.collect_set("folder") if "folder" in files.columns else F.array().cast("array<string>")
    total = files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), places.alias("folders")
    ).first()
    if total["files"] == 0:
        return small_table(spark, [], schema)
    if len(total["folders"]) > 1:
        raise ValueError(f"the files lie in {len(total['folders'])} folders: read the runs one by one")
    base = total["folders"][0] if total["folders"] else base
    named = files.select("uri").distinct().withColumn("named", F.lit(True))
    both = listed(spark, base).select("uri", F.lit(True).alias("there")).join(named, "uri", "full_outer")
    odd = both.agg(F.count_if(F.isnull("named")).alias("strangers"), F.count_if(F.isnull("there")).alias("gone")).first()
    if odd["gone"]:
        raise ValueError(f"{odd['gone']} files that the catalog lists are not below {base}")
    data = spark.read.schema(schema).option("basePath", base).parquet(base)
    if odd["strangers"]:
        own = F.col("_metadata.file_path")
        data = data.withColumn("_uri", own).join(named.select(F.col("uri").alias("_uri")), "_uri", "left_semi").drop("_uri")
    if verify:
        found = data.count()
        if found != total["rows"]:
            raise ValueError(f"catalog lists {total['rows']} rows, files hold {found}")
    return data


# -------------------------------------------------------------------- manifest


def manifest_location(path: str | None, explicit: str | None = None) -> str | None:
    """Where a run's manifest goes: the explicit path, else inside the export path."""
    if explicit:
        return explicit
    return f"{path.rstrip('/')}/{MANIFEST_NAME}" if path else None


def plain_uri(column: str) -> Column:
    """A catalog URI without percent escapes: the name the store itself uses."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def manifest_files(entries: DataFrame) -> DataFrame:
    return entries.select(SHARD, plain_uri("uri").alias("remote_uri"), "rows", "bytes", "md5", "skipped")


def publish(
    entries: DataFrame, location: str, exported_at: datetime | None = None, extra: dict[str, Any] | None = None
) -> dict[str, Any]:
    """Write the manifest of one run's entries; returns the document without its ``files``.

    Files are sorted by shard, one to a line. They pass through the driver one partition at a time and
    are never held together, so a manifest has one format and may have any length.
    """
    spark = entries.sparkSession
    files = manifest_files(entries)
    totals = files.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "bytes")]).first()
    head: dict[str, Any] = {
        "version": MANIFEST_VERSION,
        "exported_at": (exported_at or datetime.now(timezone.utc)).isoformat(),
        "total_rows": totals["rows"],
        "total_bytes": totals["bytes"],
    }
    if extra:
        head["extra"] = extra

    def lines() -> Iterator[str]:
        yield json.dumps(head, indent=2).removesuffix("\n}") + ',\n  "files": ['
        between = "\n    "
        for row in files.orderBy(SHARD, "remote_uri").toLocalIterator():
            yield between + json.dumps(row.asDict())
            between = ",\n    "
        yield "\n  ]\n}\n"

    write_text_atomically(spark, location, lines())
    return head


def read_manifest(spark: SparkSession, location: str) -> DataFrame:
    """File entries of a published manifest, also one from elsewhere, with its time stamp."""
    text = read_text(spark, location)
    head = json.loads(text)
    stamp = F.lit(head["exported_at"]).cast("timestamp").alias("exported_at")
    document = small_table(spark, [(text,)], "text string").select(F.from_json("text", MANIFEST_DOCUMENT).alias("m"))
    return document.select(F.explode("m.files").alias("file")).select("file.*", stamp)
