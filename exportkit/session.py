"""Session helpers: recommended settings, scoped settings, scratch space, Hadoop paths."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Settings an export session should run with. All of them can be changed at run time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Parts of a document that go to the store in one call.
PARTS_AT_ONCE = 4_096


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few driver-side rows as a local relation: part of the plan, no job to build it."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


@contextmanager
def conf_scope(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply runtime settings for the actions inside the block, then put the old ones back.

    For a session that nothing else uses meanwhile; :func:`with_settings` suits those that are shared.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def with_settings(df: DataFrame, settings: dict[str, str]) -> Iterator[DataFrame]:
    """The same rows in a session of their own that has ``settings``; the caller's session keeps its own.

    Sessions of one application share tables, caches and the global views that carry a plan from one to
    the other, but no settings: exports that run side by side cannot change each other's.
    """
    spark = df.sparkSession
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    view = f"exportkit_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        yield other.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


# Folders of local sessions that name none, by application.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local session without the setting falls back to a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="exportkit-")
    return _local_dirs[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_dir(spark)}/exportkit/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """``(filesystem, path)`` of the Hadoop filesystem that owns ``path``."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.delete(jpath, True)


def qualify(spark: SparkSession, path: str) -> str:
    """Full URI of ``path``, in the spelling Spark uses for ``_metadata.file_path``."""
    fs, jpath = hadoop_path(spark, path)
    return fs.makeQualified(jpath).toString()


def write_text_atomically(spark: SparkSession, path: str, text: Iterable[str]) -> None:
    """Write a document, in parts of any number, under a temporary name, then rename it over the target
    in one step."""
    fs, target = hadoop_path(spark, path)
    jvm = spark._jvm
    staged = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        stream = fs.create(staged, True)
        try:
            held: list[str] = []
            for part in [text] if isinstance(text, str) else text:
                held.append(part)
                if len(held) == PARTS_AT_ONCE:
                    stream.write(bytearray("".join(held).encode("utf-8")))
                    held = []
            stream.write(bytearray("".join(held).encode("utf-8")))
        finally:
            stream.close()
        context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)
    except Exception:
        fs.delete(staged, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small document, also one whose name starts with ``_`` (hidden from Spark scans)."""
    fs, jpath = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
