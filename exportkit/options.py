"""Option records shared by the sources, sinks and the export job."""

from __future__ import annotations

from dataclasses import dataclass

MIB = 1024 * 1024

# Accepted codec names, mapped to the names Spark's Parquet writer takes.
# "lz4" is the framed LZ4_RAW codec, because the older Hadoop framing is not readable elsewhere.
PARQUET_CODECS = {
    "zstd": "zstd",
    "snappy": "snappy",
    "gzip": "gzip",
    "lz4": "lz4_raw",
    "none": "uncompressed",
}

# Accepted timestamp units. None switches coercion off.
TIMESTAMP_UNITS = ("s", "ms", "us")

# Formats a bulk unload may write, each with its usual codec.
UNLOAD_FORMATS = {"parquet": "zstd", "csv": "gzip", "json": "gzip"}


@dataclass(frozen=True)
class ParquetOptions:
    """How Parquet files are encoded.

    ``statistics`` is on by default: Spark and most readers prune row groups with it.
    """

    compression: str = "zstd"
    row_group_rows: int = 512_000
    coerce_timestamps: str | None = "ms"
    statistics: bool = True
    dictionary: bool = True

    def __post_init__(self):
        if self.compression not in PARQUET_CODECS:
            raise ValueError(
                f"compression must be one of {', '.join(PARQUET_CODECS)}, got {self.compression!r}"
            )
        if self.row_group_rows < 1:
            raise ValueError("row_group_rows must be at least 1")
        if self.coerce_timestamps is not None and self.coerce_timestamps not in TIMESTAMP_UNITS:
            raise ValueError(
                f"coerce_timestamps must be None or one of {', '.join(TIMESTAMP_UNITS)}, "
                f"got {self.coerce_timestamps!r}"
            )

    def writer_options(self) -> dict[str, str]:
        return {
            "compression": PARQUET_CODECS[self.compression],
            "parquet.block.row.count.limit": str(self.row_group_rows),
            "parquet.column.statistics.enabled": str(self.statistics).lower(),
            "parquet.enable.dictionary": str(self.dictionary).lower(),
        }


@dataclass(frozen=True)
class LayoutOptions:
    """How rows are spread over files.

    ``target_file_bytes`` is the shuffle size AQE aims at when it rebalances rows by their
    output directory: a directory larger than that is split over several tasks (so one hot
    shard never lands in one task), smaller ones become one file each. ``shuffle=False``
    skips the exchange for sources that are already split by directory, such as a JDBC read
    with one predicate per shard. ``spread`` deals the rows of an unsharded export out to all
    cores before they are encoded: for sources that few tasks read, such as one JDBC
    connection or one file that cannot be split.

    AQE splits a directory between the tasks that feed it, but not what one task gives to it. With
    ``hot_rows`` the rows per directory are counted first (a pass over the directory columns alone), and
    those of a directory that has more are dealt out by their position, ``hot_rows`` to a part.
    """

    target_file_bytes: int = 256 * MIB
    max_records_per_file: int = 0
    shuffle: bool = True
    spread: bool = False
    hot_rows: int = 0

    def __post_init__(self):
        if self.hot_rows < 0:
            raise ValueError("hot_rows must not be negative")
        if self.target_file_bytes < 1:
            raise ValueError("target_file_bytes must be positive")
        if self.max_records_per_file < 0:
            raise ValueError("max_records_per_file must not be negative")


@dataclass(frozen=True)
class UnloadOptions:
    """Bulk unload: files of about ``max_file_bytes``, no shards.

    ``single`` asks for as few files as that size allows: one for a result below it, a
    sequence of files above it, so that no task ever holds everything. ``spread`` deals rows
    out to all cores first, which is also what cuts the files to size; without it every task
    writes the rows it has.
    """

    format: str = "parquet"
    compression: str | None = None
    header: bool = True
    max_file_bytes: int = 256 * MIB
    single: bool = False
    order_by: tuple[str, ...] = ()
    spread: bool = True
    overwrite: bool = True

    def __post_init__(self):
        if self.format not in UNLOAD_FORMATS:
            raise ValueError(f"format must be one of {', '.join(UNLOAD_FORMATS)}, got {self.format!r}")
        if self.max_file_bytes < 1:
            raise ValueError("max_file_bytes must be positive")

    @property
    def codec(self) -> str:
        name = self.compression or UNLOAD_FORMATS[self.format]
        return "uncompressed" if name == "none" and self.format != "parquet" else name
