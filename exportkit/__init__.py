"""Export engine on Spark: run a query, cut it into shards, mask and align the rows, land
files, prove what landed, and move an incremental window forward."""

from .options import LayoutOptions, ParquetOptions, UnloadOptions
from .plans import Catalog, ExportJob, Incremental, RunLog, RunResult, StateTable
from .sources import FrameSource, JdbcSource, SqlSource
from .streaming import StreamExport

__all__ = [
    "Catalog",
    "ExportJob",
    "FrameSource",
    "Incremental",
    "JdbcSource",
    "LayoutOptions",
    "ParquetOptions",
    "RunLog",
    "RunResult",
    "SqlSource",
    "StateTable",
    "StreamExport",
    "UnloadOptions",
]
