from .catalog import (
    Catalog,
    latest_per_uri,
    manifest_location,
    publish,
    read_files,
    read_manifest,
)
from .job import ExportJob, Incremental, RunResult
from .runlog import RunLog
from .state import StateTable

__all__ = [
    "Catalog",
    "ExportJob",
    "Incremental",
    "RunLog",
    "RunResult",
    "StateTable",
    "latest_per_uri",
    "manifest_location",
    "publish",
    "read_files",
    "read_manifest",
]
