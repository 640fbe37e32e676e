from .cut import file_place, listed
from .difference import differing_rows
from .fingerprint import fingerprint
from .footers import file_facts, footers, landed_schemas, with_facts
from .inventory import ExportInvalid, file_md5, files, landed_files, reconcile, require_valid, validate
from .shards import (
    DAY_COLUMNS,
    SHARD,
    CrossShards,
    ModShards,
    PredicateShards,
    RangeShards,
    Shards,
    SingleShard,
    ValueShards,
    coverage,
    day_columns,
    day_slice,
    equal_depth_shards,
)
from .sink import Written, checked_path, read_export, unload, write_export
from .windows import Bounds, first_run_value, latest_per_key, upper_bound, window

__all__ = [
    "DAY_COLUMNS",
    "SHARD",
    "Bounds",
    "CrossShards",
    "ExportInvalid",
    "ModShards",
    "PredicateShards",
    "RangeShards",
    "Shards",
    "SingleShard",
    "ValueShards",
    "Written",
    "checked_path",
    "coverage",
    "day_columns",
    "day_slice",
    "differing_rows",
    "equal_depth_shards",
    "file_facts",
    "file_md5",
    "file_place",
    "files",
    "fingerprint",
    "first_run_value",
    "footers",
    "landed_files",
    "landed_schemas",
    "latest_per_key",
    "listed",
    "read_export",
    "reconcile",
    "require_valid",
    "unload",
    "upper_bound",
    "validate",
    "window",
    "with_facts",
    "write_export",
]
