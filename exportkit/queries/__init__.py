"""Registered queries and the SQL each one is checked against."""

from . import incremental, reports, shards, sinks, sources, transforms

_MODULES = (sources, shards, incremental, transforms, sinks, reports)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: text for module in _MODULES for name, text in module.ORACLE.items()}

__all__ = ["ORACLE", "QUERIES"]
