"""Operators of a training-data pipeline, one module each; ``queries`` applies them to whole tables."""

from .queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
