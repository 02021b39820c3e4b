"""The registered queries: each operator on the given tables, next to the SQL that checks it."""

from . import integrity, layout, loads, lookups, parsing, parties, runs, storage, tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
