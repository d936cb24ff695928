"""Queries over the test tables, each next to its SQL counterpart."""

from checks import basics, loads, marts, quality, staging, streams, upkeep, vault  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
