"""All catalog queries by name, with their DuckDB equivalents."""

from __future__ import annotations

from . import hubs_trees, links_streams, resolve_quality, search_rollup, staging
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "hubs_trees", "links_streams", "resolve_quality", "search_rollup", "staging"]
