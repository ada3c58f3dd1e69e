"""Queries on the supplied tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ("scalar_queries", "relational_queries", "graph_queries", "parser_queries", "resolution_queries")


def all_queries() -> tuple[dict, dict]:
    """All registered queries, and SQL for those that SQL can state."""
    for m in MODULES:
        import_module(f"calltrail.jobs.{m}")
    from calltrail.jobs.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
