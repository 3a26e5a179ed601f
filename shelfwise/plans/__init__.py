"""Bindings of the operators to the given tables, with their SQL equivalents."""

from __future__ import annotations


def all_queries() -> tuple[dict, dict]:
    """Every registered query and SQL text."""
    from shelfwise.plans import events, landed, models, products, rules, streams, trends  # noqa: F401
    from shelfwise.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
