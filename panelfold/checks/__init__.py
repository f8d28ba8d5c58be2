"""Registered queries: each runs a library operator over the given tables, next to the SQL it must equal."""

from __future__ import annotations

from importlib import import_module

MODULES = ("cleaning", "joining", "statistics", "reporting", "loading", "storing", "viewing", "modelling")


def all_queries():
    """(queries, oracles) of every query module."""
    from panelfold.checks.registry import ORACLES, QUERIES

    for m in MODULES:
        import_module(f"panelfold.checks.{m}")
    return dict(QUERIES), dict(ORACLES)
