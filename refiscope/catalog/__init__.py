"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import importlib

MODULES = ["silver_queries", "gold_queries", "frame_queries", "risk_queries", "table_queries", "model_queries"]


def load():
    """Import every query module once; returns (queries, sql)."""
    from . import registry

    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return registry.QUERIES, registry.SQL
