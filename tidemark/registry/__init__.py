"""Named queries over the standard tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import importlib

from tidemark.registry import core

_MODULES = ("marts", "reports", "quality", "changes", "streams", "access", "batches", "features")


def load() -> tuple[dict, dict]:
    """Import every query module and return (queries, sql)."""
    for module in _MODULES:
        importlib.import_module(f"tidemark.registry.{module}")
    return core.QUERIES, core.SQL
