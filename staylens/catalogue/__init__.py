"""Every operator as a query over the benchmark tables, with comparison SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("silver_queries", "page_queries", "value_queries", "lake_queries")


def entries() -> dict:
    """name -> (callable(spark, sf_dir), SQL text or None)."""
    merged: dict = {}
    for module in _MODULES:
        merged.update(import_module(f"{__name__}.{module}").QUERIES)
    return merged
