"""Runnable queries over the test tables, each with SQL that must give the same rows."""

from importlib import import_module

from vialume.plans.registry import REGISTRY, Query

MODULES = ("traffic", "vision", "labels", "learning", "streams")


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"vialume.plans.{name}")
    return dict(REGISTRY)
