"""Queries over the given tables, grouped by layer."""

from importlib import import_module

from starloom.catalog.registry import ORACLES, QUERIES

_MODULES = ("staging", "loads", "star", "checks", "faults", "profiles")


def _load() -> None:
    for name in _MODULES:
        import_module(f"starloom.catalog.{name}")


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLES)
