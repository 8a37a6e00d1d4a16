"""Imports every plan module so that its queries are registered."""

from __future__ import annotations

import importlib

from millrace.plans import registry

_MODULES = ("relational", "profiling", "scalars", "features", "language", "vectors", "evaluation", "modelling", "clustering", "tuning", "streams")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"millrace.plans.{name}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracles():
    _load()
    return dict(registry.ORACLES)
