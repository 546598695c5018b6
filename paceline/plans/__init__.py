"""Bindings of the operators to the driver tables, one module per operator family."""

from __future__ import annotations

import importlib
from types import SimpleNamespace

_FAMILIES = ["tables", "windows", "joins", "scalars", "features", "market", "picks", "statistics",
             "models", "quality", "gates", "raw", "streams"]


def load() -> SimpleNamespace:
    """Import every family and return the registered queries and oracle SQL."""
    from paceline.plans import registry

    for name in _FAMILIES:
        importlib.import_module(f"paceline.plans.{name}")
    return SimpleNamespace(queries=registry.QUERIES, oracles=registry.ORACLES)
