"""Registered queries: each operator bound to the provided tables, with its SQL."""

from __future__ import annotations

import importlib
import pkgutil
from types import ModuleType


def load() -> ModuleType:
    """Import every ``*_queries`` module and return the registry."""
    for info in pkgutil.iter_modules(__path__):
        if info.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{info.name}")
    return importlib.import_module(f"{__name__}.registry")
