"""Bindings onto the shared test tables and the registered queries."""

from __future__ import annotations

import importlib
import pkgutil


def load_all() -> None:
    """Import every query module so that it registers its queries."""
    for module in pkgutil.iter_modules(__path__):
        if module.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{module.name}")
