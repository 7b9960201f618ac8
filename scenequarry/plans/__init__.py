"""Query plans over the derived tables, grouped by family."""

from __future__ import annotations

import importlib
import pkgutil


def load_all():
    """Import every plan module once and return the registry."""
    from scenequarry.plans import registry

    for m in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{m}")
    return registry
