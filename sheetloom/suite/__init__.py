"""Registered queries: every operator on whole tables, most with the SQL that must give the same rows."""

from importlib import import_module
from pkgutil import iter_modules


def load() -> None:
    """Import every module of the suite, so that its queries are registered."""
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")
