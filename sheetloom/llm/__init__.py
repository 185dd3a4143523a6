"""Operators for preparing training text at scale. Nothing else in the library imports this package."""

from importlib import import_module
from pkgutil import iter_modules


def load() -> None:
    """Import every module of the package, so that its queries are registered."""
    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")
