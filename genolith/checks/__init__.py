"""Registered queries; importing the modules fills the registry."""

import importlib
import pkgutil


def load():
    from genolith.checks import registry

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return registry
