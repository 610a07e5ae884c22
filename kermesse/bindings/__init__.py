"""Operators bound to the given tables."""


def load():
    """All registered queries and SQL texts."""
    import importlib
    import pkgutil

    from kermesse.bindings import registry
    for mod in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{mod}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
