"""Registered queries over the test tables."""

from importlib import import_module

MODULES = ("cell_queries", "region_queries", "table_queries", "spatial_queries", "chance_queries", "pixel_queries",
           "io_queries")


def load_all():
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    from .registry import ORACLES, QUERIES
    return QUERIES, ORACLES
