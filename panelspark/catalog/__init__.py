"""Registered queries, each with its DuckDB twin where SQL can say it."""

from importlib import import_module

MODULES = ("reads", "joins", "merges", "ingest", "aggregates", "windows", "calendars", "composites",
           "news", "models", "streams")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
