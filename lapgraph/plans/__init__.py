"""Registered queries over the given tables."""

from importlib import import_module

MODULES = [
    "ingest", "aggregates", "detection", "facts", "graphs", "analytics", "sketching", "streams",
]


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"lapgraph.plans.{name}")
