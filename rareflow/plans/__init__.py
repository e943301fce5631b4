"""Registered queries, one module per family."""

from importlib import import_module

FAMILIES = (
    "profiling",
    "cleaning",
    "features",
    "windows",
    "scaling",
    "splits",
    "rebalancing",
    "evaluation",
    "drift",
    "selection",
    "scoring",
    "models",
    "tables",
    "streams",
)


def load_all() -> None:
    for name in FAMILIES:
        import_module(f"rareflow.plans.{name}")
