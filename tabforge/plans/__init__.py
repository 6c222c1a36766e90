"""Registered queries, one module per part of the operator inventory."""

from importlib import import_module

MODULES = ("storage", "basics", "aggregates", "features", "evaluation", "imputation", "learning")


def load_all() -> None:
    for name in MODULES:
        import_module(f"tabforge.plans.{name}")
