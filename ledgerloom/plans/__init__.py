"""Queries on the benchmark tables, each with the SQL it is checked against."""

from importlib import import_module

MODULES = (
    "star", "tables", "projections", "joined", "grouped", "ranked", "scalar", "documents",
    "versions", "trust", "workload", "finance", "fraud", "learning", "contracts", "stored",
)


def load() -> None:
    """Import every module, which registers its queries."""
    for name in MODULES:
        import_module(f"ledgerloom.plans.{name}")
