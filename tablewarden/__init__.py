"""Data quality for Spark tables: rules, scores, profiles, layers and reports."""

from tablewarden.functions.names import TableRef
from tablewarden.plans.rulebook import Rulebook
from tablewarden.plans.run import Run, promote, run_catalog
from tablewarden.plans.score import summarise
from tablewarden.plans.suite import Table, detail, run_suite
from tablewarden.sources.store import Store

__all__ = [
    "Rulebook",
    "Run",
    "Store",
    "Table",
    "TableRef",
    "detail",
    "promote",
    "run_catalog",
    "run_suite",
    "summarise",
]
