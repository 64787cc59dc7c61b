"""Small frames and one-table suites for unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablewarden import Rulebook, Table, TableRef, run_suite

REF = TableRef("lake", "unit", "t")


def book(rules: dict | None = None, **sections) -> Rulebook:
    return Rulebook({"table_rules": {REF.full: rules or {}}, **sections})


def graded(df: DataFrame, rules: dict | None = None, only=None, load=None, history=None, **sections) -> dict:
    """``{rule: (status, percentage, failed)}`` for one frame."""
    options = {"only": only} if only else {}
    frame = run_suite([Table(REF, df)], book(rules, **sections), load=load, history=history, **options)
    return {r.dq_id: (r.status, r.failure_percentage, r.failed_records) for r in frame.collect()}
