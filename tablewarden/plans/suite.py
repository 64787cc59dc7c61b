"""All sixteen rules over one table, or many, as one lazy plan.

The plan is built from *measures*: rows ``(table, rule, failed, checked)`` whose
counts simply add up. Per table there is

* one fused aggregate over one scan for every row-level rule,
* one key-only scan for uniqueness (DQ04 and DQ10 share it),
* one key-only scan per foreign key, counted per key before the anti join,

and, once for all tables, one aggregate over the run history for the volume rule.
Adding the measures up per table and rule gives the results; only a handful of rows
per table ever reach that last shuffle.

With a period per table the same plan gives the history of runs: every scan groups by the
period too, and the volume rule looks at the period before.

Measures are put together as SQL text: they refer to columns of the fused aggregate
(``_total`` is the row count) and would otherwise be hundreds of small Column calls.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.functions.grading import (
    percentage,
    rule_status,
    volume_percentage,
    volume_status,
)
from tablewarden.functions.names import TableRef, col, quote, resolve
from tablewarden.functions.trees import balanced
from tablewarden.operators.datatypes import mismatched_columns
from tablewarden.operators.keys import distinct_count, orphan_count, previous_row_counts
from tablewarden.operators.rules import ROW_RULES, RowRule, build_row_rules
from tablewarden.plans.rulebook import RULE_IDS, Rulebook

log = logging.getLogger(__name__)

Loader = Callable[[str], DataFrame]

TABLE_KEY = ("catalog", "schema", "table")


@dataclass(frozen=True)
class Table:
    """A frame and the three-part name it is reported under."""

    ref: TableRef
    df: DataFrame


@dataclass
class Part:
    """One rule's share of a table's plan."""

    measure: str  # struct over the fused aggregate's row, in SQL
    checks: dict[str, Column] = field(default_factory=dict)  # predicates the fused aggregate counts
    branches: list[DataFrame] = field(default_factory=list)  # more measures, scanned apart


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return balanced(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- measures ---------------------------------------------------------------------


def _measure(
    dq_id: str, failed: Any = 0, checked: Any = "_total", status: str = "NULL", pct: str = "NULL"
) -> str:
    """The measure of a rule; ``status`` and ``pct`` fix a verdict the counts cannot give."""
    return (
        f"named_struct('dq_id', '{dq_id}', 'failed', CAST({failed} AS BIGINT),"
        f" 'checked', CAST({checked} AS BIGINT), 'fixed_status', CAST({status} AS STRING),"
        f" 'fixed_percentage', CAST({pct} AS DOUBLE))"
    )


def _cannot_run(dq_id: str) -> str:
    """A rule that raises is a WARNING, unless the table is empty and nothing was tried."""
    return _measure(dq_id, status="IF(_total = 0, 'PASS', 'WARNING')", pct="0")


def _whole_table_fails(dq_id: str) -> str:
    return _measure(dq_id, failed="_total", status="'FAIL'", pct="100")


def _extra(count: DataFrame, dq_ids: Sequence[str], sign: int = 1) -> DataFrame:
    """Counts ``n``, one or one per period, as failures added to, or taken from, some rules."""
    measures = ", ".join(_measure(d, f"{sign} * n", 0) for d in dq_ids)
    return count.selectExpr(*(quote(c) for c in count.columns if c != "n"), f"inline(array({measures}))")


def _counted(rule: RowRule) -> Part:
    """Each check of the rule is one count of the fused aggregate."""
    checks = {f"{rule.dq_id}_{i}": p for i, p in enumerate(rule.failing.values())}
    failed = balanced(lambda a, b: f"({a} + {b})", [f"{rule.absent} * _total", *checks])
    return Part(_measure(rule.dq_id, failed, f"{rule.cells} * _total"), checks)


def _row_rule(rule: RowRule) -> Part:
    part = Part(_whole_table_fails(rule.dq_id)) if rule.blocked else _counted(rule)
    if rule.dq_id == "DQ01":  # completeness alone has a verdict for a table without rows
        empty = _measure(rule.dq_id, status="'WARNING'", pct="100")
        part.measure = f"IF(_total = 0, {empty}, {part.measure})"
    return part


def _uniqueness(
    table: Table, book: Rulebook, dq_id: str, sharing: Collection[str], by: Column | None
) -> Part:
    """Rows minus distinct keys. The first rule with these keys counts them for all."""
    keys = book.setting(table.ref, dq_id)
    if not keys:
        return Part(_measure(dq_id))
    found = [resolve(table.df.columns, key) for key in keys]
    if None in found:
        return Part(_whole_table_fails(dq_id))
    same = [d for d in sharing if book.setting(table.ref, d) == keys]
    branches = [_extra(distinct_count(table.df, found, by), same, -1)] if same[0] == dq_id else []
    return Part(_measure(dq_id, "_total"), branches=branches)


def _integrity(table: Table, book: Rulebook, load: Loader, by: Column | None) -> Part:
    null_keys, absent, branches = {}, 0, []
    for relation in book.relationships(table.ref):
        child = resolve(table.df.columns, relation["child_column"])
        parents = load(relation["parent_table"]) if child else None
        parent = resolve(parents.columns, relation["parent_column"]) if child else None
        if parent is None:
            absent += 1
            continue
        if not relation.get("nullable_allowed", True):
            null_keys[str(len(null_keys))] = col(child).isNull()
        branches.append(_extra(orphan_count(table.df, child, parents, parent, by), ["DQ06"]))
    part = _counted(RowRule("DQ06", null_keys, absent))
    part.branches += branches
    return part


def _data_types(table: Table, book: Rulebook) -> Part:
    expected = book.setting(table.ref, "DQ13")
    if not expected:
        return Part(_measure("DQ13"))
    wrong = mismatched_columns(table.df, expected)
    return Part(_measure("DQ13", len(wrong), len(expected)))


def _parts(
    table: Table,
    book: Rulebook,
    load: Loader,
    only: Sequence[str],
    without: Collection[str],
    by: Column | None,
) -> dict[str, Part]:
    active = [d for d in only if book.enabled(d) and d not in without]
    settings = {d: book.setting(table.ref, d) for d in active if d in ROW_RULES}
    row_rules, errors = build_row_rules(table.df, {d: s for d, s in settings.items() if s})
    sharing = [d for d in active if d in ("DQ04", "DQ10")]

    def part(dq_id: str) -> Part:
        if not book.enabled(dq_id):
            return Part(_measure(dq_id, status="'SKIPPED'", pct="0"))
        if dq_id in without:
            return Part(_cannot_run(dq_id))
        if dq_id in errors:
            raise errors[dq_id]
        if dq_id in row_rules:
            return _row_rule(row_rules[dq_id].without(without))
        if dq_id in sharing:
            return _uniqueness(table, book, dq_id, sharing, by)
        if dq_id == "DQ06":
            return _integrity(table, book, load, by)
        if dq_id == "DQ13":
            return _data_types(table, book)
        return Part(_measure(dq_id))  # nothing configured; DQ16 is graded from row_count and history

    parts = {}
    for dq_id in only:
        try:
            parts[dq_id] = part(dq_id)
        except Exception as error:  # whatever stops one rule must not stop the others
            log.warning("%s cannot run on %s: %s", dq_id, table.ref.full, error)
            parts[dq_id] = Part(_cannot_run(dq_id))
    return parts


def _rows_where(predicate: Column) -> Column:
    return F.count(F.when(predicate, 1))


def _fused(df: DataFrame, parts: dict[str, Part], by: Column | None) -> DataFrame:
    """One row, or one per period: ``_total`` and the count of every check."""
    grouped = df.groupBy(*([] if by is None else [by]))
    total = F.count(F.lit(1)).alias("_total")
    checks = {name: p for part in parts.values() for name, p in part.checks.items()}
    try:
        return grouped.agg(total, *(_rows_where(p).alias(name) for name, p in checks.items()))
    except AnalysisException:
        # some check is fine in a filter but not in an aggregate, e.g. a random sample
        kept = [c for dq_id, part in parts.items() for c in _keep_or_scan_apart(df, dq_id, part, by)]
        return grouped.agg(total, *kept)


def _keep_or_scan_apart(df: DataFrame, dq_id: str, part: Part, by: Column | None) -> list[Column]:
    columns = []
    for name, predicate in part.checks.items():
        try:
            df.agg(_rows_where(predicate))
            columns.append(_rows_where(predicate).alias(name))
        except AnalysisException:
            failing = df.filter(predicate).groupBy(*([] if by is None else [by]))
            part.branches.append(_extra(failing.agg(F.count(F.lit(1)).alias("n")), [dq_id]))
            columns.append(F.lit(0).alias(name))
    return columns


def table_measures(
    table: Table,
    book: Rulebook,
    load: Loader | None = None,
    only: Sequence[str] = RULE_IDS,
    without: Collection[str] = (),
    period: Column | None = None,
) -> DataFrame:
    """Measures of one table. ``load`` finds parent tables by name.

    With ``period`` there are measures for each of its values, in ``run_timestamp``.

    ``without`` names rules (``DQ06``) to report as not runnable and single checks
    (``DQ02.name``) to skip; see :mod:`tablewarden.plans.run`.
    """
    by = None if period is None else period.alias("run_timestamp")
    parts = _parts(table, book, load or table.df.sparkSession.table, only, without, by)
    fused = _fused(table.df, parts, by).selectExpr(
        *([] if by is None else ["run_timestamp"]),
        "_total AS row_count",
        f"{len(table.df.columns)}L AS column_count",
        f"inline(array({', '.join(p.measure for p in parts.values())}))",
    )
    frames = union_all([fused, *(branch for p in parts.values() for branch in p.branches)])
    return frames.select(*(F.lit(part).alias(k) for k, part in zip(TABLE_KEY, table.ref)), "*")


# --- results ----------------------------------------------------------------------


def results(
    measures: DataFrame, book: Rulebook, run_timestamp: Column | None, history: DataFrame | None = None
) -> DataFrame:
    """Add the measures up and grade them: one row per table and rule.

    Without a ``run_timestamp`` the measures bring their own: one row per table, period and
    rule, and the volume rule compares with the period before.

    ``history`` is an earlier summary (``catalog, schema, table, run_timestamp,
    row_count``); without a usable one the volume rule passes.
    """
    previous = _previous(history)
    if previous is None:
        measures = measures.withColumn("previous_rows", F.lit(None).cast("long"))
    else:
        measures = union_all([measures, previous])
    key = [*TABLE_KEY, *(["run_timestamp"] if run_timestamp is None else []), "dq_id"]
    added = measures.groupBy(*key).agg(
        F.sum("failed").alias("failed_records"),
        F.sum("checked").alias("checked"),
        *(
            F.max(c).alias(c)
            for c in ("row_count", "column_count", "previous_rows", "fixed_status", "fixed_percentage")
        ),
    )
    current, before = F.col("row_count"), F.col("previous_rows")
    added = added.filter(current.isNotNull())  # not: history of tables outside this run
    if run_timestamp is None:  # a row per period in each partition of the window
        run_timestamp = F.col("run_timestamp")
        runs = W.partitionBy(*TABLE_KEY, "dq_id").orderBy("run_timestamp")
        added = added.withColumn("previous_rows", F.lag("row_count").over(runs))
    is_volume = (F.col("dq_id") == "DQ16") & F.col("fixed_status").isNull()
    share = percentage(F.col("failed_records"), F.col("checked"))
    pct = F.coalesce(
        "fixed_percentage", F.when(is_volume, volume_percentage(current, before)).otherwise(share)
    )
    volume = volume_status(current, before, book.volume_pass_pct, book.volume_warning_pct)
    graded = F.when(is_volume, volume).otherwise(rule_status(F.col("failure_percentage")))
    return (
        added.withColumn("failure_percentage", pct)
        .select(
            *TABLE_KEY,
            run_timestamp.alias("run_timestamp"),
            "dq_id",
            F.coalesce("fixed_status", graded).alias("status"),
            "failure_percentage",
            "failed_records",
            "row_count",
            "column_count",
        )
    )


def _previous(history: DataFrame | None) -> DataFrame | None:
    if history is None:
        return None
    try:
        return previous_row_counts(history).withColumn("dq_id", F.lit("DQ16"))
    except AnalysisException as error:
        log.warning("run history is of no use: %s", error)
        return None


def run_suite(
    tables: Sequence[Table],
    book: Rulebook,
    run_timestamp: Column | None = None,
    load: Loader | None = None,
    history: DataFrame | None = None,
    only: Sequence[str] = RULE_IDS,
) -> DataFrame:
    """Results of all rules on all tables as one lazy frame."""
    measures = union_all([table_measures(t, book, load, only) for t in tables])
    return results(measures, book, F.current_timestamp() if run_timestamp is None else run_timestamp, history)


def run_suite_by_period(
    tables: Sequence[tuple[Table, Column]],
    book: Rulebook,
    load: Loader | None = None,
    only: Sequence[str] = RULE_IDS,
) -> DataFrame:
    """Results of all rules for each period of each table, as if run once per period.

    The period of a row is an expression; rows without one form a period of their own. A
    large period stays cheap, as tasks combine their counts and keys before any shuffle.
    """
    measures = union_all([table_measures(t, book, load, only, period=period) for t, period in tables])
    return results(measures, book, None)


def detail(rule_results: DataFrame) -> DataFrame:
    """The audit detail: results without the counts the summary needs."""
    return rule_results.drop("row_count", "column_count")
