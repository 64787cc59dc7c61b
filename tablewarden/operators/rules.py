"""Row-level rules as Column predicates.

Each builder turns a table's setting into a :class:`RowRule`: predicates that are
true on a failing row, plus what is known from the schema alone (absent columns).
Nothing here runs a job; the suite fuses the predicates of all rules into one
aggregate, and quarantine reuses the same predicates as a filter.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.names import col, resolve
from tablewarden.functions.trees import balanced

log = logging.getLogger(__name__)

Schema = Mapping[str, T.DataType]  # column name -> type
Builder = Callable[[Schema, Any], "RowRule"]

SQL_RULES = ("DQ02", "DQ05", "DQ08", "DQ15")


@dataclass(frozen=True)
class RowRule:
    """What one rule checks on one table.

    ``failing`` maps the name of each check to its predicate. ``absent`` counts
    configured columns the table lacks: each fails every row. ``blocked`` means the rule
    cannot look at rows at all: the whole table fails. ``cells`` is the number of values
    checked per row (more than 1 only for DQ11).
    """

    dq_id: str
    failing: Mapping[str, Column]
    absent: int = 0
    blocked: bool = False
    cells: int = 1

    def any_failing(self) -> Column:
        """True where any check of this rule fails, never NULL."""
        hits = [F.coalesce(predicate, F.lit(False)) for predicate in self.failing.values()]
        return balanced(or_, hits)

    def without(self, skipped: Collection[str]) -> RowRule:
        """Leave out checks named ``<rule>.<check>``."""
        kept = {n: p for n, p in self.failing.items() if f"{self.dq_id}.{n}" not in skipped}
        return RowRule(self.dq_id, kept, self.absent, self.blocked, self.cells)


def completeness(schema: Schema, columns: Sequence[str]) -> RowRule:
    found = [resolve(schema, c) for c in columns]
    if None in found:
        return RowRule("DQ01", {}, blocked=True)
    return RowRule("DQ01", {"any": balanced(or_, (col(c).isNull() for c in found))})


def sql_conditions(dq_id: str) -> Builder:
    """DQ02, DQ05, DQ08, DQ15: a row fails where the SQL condition is false or NULL."""

    def build(schema: Schema, conditions: Mapping[str, str]) -> RowRule:
        return RowRule(
            dq_id,
            {str(n): ~F.coalesce(F.expr(text).cast("boolean"), F.lit(False)) for n, text in conditions.items()},
        )

    return build


def per_column(dq_id: str, failing_where: Callable[[Column, T.DataType, Any], Column | None]) -> Builder:
    """Rules of the form {column: requirement}; an absent column fails every row."""

    def build(schema: Schema, requirements: Mapping[str, Any]) -> RowRule:
        failing, absent = {}, 0
        for name, requirement in requirements.items():
            column = resolve(schema, name)
            if column is None:
                absent += 1
                continue
            predicate = failing_where(col(column), schema[column], requirement)
            if predicate is not None:
                failing[name] = col(column).isNotNull() & predicate
        return RowRule(dq_id, failing, absent)

    return build


def _not_allowed(value: Column, data_type: T.DataType, allowed: Any) -> Column:
    values = list(allowed) if isinstance(allowed, (list, tuple, set)) else [allowed]
    known = [v for v in values if v is not None]
    mixed = any(isinstance(v, str) for v in known) != isinstance(data_type, T.StringType)
    if not known or not mixed or any(isinstance(v, bool) for v in known):
        return ~value.isin(values)
    # the text side converts to the other type, as in a plain comparison, but without raising
    if isinstance(data_type, T.StringType):
        whole = all(isinstance(v, int) for v in known)
        allowed_values = [F.lit(v) for v in known]
        value = value.try_cast("bigint" if whole else "double")
    else:
        allowed_values = [F.lit(v).try_cast(data_type) for v in known]
    # what does not convert matches nothing; NULL in the list leaves the rest unknown
    matches = balanced(or_, [F.coalesce(value == v, F.lit(False)) for v in allowed_values])
    return F.when(matches, F.lit(False)).otherwise(F.lit(None if len(known) < len(values) else True).cast("boolean"))


def _beyond(value: Column, limits: Mapping[str, Any], number: Callable[[Any], Any]) -> Column | None:
    bounds = []
    if "min" in limits:
        bounds.append(value < number(limits["min"]))
    if "max" in limits:
        bounds.append(value > number(limits["max"]))
    return balanced(or_, bounds) if bounds else None


def _out_of_range(value: Column, data_type: T.DataType, limits: Mapping[str, Any]) -> Column | None:
    # text that is no number is not out of range
    number = value.try_cast("double") if isinstance(data_type, T.StringType) else value
    return _beyond(number, limits, float)


def _bad_length(value: Column, data_type: T.DataType, limits: Mapping[str, Any]) -> Column | None:
    return _beyond(F.length(value), limits, int)


def _no_match(value: Column, data_type: T.DataType, pattern: str) -> Column:
    return ~value.rlike(pattern)


def timeliness(schema: Schema, columns: Sequence[str]) -> RowRule:
    found = next((c for c in (resolve(schema, c) for c in columns) if c), None)
    if found is None:
        return RowRule("DQ07", {}, blocked=True)
    return RowRule("DQ07", {found: col(found).isNotNull() & col(found).try_cast("date").isNull()})


def null_cells(schema: Schema, columns: Sequence[str]) -> RowRule:
    found = [resolve(schema, c) for c in columns]
    # numbered, as a column listed twice counts twice
    failing = {f"{i}": col(c).isNull() for i, c in enumerate(found) if c is not None}
    return RowRule("DQ11", failing, absent=found.count(None), cells=len(found))


ROW_RULES: dict[str, Builder] = {
    "DQ01": completeness,
    "DQ02": sql_conditions("DQ02"),
    "DQ03": per_column("DQ03", _not_allowed),
    "DQ05": sql_conditions("DQ05"),
    "DQ07": timeliness,
    "DQ08": sql_conditions("DQ08"),
    "DQ09": per_column("DQ09", _out_of_range),
    "DQ11": null_cells,
    "DQ12": per_column("DQ12", _bad_length),
    "DQ14": per_column("DQ14", _no_match),
    "DQ15": sql_conditions("DQ15"),
}


def build_row_rules(df: DataFrame, settings: Mapping[str, Any]) -> tuple[dict[str, RowRule], dict[str, Exception]]:
    """Rules with predicates Spark can analyse, and what is wrong with the others.

    ``settings`` maps rule ids to what they check. SQL conditions that do not parse, do
    not resolve or are not boolean are left out of their rule. The checks are analysed
    together; only if that fails are they looked at one by one.
    """
    schema = {f.name: f.dataType for f in df.schema.fields}
    rules: dict[str, RowRule] = {}
    errors: dict[str, Exception] = {}
    for dq_id, setting in settings.items():
        try:
            if dq_id in SQL_RULES:
                setting = _usable_conditions(df, dq_id, setting)
            rules[dq_id] = ROW_RULES[dq_id](schema, setting)
        except Exception as error:
            errors[dq_id] = error
    predicates = [p for rule in rules.values() for p in rule.failing.values()]
    if predicates and analysis_error(df, balanced(and_, predicates)):
        for dq_id, rule in list(rules.items()):
            problems = [analysis_error(df, p) for p in rule.failing.values()]
            if any(problems):
                errors[dq_id] = next(p for p in problems if p)
                del rules[dq_id]
    return rules, errors


def _usable_conditions(df: DataFrame, dq_id: str, conditions: Mapping[str, str]) -> dict[str, str]:
    together = " AND ".join(f"({text})" for text in conditions.values())
    if conditions and _condition_problem(df, together, *conditions.values()) is None:
        return dict(conditions)
    usable = {}
    for name, text in conditions.items():
        problem = _condition_problem(df, text, text)
        if problem is None:
            usable[name] = text
        else:
            log.warning("%s condition %r skipped: %s", dq_id, name, problem)
    return usable


def _condition_problem(df: DataFrame, condition: str, *texts: str) -> str | None:
    """Why ``condition`` cannot be a filter (aggregates and windows cannot), or a text is not boolean."""
    error = analysis_error(df, lambda: F.expr(condition).cast("boolean"))
    if error:
        return str(error).splitlines()[0]
    for field in df.selectExpr(*texts).schema.fields:
        if not isinstance(field.dataType, (T.BooleanType, T.NullType)):
            return f"type {field.dataType.simpleString()} is not boolean"
    return None


def analysis_error(df: DataFrame, condition: Column | Callable[[], Column]) -> Exception | None:
    """Parse and analyse a filter without running it."""
    try:
        df.filter(condition() if callable(condition) else condition)
    except Exception as error:  # parse and type errors surface as several kinds
        return error
    return None
