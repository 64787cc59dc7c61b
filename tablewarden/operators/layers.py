"""Bronze, silver, gold and quarantine."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.grading import gate_minimum
from tablewarden.functions.names import TableRef, safe_name
from tablewarden.functions.trees import balanced
from tablewarden.operators.rules import ROW_RULES, RowRule, build_row_rules
from tablewarden.plans.rulebook import Rulebook
from tablewarden.sources.store import ROUTE, Store

CLEAN, FAILING = "clean", "failing"  # routes of a row

# Lineage columns of the bronze layer.
LINEAGE_COLUMNS = (
    "_dq_ingestion_timestamp",
    "_dq_source_catalog",
    "_dq_source_schema",
    "_dq_source_table",
)


def _now(at: Column | None) -> Column:
    return F.current_timestamp() if at is None else at


# --- bronze -----------------------------------------------------------------------


def normalized_names(columns: Sequence[str]) -> list[str]:
    """Safe names by position; later clashes get ``_1``, ``_2``, ..."""
    suffixes: dict[str, int] = {}  # by name taken: the last suffix tried with it
    names = []
    for column in columns:
        base = name = safe_name(column)
        while name in suffixes:
            suffixes[base] += 1
            name = f"{base}_{suffixes[base]}"
        suffixes[name] = 0
        names.append(name)
    return names


def normalize_columns(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    names = normalized_names(df.columns)
    return df.toDF(*names), dict(zip(df.columns, names))


def bronze_frame(df: DataFrame, ref: TableRef, at: Column | None = None) -> DataFrame:
    values = (_now(at), *map(F.lit, ref))
    return normalize_columns(df)[0].withColumns(dict(zip(LINEAGE_COLUMNS, values)))


def write_bronze(
    df: DataFrame, ref: TableRef, store: Store, book: Rulebook, at: Column | None = None
) -> tuple[DataFrame, dict[str, str]]:
    bronze = bronze_frame(df, ref, at)
    store.write(bronze, book.layer("bronze"), ref.table)
    return bronze, normalize_columns(df)[1]


def land(
    df: DataFrame,
    condition: Column | None,
    ref: TableRef,
    store: Store,
    book: Rulebook,
    at: Column | None = None,
) -> tuple[dict[str, str], int]:
    """Write bronze in one pass, rows that meet ``condition`` apart from the others.

    Returns the new column names and how many rows met it, counted while they were written.
    """
    way = F.lit(CLEAN) if condition is None else F.when(condition, FAILING).otherwise(CLEAN)
    # the condition knows the columns by their old names
    named = df.select("*", way.alias(ROUTE)).toDF(*normalized_names(df.columns), ROUTE)
    landed = named.withColumns(dict(zip(LINEAGE_COLUMNS, (_now(at), *map(F.lit, ref)))))
    written = Observation()
    counted = landed.observe(written, F.count_if(F.col(ROUTE) == FAILING).alias("failing"))
    store.write(counted, book.layer("bronze"), ref.table, partition_by=(ROUTE,))
    return normalize_columns(df)[1], written.get["failing"]


# --- silver and gold --------------------------------------------------------------


def silver_frame(bronze: DataFrame) -> DataFrame:
    return bronze.drop(*LINEAGE_COLUMNS)


def create_silver(bronze: DataFrame, table: str, store: Store, book: Rulebook, score: float) -> bool:
    """Write silver unless the quality gate is on and the score lies below it."""
    if book.gate.get("enabled", True) and float(score) < gate_minimum(book.gate):
        return False
    store.write(silver_frame(bronze), book.layer("silver"), table)
    return True


def gold_frame(silver: DataFrame, score: float, status: str, at: Column | None = None) -> DataFrame:
    return silver.withColumns(
        {
            "_dq_quality_score": F.lit(float(score)),
            "_dq_overall_status": F.lit(status),
            "_dq_gold_timestamp": _now(at),
        }
    )


def create_gold(
    spark: SparkSession,
    table: str,
    store: Store,
    book: Rulebook,
    score: float,
    status: str,
    at: Column | None = None,
) -> bool:
    """Write gold from the stored silver table; False where there is none."""
    if not store.exists(spark, book.layer("silver"), table):
        return False
    silver = store.read(spark, book.layer("silver"), table)
    store.write(gold_frame(silver, score, status, at), book.layer("gold"), table)
    return True


# --- quarantine -------------------------------------------------------------------


def row_rules(df: DataFrame, ref: TableRef, book: Rulebook, without: Collection[str] = ()) -> list[RowRule]:
    """The enabled row-level rules of a table that have a predicate to offer.

    ``without``: rules and single conditions that a run found to raise on the data.

    Defects of the whole table (absent columns) are the score's business: they do not
    send every row to quarantine.
    """
    settings = {d: book.setting(ref, d) for d in ROW_RULES if book.enabled(d) and d not in without}
    rules, _ = build_row_rules(df, {d: s for d, s in settings.items() if s})
    left = [rule.without(without) for rule in rules.values()]
    return [rule for rule in left if rule.failing]


def failing_condition(rules: Sequence[RowRule]) -> Column | None:
    """True on rows that fail any rule; None without rules."""
    conditions = [rule.any_failing() for rule in rules]
    return balanced(or_, conditions) if conditions else None


def failure_reasons(rules: Sequence[RowRule]) -> Column:
    """Array of the ids of all rules a row fails."""
    return F.array_compact(F.array(*(F.when(rule.any_failing(), rule.dq_id) for rule in rules)))


def quarantine_frame(
    df: DataFrame, condition: Column, ref: TableRef, run_id: str, at: Column | None = None
) -> DataFrame:
    return df.filter(condition).withColumns(
        {
            "_dq_run_id": F.lit(run_id),
            "_dq_source_table": F.lit(ref.full),
            "_dq_quarantine_timestamp": _now(at),
        }
    )


def create_quarantine(
    df: DataFrame,
    condition: Column | None,
    ref: TableRef,
    store: Store,
    book: Rulebook,
    run_id: str,
    at: Column | None = None,
) -> int:
    """Append failing rows to ``quarantine_<table>`` and return how many there were.

    Nothing is written where no row fails. The look for a first failing row stops at
    it; the rows are counted while they are written, not in a pass of their own.
    """
    if condition is None:
        return 0
    failing = quarantine_frame(df, condition, ref, run_id, at)
    if failing.isEmpty():
        return 0
    return _append_counted(failing, ref, store, book)


def quarantine_landed(
    spark: SparkSession,
    columns: Sequence[str],
    ref: TableRef,
    store: Store,
    book: Rulebook,
    run_id: str,
    at: Column | None = None,
) -> int:
    """Quarantine the failing rows of a landed table, under the names they had in the source."""
    landed = store.read_routed(spark, book.layer("bronze"), ref.table, FAILING)
    rows = landed.drop(*LINEAGE_COLUMNS).toDF(*columns)
    return _append_counted(quarantine_frame(rows, F.lit(True), ref, run_id, at), ref, store, book)


def _append_counted(failing: DataFrame, ref: TableRef, store: Store, book: Rulebook) -> int:
    written = Observation()
    counted = failing.observe(written, F.count(F.lit(1)).alias("rows"))
    store.write(counted, book.layer("quarantine"), f"quarantine_{safe_name(ref.table)}", "append")
    return written.get["rows"]
