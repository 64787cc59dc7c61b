"""DQ13: declared column types, from the schema, and castability, from the values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.grading import percentage, rule_status
from tablewarden.functions.names import col, resolve

# Other spellings of type names, and the actual types each name accepts.
TYPE_SPELLINGS = {"integer": "int", "stringtype": "string", "doubletype": "double"}
ACCEPTED_TYPES = {"int": ("int", "integer"), "double": ("double", "float", "decimal")}


def type_name(expected: str) -> str:
    name = str(expected).lower()
    for spelling, plain in TYPE_SPELLINGS.items():
        name = name.replace(spelling, plain)
    return name


def type_matches(actual: str, expected: str) -> bool:
    """``timestamp`` takes every timestamp type, ``double`` every fractional number."""
    actual, expected = actual.lower(), type_name(expected)
    if expected == "timestamp":
        return actual.startswith("timestamp")
    if expected == "double" and actual.startswith("decimal("):
        return True
    return actual in ACCEPTED_TYPES.get(expected, (expected,))


def mismatched_columns(df: DataFrame, expected: Mapping[str, str]) -> list[str]:
    """Expected columns that are absent or of another type. Reads the schema only."""
    wrong = []
    for name, wanted in expected.items():
        column = resolve(df.columns, name)
        if column is None or not type_matches(df.schema[column].dataType.simpleString(), wanted):
            wrong.append(name)
    return wrong


def castable(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Values that cannot be cast to the expected type, one row per present column.

    For landings where everything is text: one scan, one aggregate, no shuffle of rows.
    """
    found = {name: resolve(df.columns, name) for name in expected}
    found = {name: column for name, column in found.items() if column is not None}
    if not found:
        schema = "column_name string, expected_type string, status string, failure_percentage double, failed_records long"
        return df.sparkSession.createDataFrame([], schema)
    counts = [F.count(F.lit(1)).alias("row_count")]
    rows = []
    for i, (name, column) in enumerate(found.items()):
        uncastable = col(column).isNotNull() & col(column).try_cast(type_name(expected[name])).isNull()
        counts.append(F.count_if(uncastable).alias(f"failed_{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(type_name(expected[name])).alias("expected_type"),
                F.col(f"failed_{i}").alias("failed_records"),
                F.col("row_count"),
            )
        )
    pct = percentage(F.col("failed_records"), F.col("row_count"))
    return (
        df.agg(*counts)
        .select(F.inline(F.array(*rows)))
        .select(
            "column_name",
            "expected_type",
            rule_status(pct).alias("status"),
            pct.alias("failure_percentage"),
            "failed_records",
        )
    )
