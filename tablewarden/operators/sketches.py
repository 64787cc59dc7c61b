"""Approximate profiles that add up: distinct counts as HyperLogLog sketches.

A sketch of each column takes one scan and one row per task; no value is shuffled. Sketches of
different runs, days or parts of a table are united to the sketch of all of them, so a growing
table is profiled by its new rows alone. The exact profile stays beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.grading import percentage
from tablewarden.functions.names import TableRef, quote
from tablewarden.operators.profile import INTEGRAL, canonical

LG_K = 12  # 4,096 registers: a standard error of about 1.6 %
KEY = ("catalog", "schema", "table", "column_name", "data_type")


def _sketchable(name: str, data_type: T.DataType) -> str:
    if isinstance(data_type, INTEGRAL):
        return f"CAST({quote(name)} AS BIGINT)"
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return quote(name)
    return f"IF({quote(name)} IS NULL, NULL, {canonical(quote(name), data_type)})"


def sketch_profile(
    df: DataFrame, ref: TableRef, run_timestamp: Column | None = None, lg_k: int = LG_K
) -> DataFrame:
    """One row per column: rows, NULLs and a sketch of the values that are not NULL."""
    fields = df.schema.fields
    if not fields:
        raise ValueError(f"{ref.full} has no columns")
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        aggregates.append(F.expr(f"count_if({quote(f.name)} IS NULL)").alias(f"nulls_{i}"))
        aggregates.append(F.expr(f"hll_sketch_agg({_sketchable(f.name, f.dataType)}, {int(lg_k)})").alias(f"sketch_{i}"))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("row_count"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"sketch_{i}").alias("sketch"),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*aggregates).select(
        F.lit(ref.catalog).alias("catalog"),
        F.lit(ref.schema).alias("schema"),
        F.lit(ref.table).alias("table"),
        F.inline(F.array(*rows)),
        (F.current_timestamp() if run_timestamp is None else run_timestamp).alias("profile_timestamp"),
    )


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column of all parts; they must not overlap, as rows are added up."""
    return sketches.groupBy(*KEY).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
        F.max("profile_timestamp").alias("profile_timestamp"),
    )


def estimated_profile(sketches: DataFrame) -> DataFrame:
    """The columns of the exact profile, distinct values (NULL being one) estimated."""
    distinct = F.hll_sketch_estimate("sketch") + F.when(F.col("null_count") > 0, 1).otherwise(0)
    return sketches.select(
        *KEY,
        "row_count",
        "null_count",
        percentage(F.col("null_count"), F.col("row_count")).alias("null_percentage"),
        distinct.alias("distinct_count"),
        "profile_timestamp",
    )
