"""Key rules: distinct keys and foreign keys, written so that a hot key stays cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.names import col, quote


def short_key(value: str, data_type: str) -> str:
    """``value`` (SQL) as a key to count by: long text and binary become their SHA-256.

    A digest is 71 bytes and values up to 64 bytes stay as they are, so the two never
    meet. Columns of documents can be counted without shuffling the documents.
    """
    if data_type not in ("string", "binary"):
        return value
    digest = f"CAST(concat('sha256:', sha2({value}, 256)) AS {data_type})"
    return f"IF(octet_length({value}) > 64, {digest}, {value})"


def distinct_count(df: DataFrame, keys: Sequence[str], by: Column | None = None) -> DataFrame:
    """One row ``n``: distinct key tuples, NULL being a value. With ``by`` (a named
    expression), a row per value of it.

    Only the key columns are read. Spark drops repeats within each task before the
    shuffle, so a key that holds a third of all rows costs one row per task.
    """
    group = [] if by is None else [by]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    short = (F.expr(f"{short_key(quote(k), types[k])} AS key_{i}") for i, k in enumerate(keys))
    distinct = df.select(*group, *short).distinct()
    return distinct.groupBy(*distinct.columns[: len(group)]).agg(F.count(F.lit(1)).alias("n"))


def orphan_count(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, by: Column | None = None
) -> DataFrame:
    """One row ``n``: child rows whose non-NULL key has no parent. With ``by`` (a named
    expression), a row per value of it that has such rows; then a key crosses once per value.

    Child rows are counted per key first, so the join sees each key once per task at
    most, whatever the skew; the aggregate's partitioning is then reused by the join.
    Where the parent is small by Spark's own size estimate, Catalyst broadcasts it and
    moves the anti join below the aggregate. No hint is given.
    """
    child_value, parent_value = col(child_key), col(parent_key)
    child_type, parent_type = child.schema[child_key].dataType, parent.schema[parent_key].dataType
    if isinstance(child_type, T.StringType) != isinstance(parent_type, T.StringType):
        # text against another type: text that does not convert matches nothing
        if isinstance(child_type, T.StringType):
            child_value = child_value.try_cast(parent_type)
        else:
            parent_value = parent_value.try_cast(child_type)
    group = [] if by is None else [by]
    per_key = (
        child.filter(col(child_key).isNotNull())
        .groupBy(*group, child_value.alias("_child_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    # repeats of a parent are dropped before the shuffle: the join cannot split that side
    parents = parent.select(parent_value.alias("_parent_key")).distinct()
    orphans = per_key.join(parents, F.col("_child_key") == F.col("_parent_key"), "left_anti")
    return orphans.groupBy(*per_key.columns[: len(group)]).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))


def previous_row_counts(history: DataFrame) -> DataFrame:
    """``previous_rows`` of each table: the row count of its newest run."""
    newest = F.max_by("row_count", F.struct("run_timestamp", "row_count"))
    return history.groupBy("catalog", "schema", "table").agg(newest.try_cast("long").alias("previous_rows"))
