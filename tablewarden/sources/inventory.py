"""Which tables there are, and how large they are."""

from __future__ import annotations

import logging
from collections.abc import Collection, Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.names import TableRef, quote
from tablewarden.functions.trees import balanced

log = logging.getLogger(__name__)


def in_scope(schema: str, excluded: Collection[str] = (), allowed: Collection[str] = ()) -> bool:
    """Not excluded and, if there is an allowlist, on it. Case does not matter."""
    name = schema.lower()
    return name not in {s.lower() for s in excluded} and (
        not allowed or name in {s.lower() for s in allowed}
    )


def discover_tables(
    spark: SparkSession,
    catalog: str,
    excluded: Collection[str] = (),
    allowed: Collection[str] = (),
) -> list[TableRef]:
    """Permanent tables of a catalog; reads metadata only. Unreadable schemas are skipped."""
    try:
        schemas = [row[0] for row in spark.sql(f"SHOW SCHEMAS IN {quote(catalog)}").toLocalIterator()]
    except PySparkException as error:
        raise ValueError(f"catalog {catalog!r} does not exist") from error
    found = []
    for schema in schemas:
        if not in_scope(schema, excluded, allowed):
            continue
        try:
            listed = spark.sql(f"SHOW TABLES IN {quote(catalog)}.{quote(schema)}")
            rows = listed.filter(~F.col("isTemporary")).select("tableName").toLocalIterator()
            found += [TableRef(catalog, schema, row[0]) for row in rows]
        except PySparkException as error:
            log.warning("cannot list %s.%s: %s", catalog, schema, error)
    return found


def read_table(spark: SparkSession, ref: TableRef) -> DataFrame:
    try:
        return spark.table(ref.quoted)
    except PySparkException as error:
        raise RuntimeError(f"cannot read table {ref.full}: {error}") from error


def table_inventory(
    tables: Iterable[tuple[TableRef, DataFrame]],
    excluded: Collection[str] = (),
    allowed: Collection[str] = (),
) -> DataFrame:
    """``(schema, table, row_count, column_count)`` of the tables in scope.

    Schemas are filtered by name before anything is scanned; the counts need no column,
    so a columnar source answers them from its metadata.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(ref.schema).alias("schema"),
            F.lit(ref.table).alias("table"),
            "row_count",
            F.lit(len(df.columns)).cast("long").alias("column_count"),
        )
        for ref, df in tables
        if in_scope(ref.schema, excluded, allowed)
    ]
    if not counts:
        schema = "schema string, table string, row_count long, column_count long"
        return SparkSession.active().createDataFrame([], schema)
    return balanced(DataFrame.unionByName, counts)
