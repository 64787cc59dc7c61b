"""The test tables, two of them also in a deterministically dirtied form.

The column texts are plain SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewarden.functions.names import TableRef
from tablewarden.plans.suite import Table

# Schema each table is reported under.
SCHEMAS = {
    "region": "sales",
    "nation": "sales",
    "customer": "sales",
    "supplier": "sales",
    "part": "sales",
    "orders": "sales",
    "lineitem": "sales",
    "events": "web",
    "pages": "web",
    "documents": "text",
    "benchmark": "text",
    "labels": "text",
    "conversations": "text",
    "embeddings": "text",
    "orders_dq": "sales",
    "customer_dq": "sales",
}

# Every row is kept; some values are spoilt: NULLs, repeated keys, bad codes, bad dates.
ORDERS_DQ = [
    "o_orderkey - CASE WHEN o_orderkey % 100 = 7 THEN 1 ELSE 0 END AS o_orderkey",
    "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
    "CASE WHEN o_orderkey % 50 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus",
    "CASE WHEN o_orderkey % 211 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice",
    "o_orderdate",
    "CASE WHEN o_orderkey % 113 = 0 THEN 'not-a-date'"
    " ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS o_orderdate_str",
    "CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN 'bad prio'"
    " ELSE o_orderpriority END AS o_orderpriority",
]

# Every row is kept; some keys are renumbered, which leaves their orders without a parent.
CUSTOMER_DQ = [
    "CASE WHEN c_custkey % 50 = 0 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey",
    "c_name",
    "c_nationkey",
    "c_acctbal",
    "c_mktsegment",
]

DIRTIED = {"orders_dq": ("orders", ORDERS_DQ), "customer_dq": ("customer", CUSTOMER_DQ)}

DIRTIED_SQL = ", ".join(
    f"{name} AS (SELECT {', '.join(columns)} FROM {base})" for name, (base, columns) in DIRTIED.items()
)


class Tables:
    """Frames by short or full name, e.g. ``orders`` or ``lake.sales.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def frame(self, name: str) -> DataFrame:
        name = name.rpartition(".")[2]
        if name not in self._frames:
            base, columns = DIRTIED.get(name, (name, None))
            frame = self.spark.read.parquet(f"{self.folder}/{base}.parquet")
            self._frames[name] = frame.selectExpr(*columns) if columns else frame
        return self._frames[name]

    def table(self, name: str) -> Table:
        return Table(ref(name), self.frame(name))


def ref(name: str) -> TableRef:
    return TableRef("lake", SCHEMAS[name], name)
