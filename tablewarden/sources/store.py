"""Where audit frames and layers are written: directories or catalog tables.

The format is a parameter. ``parquet`` in a directory is the default. Files that do not know the
columns of other files have a schema registry beside them, so frames with new columns can be
appended and a read opens no footer to plan; ``delta`` works with both kinds where its jars are
present, and keeps its schemas itself.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.names import quote
from tablewarden.sources.files import Files
from tablewarden.sources.publication import ATTEMPT, PART, Pointers
from tablewarden.sources.schemas import SchemaRegistry

OWN_SCHEMAS = ("delta", "iceberg", "hudi")  # formats that keep the schema of a table
ROUTE = "_dq_route"  # which of several ways a row took when it was written
HIDDEN = (ATTEMPT, PART, ROUTE)  # partition columns that readers do not see


@dataclass(frozen=True)
class Store:
    """``root`` is a shared directory; without one, tables go to a catalog, if not named
    then to the session's current one."""

    root: str | None = None
    fmt: str = "parquet"
    catalog: str | None = None

    @property
    def keeps_schemas(self) -> bool:
        """Whether the format keeps the schema of a table itself."""
        return self.fmt in OWN_SCHEMAS

    def _namespace(self, schema: str) -> str:
        return ".".join(quote(part) for part in (self.catalog, schema) if part)

    def target(self, schema: str, table: str) -> str:
        if self.root is None:
            return f"{self._namespace(schema)}.{quote(table)}"
        return f"{self.root.rstrip('/')}/{schema}/{table}"

    def write(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
    ) -> str:
        target = self.target(schema, table)
        if self.root is None:
            evolution = "mergeSchema" if mode == "append" else "overwriteSchema"
            writer = df.write.format(self.fmt).mode(mode).option(evolution, "true")
            df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {self._namespace(schema)}")
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(target)
            return target
        if mode == "append":
            self._register(df, schema, table)
        writer = df.write.format(self.fmt).mode(mode)
        if self.keeps_schemas:
            writer = writer.option("mergeSchema" if mode == "append" else "overwriteSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
        if mode == "overwrite" and not self.keeps_schemas:
            SchemaRegistry(Files(df.sparkSession, self.root)).replace(schema, table, df.schema)
        return target

    def replace_partitions(self, df: DataFrame, schema: str, table: str, partition_by: Sequence[str]) -> None:
        """Replace exactly the partitions of a directory table that ``df`` has rows of."""
        self._register(df, schema, table)
        writer = df.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).save(self.target(schema, table))

    def _register(self, df: DataFrame, schema: str, table: str) -> None:
        """Make the columns of rows that will be added known to readers."""
        if self.keeps_schemas:
            return
        registry = SchemaRegistry(Files(df.sparkSession, self.root))
        if registry.read(schema, table) is None and registry.files.exists(f"{schema}/{table}"):
            # files that something else wrote: their footers are read this once
            registry.add(schema, table, self._merging_footers(df.sparkSession, schema, table).schema)
        registry.add(schema, table, df.schema)

    def _merging_footers(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        return spark.read.format(self.fmt).option("mergeSchema", "true").load(self.target(schema, table))

    def read_routed(self, spark: SparkSession, schema: str, table: str, route: str) -> DataFrame:
        """The rows that were written to one route; the others are not opened."""
        stored = spark.table(self.target(schema, table)) if self.root is None else self.read_files(spark, schema, table)
        return stored.filter(F.col(ROUTE) == route).drop(*HIDDEN)

    def read_files(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        """A directory table with all its columns and rows, published or not."""
        known = None
        if not self.keeps_schemas:
            known = SchemaRegistry(Files(spark, self.root)).read(schema, table)
        if known is None:
            return self._merging_footers(spark, schema, table)
        return spark.read.format(self.fmt).schema(known).load(self.target(schema, table))

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        """The table as readers see it: of runs that are published, without columns of storage."""
        if self.root is None:
            stored = spark.table(self.target(schema, table))
        else:
            stored = self.read_files(spark, schema, table)
            if ATTEMPT in stored.columns:
                visible = Pointers(Files(spark, self.root)).visible((schema, table))
                stored = stored.filter(F.col(ATTEMPT).isin(visible))
        return stored.drop(*HIDDEN)

    def exists(self, spark: SparkSession, schema: str, table: str) -> bool:
        """Whether there is something to read; asks the file system or the catalog, reads no data."""
        if self.root is None:
            return spark.catalog.tableExists(self.target(schema, table))
        files = Files(spark, self.root)
        if not files.exists(f"{schema}/{table}"):
            return False
        known = None if self.keeps_schemas else SchemaRegistry(files).read(schema, table)
        if known is not None and ATTEMPT in known.names:
            return bool(Pointers(files).visible((schema, table)))
        return True


def shared_root(spark: SparkSession) -> str:
    """A new directory that every executor can reach.

    It lies in the folder the session names in ``spark.checkpoint.dir``. Only a local
    session may go without that setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return f"{folder.rstrip('/')}/tablewarden-{uuid4().hex}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tablewarden-")
