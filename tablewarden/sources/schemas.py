"""Schema registry: what columns a directory of files has, known without opening any of them.

A change of schema is a file of its own, written once and seen whole, so writers that add columns
at the same time lose none. A table's schema is that of the newest change that replaces it, and
the columns that later changes add.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import types as T

from tablewarden.sources.files import Files

FOLDER = "_schemas"


def _plain(schema: T.StructType) -> T.StructType:
    """Every column nullable, without metadata: files of other writes may lack it."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def merged(first: T.StructType, second: T.StructType, table: str = "") -> T.StructType:
    """The columns of both, those of ``first`` in front. A column of two types raises."""
    known = {f.name.lower(): f for f in first}
    added = []
    for f in second:
        before = known.get(f.name.lower())
        if before is None:
            added.append(f)
        elif before.dataType.simpleString() != f.dataType.simpleString():
            kinds = f"{before.dataType.simpleString()} and {f.dataType.simpleString()}"
            raise ValueError(f"column {f.name!r} of {table} would be both {kinds}")
    return T.StructType([*first, *added])


class SchemaRegistry:
    def __init__(self, files: Files):
        self.files = files

    def _folder(self, schema: str, table: str) -> str:
        return f"{schema}/{FOLDER}/{table}"

    def _changes(self, schema: str, table: str) -> list[str]:
        return [n for n in self.files.names(self._folder(schema, table)) if n.endswith(".json") and n[0] != "_"]

    def read(self, schema: str, table: str) -> T.StructType | None:
        """None for a table that is not registered."""
        found = None
        for name in self._changes(schema, table):
            change = json.loads(self.files.read(f"{self._folder(schema, table)}/{name}"))
            columns = T.StructType.fromJson(change["schema"])
            found = columns if found is None or change["replaces"] else merged(found, columns, f"{schema}.{table}")
        return found

    def _record(self, schema: str, table: str, columns: T.StructType, replaces: bool, before: list[str]) -> None:
        number = 1 + max((int(n.split("-")[0]) for n in before), default=0)
        text = json.dumps({"replaces": replaces, "schema": columns.jsonValue()})
        self.files.put(f"{self._folder(schema, table)}/{number:06d}-{uuid4().hex[:12]}.json", text)

    def add(self, schema: str, table: str, columns: T.StructType) -> None:
        """Before an append: make its new columns known. They are null until its rows land."""
        known, columns = self.read(schema, table), _plain(columns)
        if known is None or len(merged(known, columns, f"{schema}.{table}")) > len(known):
            self._record(schema, table, columns, False, self._changes(schema, table))

    def replace(self, schema: str, table: str, columns: T.StructType) -> None:
        """After an overwrite: the table has these columns now."""
        before = self._changes(schema, table)
        self._record(schema, table, _plain(columns), True, before)
        for name in before:
            self.files.delete(f"{self._folder(schema, table)}/{name}")
