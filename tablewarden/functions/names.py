"""Table and column naming: safe names, column look-up, quoting."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class TableRef(NamedTuple):
    """Three-part table name. The parts are also carried as data in every audit frame."""

    catalog: str
    schema: str
    table: str

    @property
    def full(self) -> str:
        return ".".join(self)

    @property
    def quoted(self) -> str:
        return ".".join(quote(part) for part in self)


def quote(identifier: str) -> str:
    return "`" + str(identifier).replace("`", "``") + "`"


def col(name: str) -> Column:
    """``F.col`` that survives dots, blanks and backticks in ``name``."""
    return F.col(quote(name))


def safe_name(name: str) -> str:
    """Lower-case identifier of ASCII letters, digits and single inner underscores."""
    words = re.sub(r"[^A-Za-z0-9]+", "_", str(name)).strip("_").lower() or "column"
    return f"_{words}" if words[0].isdigit() else words


def resolve(columns: Sequence[str], name: str) -> str | None:
    """The column meant by ``name``: itself, else its safe name, else None (case matters)."""
    return next((c for c in (name, safe_name(name)) if c in columns), None)
