"""Tables that change all at once: a run writes, and one pointer makes its rows visible.

What a run writes carries the id of the attempt that wrote it, a partition of its own. Nobody
reads it before the attempt is published, which is one write: a new pointer (a file in a
directory store, a row of a table in a catalog). An attempt that dies is never seen. Publishing a
run again replaces what the same run published before, so a repeated run leaves the same rows.
Appended tables show the newest attempt of every run, replaced ones that of the last run alone.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Sequence
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.names import quote
from tablewarden.sources.files import Files

log = logging.getLogger(__name__)

ATTEMPT, PART = "_dq_attempt", "_dq_part"
POINTERS, OPEN = "_published", "_open"  # folders of a directory store
KEPT_POINTERS = 10  # older ones are of no use to any reader
BY_RUN, PUBLISHED = "by_run", "dq_published"  # suffix of data tables, and pointer table, in a catalog

Name = tuple[str, str]  # schema and table


class Pointers:
    """Who published what, in a directory store. The newest file holds the whole state."""

    def __init__(self, files: Files):
        self.files = files

    def state(self) -> tuple[int, list[dict]]:
        """Number and runs of the newest readable pointer, in order of publication."""
        for name in reversed(self.files.names(POINTERS)):
            try:
                return int(name.split(".")[0]), json.loads(self.files.read(f"{POINTERS}/{name}"))["runs"]
            except ValueError:  # one that is being written, or whose writer died
                continue
        return 0, []

    def visible(self, name: Name, runs: list[dict] | None = None) -> list[str]:
        """The attempts whose rows of a table are to be read."""
        runs = self.state()[1] if runs is None else runs
        label = ".".join(name)
        replaced = [r["attempt"] for r in runs if label in r["replaced"]]
        return replaced[-1:] or [r["attempt"] for r in runs if label in r["appended"]]

    def publish(self, run: str, attempt: str, appended: Iterable[Name], replaced: Iterable[Name]) -> list[dict]:
        """Add a run, or put it in the place of its earlier self; the runs before."""
        entry = {
            "run": run,
            "attempt": attempt,
            "appended": sorted(map(".".join, appended)),
            "replaced": sorted(map(".".join, replaced)),
        }
        while True:
            number, before = self.state()
            names = self.files.names(POINTERS)
            # a file that cannot be read keeps its number
            number = max([number, *(int(n.split(".")[0]) for n in names if n[0].isdigit())])
            text = json.dumps({"runs": [r for r in before if r["run"] != run] + [entry]})
            if self.files.create(f"{POINTERS}/{number + 1:010d}.json", text):
                break  # else another run was faster: start from its state
        for name in names[:-KEPT_POINTERS]:
            self.files.delete(f"{POINTERS}/{name}")
        return before


class Publication:
    """One attempt of a run at writing tables of a store."""

    def __init__(self, store, spark: SparkSession, run: str, home: str):
        """``home``: the schema that holds the pointer table in a catalog."""
        self.store, self.spark, self.run, self.home = store, spark, run, home
        self.attempt = uuid4().hex
        self.files = None if store.root is None else Files(spark, store.root)
        if self.files:
            self._drop_dead_attempts()
            self.files.put(f"{OPEN}/{self.attempt}.json", json.dumps({"run": run}))

    def write(self, df: DataFrame, name: Name, part: str = "0") -> None:
        """Write a part of this attempt's rows of a table; the same part again replaces it."""
        marked = df.withColumns({ATTEMPT: F.lit(self.attempt), PART: F.lit(part)})
        if self.files:
            self.store.replace_partitions(marked, *name, (ATTEMPT, PART))
        else:
            self.store.write(marked, name[0], f"{name[1]}_{BY_RUN}", "append", (ATTEMPT,))

    def own(self, name: Name) -> DataFrame:
        """What this attempt has written, published or not."""
        if self.files:
            stored = self.store.read_files(self.spark, *name)
        else:
            stored = self.spark.table(self.store.target(name[0], f"{name[1]}_{BY_RUN}"))
        return stored.filter(F.col(ATTEMPT) == self.attempt).drop(ATTEMPT, PART)

    def discard(self, name: Name) -> None:
        """Remove what this attempt wrote to a table that was only a step."""
        if self.files:
            self.files.delete(f"{name[0]}/{name[1]}/{ATTEMPT}={self.attempt}")
            return
        data = self.store.target(name[0], f"{name[1]}_{BY_RUN}")
        own = f"{ATTEMPT} = '{self.attempt}'"
        try:
            if self.store.keeps_schemas:
                self.spark.sql(f"DELETE FROM {data} WHERE {own}")
            else:
                self.spark.sql(f"ALTER TABLE {data} DROP IF EXISTS PARTITION ({own})")
        except PySparkException as error:  # a catalog that does not manage partitions
            log.warning("%s keeps the rows of attempt %s: %s", data, self.attempt, error)

    def publish(self, appended: Sequence[Name], replaced: Sequence[Name] = ()) -> None:
        """Make this attempt's rows of all these tables visible, at once."""
        if not self.files:
            self._publish_in_catalog(appended, replaced)
            return
        pointers = Pointers(self.files)
        before = pointers.publish(self.run, self.attempt, appended, replaced)
        self.files.delete(f"{OPEN}/{self.attempt}.json")
        runs = pointers.state()[1]
        for name in (*appended, *replaced):
            # a reader may have begun with what was visible until now
            keep = {*pointers.visible(name, runs), *pointers.visible(name, before), *self._open()}
            self._drop(name, lambda attempt, keep=keep: attempt not in keep)

    def _open(self) -> dict[str, str]:
        """Attempts that are not published yet, and their runs."""
        names = [n for n in self.files.names(OPEN) if n[0] != "_"]
        return {n.split(".")[0]: json.loads(self.files.read(f"{OPEN}/{n}"))["run"] for n in names}

    def _drop(self, name: Name, dead) -> None:
        for folder in self.files.names("/".join(name)):
            if folder.startswith(f"{ATTEMPT}=") and dead(folder.partition("=")[2]):
                self.files.delete(f"{name[0]}/{name[1]}/{folder}")

    def _drop_dead_attempts(self) -> None:
        """Remove what earlier attempts at this run left behind: there is one at a time."""
        gone = [attempt for attempt, run in self._open().items() if run == self.run]
        for schema in self.files.names("") if gone else ():
            for table in self.files.names(schema) if schema[0] != "_" else ():
                for attempt in gone:
                    self.files.delete(f"{schema}/{table}/{ATTEMPT}={attempt}")
        for attempt in gone:
            self.files.delete(f"{OPEN}/{attempt}.json")

    def _publish_in_catalog(self, appended: Sequence[Name], replaced: Sequence[Name]) -> None:
        pointers = self.store.target(self.home, PUBLISHED)
        labels = [[".".join(n) for n in names] for names in (appended, replaced)]
        row = self.spark.createDataFrame(
            [(self.run, self.attempt, *labels)],
            "run string, attempt string, appended array<string>, replaced array<string>",
        ).withColumn("published_at", F.current_timestamp())
        if not self.spark.catalog.tableExists(pointers):
            self.store.write(row.limit(0), self.home, PUBLISHED)
        newest = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY published_at DESC, attempt) AS _n
            FROM {pointers}) WHERE _n = 1"""
        for name in (*appended, *replaced):
            data = self.store.target(name[0], f"{name[1]}_{BY_RUN}")
            columns = ", ".join(quote(c) for c in self.spark.table(data).columns if c not in (ATTEMPT, PART))
            label = ".".join(name)
            attempts = f"SELECT attempt FROM ({newest}) WHERE array_contains(appended, '{label}')"
            if name in replaced:
                attempts = f"SELECT max_by(attempt, published_at) FROM ({newest}) WHERE array_contains(replaced, '{label}')"
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.store.target(*name)} AS"
                f" SELECT {columns} FROM {data} WHERE {ATTEMPT} IN ({attempts})"
            )
        self.store.write(row.coalesce(1), self.home, PUBLISHED, "append")
