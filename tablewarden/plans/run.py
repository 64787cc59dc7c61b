"""A whole run over many tables, with its audit trail and per-table error isolation."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.errors import is_data_error
from tablewarden.functions.names import TableRef
from tablewarden.operators.layers import (
    create_gold,
    create_silver,
    failing_condition,
    land,
    quarantine_landed,
    row_rules,
)
from tablewarden.operators.profile import profile_table, rule_candidates
from tablewarden.operators.reports import final_report, run_totals
from tablewarden.operators.rules import SQL_RULES, build_row_rules
from tablewarden.operators.sketches import sketch_profile
from tablewarden.plans.rulebook import RULE_IDS, Rulebook
from tablewarden.plans.score import summarise
from tablewarden.plans.suite import Loader, Table, detail, results, table_measures, union_all
from tablewarden.sources.inventory import discover_tables, read_table
from tablewarden.sources.publication import Publication
from tablewarden.sources.store import Store

log = logging.getLogger(__name__)

KEY_RULES = ("DQ04", "DQ10", "DQ06")  # those with scans of their own
STAGED = "dq_run_results"  # results as they come; summary and detail are made from them, then they go


@dataclass
class RunOutcome:
    run_id: str
    processed: list[TableRef] = field(default_factory=list)
    failed: dict[TableRef, str] = field(default_factory=dict)
    skipped: dict[TableRef, set[str]] = field(default_factory=dict)  # checks that raise on the data


@dataclass
class Run:
    """One run: where results go, under which configuration and time stamp.

    Tables are evaluated ``tables_per_job`` at a time, in one Spark job each, and their
    few result rows are written straight to the store, so neither a lost executor nor a
    later table costs finished work. If such a job fails, its tables are taken one by
    one; if a single table fails on its data, the rules that raise are found and reported as
    WARNING (single SQL conditions are skipped) and the rest is evaluated again. A failure
    that says nothing about the data is tried once more and then fails the table: no rule
    is accused of it.

    Nothing of a call of ``tables`` is visible before all its audit tables are written; then
    they appear at once. The same calls under the same ``run_id`` leave the same rows.
    """

    spark: SparkSession
    book: Rulebook
    store: Store
    run_timestamp: Column | None = None
    load: Loader | None = None
    tables_per_job: int = 8
    run_id: str | None = None
    outcome: RunOutcome = field(default_factory=lambda: RunOutcome(f"run-{uuid4().hex}"))
    calls: int = 0

    def __post_init__(self):
        self.outcome.run_id = self.run_id = self.run_id or self.outcome.run_id
        if self.run_timestamp is None:  # one value for the whole run
            now = self.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
            self.run_timestamp = F.timestamp_micros(F.lit(now))
        self.load = self.load or self.spark.table
        self.audit = self.book.layer("audit")

    def tables(self, refs: Iterable[TableRef], read: Callable[[TableRef], DataFrame] | None = None) -> RunOutcome:
        """Evaluate and profile tables, then write summary, detail, profile, candidates, totals."""
        read = read or (lambda ref: read_table(self.spark, ref))
        self.calls += 1  # a second call writes its own tables only
        self._attempt = Publication(self.store, self.spark, f"{self.run_id}-{self.calls}", self.audit)
        self._parts = 0
        loaded = []
        for ref in refs:
            try:
                loaded.append(Table(ref, read(ref)))
            except Exception as error:
                self._failed(ref, error)
        history = self._history()
        for start in range(0, len(loaded), self.tables_per_job):
            self._evaluate(loaded[start : start + self.tables_per_job], history)
        done = [t for t in loaded if t.ref in self.outcome.processed]
        layer = self.book.layer("candidate")
        profiled = self._by_group(done, profile_table, (layer, self.book.output("profiling")))
        sketches = (layer, self.book.output("sketches"))
        sketched = [sketches] if self.book.sketches and self._by_group(done, sketch_profile, sketches) else []
        self._write_audit(done, profiled, sketched)
        return self.outcome

    def report(self, rows: int = 100) -> DataFrame | None:
        """The newest rows of the stored summary; None before the first run."""
        stored = self._history()
        return None if stored is None else final_report(stored, rows)

    def _failed(self, ref: TableRef, error: Exception) -> None:
        log.warning("table %s failed: %s", ref.full, error)
        self.outcome.failed[ref] = str(error).splitlines()[0]

    def _history(self) -> DataFrame | None:
        summary = self.book.output("summary")
        if not self.store.exists(self.spark, self.audit, summary):
            return None
        return self.store.read(self.spark, self.audit, summary)

    # evaluation

    def _stage(self, measures: DataFrame, history: DataFrame | None) -> None:
        frame = results(measures, self.book, self.run_timestamp, history)
        self._parts += 1
        self._attempt.write(frame.coalesce(1), (self.audit, STAGED), f"{self._parts}")

    def _evaluate(self, tables: Sequence[Table], history: DataFrame | None, again: bool = True) -> None:
        try:
            self._stage(union_all([table_measures(t, self.book, self.load) for t in tables]), history)
            self.outcome.processed += [t.ref for t in tables]
        except Exception as error:
            if len(tables) > 1:
                for table in tables:
                    self._evaluate([table], history)
            elif not is_data_error(error):
                if again:
                    log.warning("table %s: %s; trying once more", tables[0].ref.full, error)
                    self._evaluate(tables, history, again=False)
                else:
                    self._failed(tables[0].ref, error)
            else:
                self._evaluate_without_raising(tables[0], history, error)

    def _evaluate_without_raising(self, table: Table, history: DataFrame | None, error: Exception) -> None:
        try:
            if history is not None and not _raises(table_measures(table, self.book, self.load)):
                # the table is sound, so the history is not: the volume rule passes without it
                log.warning("table %s: %s; going on without history", table.ref.full, error)
                self._evaluate([table], None)
                return
            log.warning("table %s: %s; looking for the cause", table.ref.full, error)
            without = raising_checks(table, self.book, self.load)
            self._stage(table_measures(table, self.book, self.load, RULE_IDS, without), history)
            self.outcome.skipped[table.ref] = without
            self.outcome.processed.append(table.ref)
        except Exception as error:
            self._failed(table.ref, error)

    # profile

    def _by_group(self, tables: Sequence[Table], profile: Callable[..., DataFrame], target: tuple[str, str]) -> bool:
        """Write a kind of profile group by group; a table that cannot be profiled is left out."""
        wrote = False
        for start in range(0, len(tables), self.tables_per_job):
            group = tables[start : start + self.tables_per_job]
            attempts = [group] if len(group) == 1 else [group, *([t] for t in group)]
            for number, attempt in enumerate(attempts):
                try:
                    frame = union_all([profile(t.df, t.ref, self.run_timestamp) for t in attempt])
                    self._attempt.write(frame.coalesce(1), target, f"{start}-{number}")
                    wrote = True
                    if attempt is group:
                        break
                except Exception as error:
                    log.warning("%s of %s: %s", profile.__name__, [t.ref.full for t in attempt], error)
        return wrote

    # audit trail

    def _write_audit(self, tables: Sequence[Table], profiled: bool, more: Sequence[tuple[str, str]]) -> None:
        """Write every audit table from this call's own rows, then publish all of them at once."""
        book, spark, attempt = self.book, self.spark, self._attempt
        outcomes = [(True,)] * len(tables) + [(False,)] * len(self.outcome.failed)
        if not outcomes:
            attempt.publish([])
            return
        summary, audit, totals = ((self.audit, book.output(n)) for n in ("summary", "audit", "pipeline_runs"))
        profile, candidates = ((book.layer("candidate"), book.output(n)) for n in ("profiling", "candidates"))
        staged = (self.audit, STAGED)
        tried = spark.createDataFrame(outcomes, "processed boolean").select(
            self.run_timestamp.alias("run_timestamp"), "processed"
        )
        nothing = tried.filter(F.lit(False))
        counted = [nothing, nothing]
        counted += [nothing.withColumnRenamed("run_timestamp", f"{c}_timestamp") for c in ("profile", "created")]
        if tables:
            graded = attempt.own(staged)
            attempt.write(summarise(graded, book).coalesce(1), summary)
            attempt.write(detail(graded).coalesce(1), audit)
            counted[:2] = attempt.own(summary), attempt.own(audit)
        if profiled:
            found = rule_candidates(attempt.own(profile), book.candidate_null_pct)
            attempt.write(found.coalesce(1), candidates)
            counted[2:] = attempt.own(profile), attempt.own(candidates)
        attempt.write(run_totals(tried, *counted).coalesce(1), totals)
        attempt.publish(
            [summary, audit, totals, *more] if tables else [totals],
            # candidates also when there are none, so that they belong to the stored profile
            [profile, candidates] if profiled else [],
        )
        if tables:
            attempt.discard(staged)


def run_catalog(run: Run) -> RunOutcome:
    """Run over every table the configuration's ``framework`` section puts in scope."""
    scope = run.book.framework
    found = discover_tables(
        run.spark,
        scope["catalog"],
        scope.get("excluded_schemas", ()),
        scope.get("source_schema_allowlist", ()),
    )
    return run.tables(found)


def raising_checks(table: Table, book: Rulebook, load: Loader) -> set[str]:
    """Rules, or single SQL conditions, that raise on this table's data.

    Only called after a job failed. Raises itself if the table cannot even be counted.
    """
    table_measures(table, book, load, ["DQ16"]).write.format("noop").mode("overwrite").save()
    # row rules share one scan, so they stand together; DQ13 reads the schema, DQ16 is the count above
    one_scan = [r for r in RULE_IDS if r not in (*KEY_RULES, "DQ13", "DQ16")]
    raising: set[str] = set()
    for dq_id in bisected([*one_scan, *KEY_RULES], lambda ids: _raises(table_measures(table, book, load, ids))):
        raising |= _raising_conditions(table, book, dq_id) or {dq_id}
    return raising


def bisected(items: Sequence[str], raises: Callable[[Sequence[str]], bool], known: bool = False) -> list[str]:
    """The items that raise on their own, found with few probes of many at once.

    ``known``: that they raise together. A single item is always probed, so that a failure
    that does not come back accuses nothing.
    """
    if not items or not (known and len(items) > 1 or raises(items)):
        return []
    if len(items) == 1:
        return list(items)
    half = len(items) // 2
    first = bisected(items[:half], raises)
    return first + bisected(items[half:], raises, known=not first)


def _raising_conditions(table: Table, book: Rulebook, dq_id: str) -> set[str]:
    """SQL conditions are skipped one by one; any other rule stands or falls as a whole."""
    if dq_id not in SQL_RULES:
        return set()
    rules, _ = build_row_rules(table.df, {dq_id: book.setting(table.ref, dq_id)})
    failing = rules[dq_id].failing

    def raises(names: Sequence[str]) -> bool:
        return _raises(table.df.agg(*(F.count_if(failing[n]) for n in names)))

    return {f"{dq_id}.{name}" for name in bisected(list(failing), raises)}


def _raises(frame: DataFrame) -> bool:
    """Whether a frame raises on its data; other failures are passed on."""
    try:
        frame.write.format("noop").mode("overwrite").save()
    except Exception as error:
        if not is_data_error(error):
            raise
        log.warning("check raises: %s", str(error).splitlines()[0])
        return True
    return False


@dataclass(frozen=True)
class Promotion:
    columns: dict[str, str]
    quarantined: int
    silver: bool
    gold: bool


def promote(
    table: Table,
    book: Rulebook,
    store: Store,
    run_id: str,
    score: float,
    status: str,
    at: Column | None = None,
    without: Collection[str] = (),
) -> Promotion:
    """Take a scored table through the layers: bronze, quarantine, silver, gold.

    ``without``: what the run skipped for this table (``RunOutcome.skipped``).

    The source is read once: bronze is written in two parts, clean rows and failing ones, and
    quarantine and silver are made from what is stored.
    """
    spark = table.df.sparkSession
    condition = failing_condition(row_rules(table.df, table.ref, book, without))
    columns, failing = land(table.df, condition, table.ref, store, book, at)
    quarantined = 0
    if failing:
        quarantined = quarantine_landed(spark, table.df.columns, table.ref, store, book, run_id, at)
    bronze = store.read(spark, book.layer("bronze"), table.ref.table)
    silver = create_silver(bronze, table.ref.table, store, book, score)
    gold = create_gold(spark, table.ref.table, store, book, score, status, at) if silver else False
    return Promotion(columns, quarantined, silver, gold)
