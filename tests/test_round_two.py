"""Cases found in review: coercion of allowed values, hot parents, failing histories."""

import pytest
from pyspark.sql import functions as F

from tablewarden.functions.names import TableRef
from tablewarden.operators.datatypes import castable
from tablewarden.operators.keys import orphan_count, previous_row_counts
from tablewarden.operators.reports import kpis
from tablewarden.operators.rules import build_row_rules
from tablewarden.plans.rulebook import Rulebook
from tablewarden.plans.run import bisected
from tablewarden.plans.suite import Table, run_suite, run_suite_by_period
from tablewarden.sources.inventory import table_inventory
from tablewarden.sources.store import shared_root


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "values, allowed, failed",
    [
        ("array(1.0D, 2.0D, 3.0D)", ["1", "2", "3"], 0),
        ("array(cast(5 as decimal(10,2)))", ["5"], 0),
        ("array(timestamp'2024-01-01')", ["2024-01-01"], 0),
        ("array('01', '2', 'x')", [1, 2], 1),
        ("array(1, 2)", ["1", "x"], 1),
        ("array(1, 2)", ["1", None], 0),
    ],
)
def test_allowed_values_of_another_type(spark, ansi, values, allowed, failed):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql(f"SELECT explode({values}) AS v")
        rules, _ = build_row_rules(df, {"DQ03": {"v": allowed}})
        assert df.filter(rules["DQ03"].failing["v"]).count() == failed
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_repeated_parents_are_combined_before_the_shuffle(spark):
    child = spark.range(100).select(F.col("id").alias("k"))
    parent = spark.range(1000).select(F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("p"))
    assert orphan_count(child, "k", parent, "p").first().n == 99
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = orphan_count(child, "k", parent, "p")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("keys=[_parent_key") == 2  # partial and final


def test_history_that_is_no_number(spark):
    schema = "catalog string, schema string, table string, run_timestamp timestamp, row_count string"
    history = spark.createDataFrame([("c", "s", "t", None, "abc")], schema)
    assert previous_row_counts(history).first().previous_rows is None


def test_empty_inputs(spark):
    assert table_inventory([(TableRef("c", "s", "t"), spark.range(1))], excluded=["s"]).count() == 0
    assert castable(spark.range(1), {"absent": "int"}).count() == 0


def test_only_a_local_session_may_use_its_own_folder(spark, monkeypatch):
    class Session:
        class conf:
            @staticmethod
            def get(name, default=None):
                return "local-cluster[2,1,1024]" if name == "spark.master" else default

    with pytest.raises(ValueError):
        shared_root(Session)


def test_history_by_period_equals_a_run_per_period(spark):
    """All sixteen rules; a period that holds most rows, keys shared by periods, no period."""
    rows = [("a", i % 50, i % 7, "2024-01-01") for i in range(400)]
    rows += [("b", i, None if i % 5 == 0 else i % 9, "2024-01-02") for i in range(60)]
    rows += [(None, 3, 8, None), (None, 3, 8, None)]
    df = spark.createDataFrame(rows, "name string, id int, parent int, day string")
    parents = spark.createDataFrame([(i,) for i in range(8)] * 3, "p int")
    book = Rulebook(
        {
            "table_rules": {
                "c.s.t": {
                    "mandatory_columns": ["name"], "unique_keys": ["id"], "range_rules": {"id": {"max": 40}},
                    "expected_types": {"id": "bigint", "name": "string"},
                }
            },
            "relationships": [
                {"child_table": "c.s.t", "child_column": "parent", "parent_table": "p", "parent_column": "p",
                 "nullable_allowed": False}
            ],
        }
    )
    ref, period = TableRef("c", "s", "t"), F.to_timestamp_ntz(F.col("day"))
    fields = ("dq_id", "status", "failure_percentage", "failed_records", "row_count")
    found = run_suite_by_period([(Table(ref, df), period)], book, lambda _: parents).collect()
    assert len(found) == 48
    before = None
    for day in (None, "2024-01-01", "2024-01-02"):
        part = df.filter(F.col("day").eqNullSafe(F.lit(day)))
        history = None if before is None else spark.createDataFrame(
            [("c", "s", "t", "2000-01-01", before)], "catalog string, schema string, table string, run_timestamp string, row_count long"
        )
        alone = run_suite([Table(ref, part)], book, F.lit(None).cast("timestamp"), lambda _: parents, history).collect()
        own = [r for r in found if (str(r.run_timestamp)[:10] if r.run_timestamp else None) == day]
        assert sorted(tuple(r[f] for f in fields) for r in own) == sorted(tuple(r[f] for f in fields) for r in alone)
        before = part.count()


def test_kpis_name_dimensions_without_checks(spark):
    detail = spark.createDataFrame(
        [("c", "s", "t", "DQ01", "PASS", 0.0), ("c", "s", "t", "DQ02", "SKIPPED", 0.0)],
        "catalog string, schema string, table string, dq_id string, status string, failure_percentage double",
    )
    found = kpis(detail, Rulebook({})).collect()
    assert len(found) == 17
    assert [(r.dimension, r.checks, r.pass_rate) for r in found if r.table] == [("completeness", 1, 100.0)]
    assert {(r.checks, r.pass_rate) for r in found if not r.table} == {(1, 100.0), (0, None)}


def test_bisection_finds_what_raises_with_few_probes():
    items = [f"c{i}" for i in range(16)]
    for bad in [{"c0"}, {"c15"}, {"c3", "c12"}, set(items), set()]:
        probes = []

        def raises(some, bad=bad, probes=probes):
            probes.append(some)
            return bool(bad & set(some))

        assert set(bisected(items, raises)) == bad
        if len(bad) == 1:
            assert len(probes) <= 9
    once = iter([True])  # a failure that does not come back
    assert bisected(items, lambda some: next(once, False)) == []
