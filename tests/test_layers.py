from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tablewarden import Rulebook, Run, Store, Table, TableRef, promote, run_catalog
from tablewarden.operators import layers
from tablewarden.sources.inventory import discover_tables, in_scope, read_table, table_inventory
from tablewarden.sources.store import shared_root
from tests.helpers import REF, book


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path))


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([(1, "ann"), (2, None), (-3, "cy")], "Id int, `full name` string")


RULES = {"mandatory_columns": ["full name", "absent"], "null_columns": ["full name"], "range_rules": {"Id": {"min": 0}}}


def test_normalized_names_do_not_clash():
    assert layers.normalized_names(["A B", "a_b", "a_b_1", "a b"]) == ["a_b", "a_b_1", "a_b_1_1", "a_b_2"]
    assert layers.normalized_names(["1x", "", "a.b"]) == ["_1x", "column", "a_b"]


def test_normalization_keeps_values_in_place(spark):
    df, mapping = layers.normalize_columns(spark.createDataFrame([(1, 2)], "`A B` int, a_b int"))
    assert df.collect()[0].asDict() == {"a_b": 1, "a_b_1": 2}
    assert mapping == {"A B": "a_b", "a_b": "a_b_1"}


def test_promotion_through_all_layers(spark, people, store):
    rules = book(RULES)
    outcome = promote(Table(REF, people), rules, store, "r1", 95.0, "PASS")
    assert outcome == layers_outcome({"Id": "id", "full name": "full_name"}, 2, True, True)
    bronze = store.read(spark, "bronze", "t")
    assert bronze.columns == ["id", "full_name", *layers.LINEAGE_COLUMNS]
    assert store.read(spark, "silver", "t").columns == ["id", "full_name"]
    gold = store.read(spark, "gold", "t")
    assert gold.columns[2:] == ["_dq_quality_score", "_dq_overall_status", "_dq_gold_timestamp"]
    held = store.read(spark, "quarantine", "quarantine_t")
    assert {(r.Id, r._dq_run_id, r._dq_source_table) for r in held.collect()} == {
        (2, "r1", REF.full),
        (-3, "r1", REF.full),
    }


def layers_outcome(columns, quarantined, silver, gold):
    from tablewarden.plans.run import Promotion

    return Promotion(columns, quarantined, silver, gold)


def test_gate_blocks_silver_and_gold(spark, people, store):
    outcome = promote(Table(REF, people), book(), store, "r1", 89.99, "WARNING")
    assert (outcome.silver, outcome.gold, outcome.quarantined) == (False, False, 0)
    assert store.exists(spark, "bronze", "t") and not store.exists(spark, "silver", "t")
    assert not layers.create_gold(spark, "t", store, book(), 100.0, "PASS")
    open_gate = book(quality_gate={"enabled": False})
    assert promote(Table(REF, people), open_gate, store, "r1", 0.0, "FAIL").gold


def test_quarantine_appends_and_writes_nothing_without_failures(spark, people, store):
    condition = F.col("Id") < 0
    args = (REF, store, book())
    assert layers.create_quarantine(people, None, *args, "r0") == 0
    assert layers.create_quarantine(people, F.col("Id") > 99, *args, "r0") == 0
    assert not store.exists(spark, "quarantine", "quarantine_t")
    assert layers.create_quarantine(people, condition, *args, "r1") == 1
    assert layers.create_quarantine(people, condition, *args, "r2") == 1
    assert store.read(spark, "quarantine", "quarantine_t").count() == 2


def test_failure_reasons(people):
    rules = layers.row_rules(people, REF, book(RULES))
    found = people.select("Id", layers.failure_reasons(rules).alias("why")).collect()
    assert {r.Id: r.why for r in found} == {1: [], 2: ["DQ11"], -3: ["DQ09"]}


def test_store_merges_columns_on_append(spark, store):
    store.write(spark.createDataFrame([(1,)], "a int"), "s", "t", "append")
    store.write(spark.createDataFrame([(2, "x")], "a int, b string"), "s", "t", "append")
    assert {tuple(r) for r in store.read(spark, "s", "t").collect()} == {(1, None), (2, "x")}


def test_store_in_the_catalog(spark):
    store = Store()
    store.write(spark.range(3), "unit_store", "t")
    store.write(spark.range(2).toDF("other"), "unit_store", "t")
    assert store.read(spark, "unit_store", "t").columns == ["other"]
    assert store.exists(spark, "unit_store", "t") and not store.exists(spark, "unit_store", "none")
    spark.range(1).createOrReplaceTempView("a_temporary_view")
    found = discover_tables(spark, "spark_catalog", excluded=["DEFAULT"], allowed=["Unit_Store"])
    assert found == [TableRef("spark_catalog", "unit_store", "t")]
    assert read_table(spark, found[0]).count() == 2
    with pytest.raises(RuntimeError, match="cannot read"):
        read_table(spark, TableRef("spark_catalog", "unit_store", "none"))
    with pytest.raises(ValueError, match="does not exist"):
        discover_tables(spark, "no_such_catalog")


def test_scope_ignores_case():
    assert in_scope("Sales", ["WEB"], ["SALES"]) and not in_scope("web", ["WEB"]) and not in_scope("x", (), ["y"])


def test_inventory_lists_empty_tables(spark):
    empty = spark.createDataFrame([], "a int, b int")
    rows = table_inventory([(REF, empty), (TableRef("c", "s", "u"), spark.range(4))]).collect()
    assert {tuple(r) for r in rows} == {("unit", "t", 0, 2), ("s", "u", 4, 1)}


def test_shared_root_follows_the_session(spark):
    assert shared_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", ""])
def test_a_cluster_must_name_its_shared_folder(master):
    settings = {"spark.master": master}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session)


# --- runs over many tables ----------------------------------------------------------------


def audit(spark, store, name):
    return store.read(spark, "audit", name)


def test_a_failing_table_does_not_stop_the_others(spark, people, store):
    good, bad, gone = (TableRef("lake", "unit", n) for n in ("good", "bad", "gone"))
    raising = spark.range(3).select(F.expr("id / (id - 1)").alias("x"), F.raise_error(F.lit("corrupt")).alias("y"))
    frames = {good: people, bad: raising.filter("y IS NULL")}
    outcome = Run(spark, book(), store).tables([good, bad, gone], lambda ref: frames[ref])
    assert outcome.processed == [good] and set(outcome.failed) == {bad, gone}
    assert audit(spark, store, "dq_summary").count() == 1
    totals = audit(spark, store, "dq_pipeline_runs").drop("run_timestamp").collect()[0].asDict()
    assert totals == {
        "tables_discovered": 3,
        "tables_processed": 1,
        "tables_failed": 2,
        "summary_records": 1,
        "detail_records": 16,
        "profile_records": 2,
        "candidate_records": 1,
    }


def test_a_raising_rule_is_isolated(spark, store):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    df = spark.createDataFrame([("1", "x"), ("two", None)], "n string, s string")
    rules = book(
        {
            "row_expressions": {"raises": "CAST(n AS INT) > 0", "fine": "s IS NOT NULL"},
            "mandatory_columns": ["s"],
            "unique_keys": ["n"],
        },
        relationships=[
            {"child_table": REF.full, "child_column": "n", "parent_table": "p", "parent_column": "k"},
        ],
    )
    broken_parent = spark.range(2).select(F.raise_error(F.lit("corrupt")).cast("string").alias("k"))
    outcome = Run(spark, rules, store, load=lambda name: broken_parent).tables([REF], lambda ref: df)
    assert outcome.processed == [REF] and not outcome.failed
    found = {r.dq_id: (r.status, r.failed_records) for r in audit(spark, store, "dq_audit_results").collect()}
    assert found["DQ01"] == ("FAIL", 1) and found["DQ02"] == ("FAIL", 1)
    assert found["DQ06"] == ("WARNING", 0) and found["DQ04"] == ("PASS", 0)


def test_second_run_sees_the_first_as_history(spark, store):
    for day, n in ((1, 100), (2, 125), (3, 300)):
        at = F.lit(datetime(2026, 1, day))
        Run(spark, book(), store, at, tables_per_job=1).tables([REF], lambda ref, n=n: spark.range(n))
    rows = audit(spark, store, "dq_summary").orderBy("run_timestamp").select("row_count", "dq16", "dq_score").collect()
    assert [tuple(r) for r in rows] == [(100, "PASS", 100.0), (125, "WARNING", 99.0), (300, "FAIL", 99.0)]
    assert audit(spark, store, "dq_audit_results").count() == 48
    assert store.read(spark, "candidate", "dq_profile").count() == 1  # overwritten by each run


def test_a_bad_pattern_is_isolated(spark, store):
    rules = book({"pattern_rules": {"id": "["}, "range_rules": {"id": {"min": 1}}})
    Run(spark, rules, store).tables([REF], lambda ref: spark.range(4))
    found = {r.dq_id: r.status for r in audit(spark, store, "dq_audit_results").collect()}
    assert (found["DQ14"], found["DQ09"], found["DQ01"]) == ("WARNING", "FAIL", "PASS")


def test_run_over_a_catalog(spark, store):
    Store().write(spark.range(3), "unit_catalog", "one")
    Store().write(spark.range(5), "unit_catalog", "two")
    scope = {"catalog": "spark_catalog", "source_schema_allowlist": ["UNIT_CATALOG"]}
    run = Run(spark, Rulebook({"framework": scope}), store)
    assert run.report() is None
    assert {ref.table for ref in run_catalog(run).processed} == {"one", "two"}
    assert {(r.table, r.row_count) for r in run.report().collect()} == {("one", 3), ("two", 5)}


def test_run_over_nothing_writes_nothing(spark, store):
    outcome = Run(spark, book(), store).tables([])
    assert not outcome.processed and not outcome.failed
    assert not store.exists(spark, "audit", "dq_summary")


def test_run_into_a_catalog(spark):
    store, scope = Store(catalog="spark_catalog"), {"audit_schema": "unit_audit", "candidate_schema": "unit_profiles"}
    for n in (3, 4):
        Run(spark, Rulebook({"framework": scope}), store).tables([REF], lambda ref, n=n: spark.range(n))
    assert store.read(spark, "unit_audit", "dq_summary").count() == 2
    assert spark.table("unit_audit.dq_audit_results").count() == 32
    assert spark.table("unit_profiles.dq_profile").collect()[0].row_count == 4
