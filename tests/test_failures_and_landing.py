"""Failures of the cluster are told from failures of the data; promotion reads its source once."""

import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tablewarden.plans.run as runs
from tablewarden import Run, Store, Table, promote
from tablewarden.functions.errors import is_data_error
from tablewarden.operators import layers
from tests.helpers import REF, book


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


@pytest.fixture
def unreadable(spark, tmp_path):
    """A table whose files are broken: every attempt to read it fails."""
    path = str(tmp_path / "unreadable")
    spark.range(10).selectExpr("cast(id as string) k").write.parquet(path)
    frame = spark.read.parquet(path)
    for file in glob.glob(f"{path}/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"no parquet at all")
    return frame


def failing_function(x):
    raise ValueError(x)


@pytest.mark.parametrize(
    "expression",
    ["1 / (id - 1)", "cast(concat('a', id) AS int)", "to_date(concat('a', id), 'yyyy')", "raise_error('x')",
     "cast(id AS string) rlike '['", "9223372036854775807L + id", "array(1)[cast(id AS int)]",
     "(SELECT id FROM range(5))"],
)
def test_errors_of_the_data(spark, expression):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception) as raised:
        spark.range(3).selectExpr(f"{expression} AS x").collect()
    assert is_data_error(raised.value)


def test_errors_of_a_function_and_of_a_plan(spark):
    with pytest.raises(PySparkException) as raised:
        spark.range(3).select(F.udf(failing_function, "int")("id")).collect()
    assert is_data_error(raised.value)
    with pytest.raises(PySparkException) as raised:
        spark.range(3).selectExpr("absent")
    assert is_data_error(raised.value)


def test_errors_of_the_cluster(unreadable):
    with pytest.raises(Exception) as raised:
        unreadable.collect()
    assert not is_data_error(raised.value)
    assert not any(map(is_data_error, (OSError("disk"), MemoryError(), RuntimeError("no state"))))


RULES = {"row_expressions": {"fine": "k IS NOT NULL"}, "unique_keys": ["k"]}
RELATION = [{"child_table": REF.full, "child_column": "k", "parent_table": "p", "parent_column": "k"}]


def test_an_unreadable_parent_accuses_no_rule(spark, store, unreadable):
    """The failure lasts, and only one rule meets it: that is not the rule's fault."""
    child = spark.createDataFrame([("1",), ("2",)], "k string")
    rules = book(RULES, relationships=RELATION)
    outcome = Run(spark, rules, store, load=lambda name: unreadable).tables([REF], lambda ref: child)
    assert not outcome.processed and not outcome.skipped and set(outcome.failed) == {REF}
    assert not store.exists(spark, "audit", "dq_audit_results")
    assert store.read(spark, "audit", "dq_pipeline_runs").first().tables_failed == 1


def test_a_failure_that_passes_is_tried_again(spark, store, monkeypatch):
    stage, calls = Run._stage, []

    def lost(self, measures, history):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        stage(self, measures, history)

    monkeypatch.setattr(Run, "_stage", lost)
    outcome = Run(spark, book(RULES), store).tables([REF], lambda ref: spark.createDataFrame([("1",)], "k string"))
    assert outcome.processed == [REF] and not outcome.skipped and len(calls) == 2


def test_a_failure_during_the_search_accuses_no_rule(spark, store, monkeypatch):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    rules = book({"row_expressions": {"raises": "CAST(k AS INT) > 0"}})
    raises, calls = runs._raises, []

    def lost(frame):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("executor lost")
        return raises(frame)

    monkeypatch.setattr(runs, "_raises", lost)
    outcome = Run(spark, rules, store).tables([REF], lambda ref: spark.createDataFrame([("x",)], "k string"))
    assert not outcome.processed and "executor lost" in outcome.failed[REF]


# --- landing ------------------------------------------------------------------------------


def counted(spark, rows, partitions=4):
    """A source that counts the rows it hands out."""
    seen = spark.sparkContext.accumulator(0)

    def hand_out(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    frame = spark.range(rows, numPartitions=partitions).selectExpr("id AS `Id`", "cast(id % 3 AS string) AS `full name`")
    return seen, frame.mapInPandas(hand_out, frame.schema)


def test_promotion_reads_the_source_once(spark, store):
    seen, source = counted(spark, 1000)
    rules = book({"row_expressions": {"small": "Id < 900"}, "mandatory_columns": ["full name"]})
    outcome = promote(Table(REF, source), rules, store, "r1", 95.0, "PASS")
    assert seen.value == 1000
    assert outcome.quarantined == 100 and outcome.silver and outcome.gold
    assert store.read(spark, "bronze", "t").columns == ["id", "full_name", *layers.LINEAGE_COLUMNS]
    assert store.read(spark, "bronze", "t").count() == store.read(spark, "gold", "t").count() == 1000
    held = store.read(spark, "quarantine", "quarantine_t")
    assert held.columns[:2] == ["Id", "full name"] and held.agg(F.min("Id"), F.count("*")).first() == (900, 100)
    assert {r.Id % 3 == int(r["full name"]) for r in held.collect()} == {True}


def test_rows_without_rules_or_failures_are_all_clean(spark, store):
    for rules in (book({}), book({"row_expressions": {"small": "Id < 900000"}})):
        seen, source = counted(spark, 50)
        outcome = promote(Table(REF, source), rules, store, "r1", 95.0, "PASS")
        assert (seen.value, outcome.quarantined) == (50, 0)
        assert not store.exists(spark, "quarantine", "quarantine_t")
        assert store.read(spark, "silver", "t").count() == 50
    empty = spark.createDataFrame([], "id int")
    assert promote(Table(REF, empty), book({"row_expressions": {"a": "id > 0"}}), store, "r1", 95.0, "PASS").quarantined == 0
    assert store.read(spark, "gold", "t").count() == 0


def test_only_the_failing_part_of_bronze_is_opened_for_quarantine(spark, store):
    condition = F.col("id") >= 95
    columns, failing = layers.land(spark.range(100), condition, REF, store, book())
    assert (columns, failing) == ({"id": "id"}, 5)
    part = store.read_routed(spark, "bronze", "t", layers.FAILING)
    assert all("_dq_route=failing" in f for f in part.inputFiles()) or "PartitionFilters: [isnotnull(_dq_route" in (
        part._jdf.queryExecution().executedPlan().toString()
    )
    assert part.count() == 5


def test_clashing_names_are_numbered_as_before():
    wide = [f"c {i % 50}" for i in range(5000)]
    names = layers.normalized_names(wide)
    assert len(set(names)) == 5000 and names[:2] == ["c_0", "c_1"] and names[50] == "c_0_1" and names[100] == "c_0_2"
    assert layers.normalized_names(["a", "a_1", "a", "a"]) == ["a", "a_1", "a_2", "a_3"]
