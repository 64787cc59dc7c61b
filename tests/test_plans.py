"""The physical plans are the ones intended: scans, shuffles and joins."""

import re

import pytest

import __spark_entry__ as driver
from tablewarden.operators.keys import distinct_count, orphan_count
from tests.comparison import folder
from workload.queries import profiles, suite
from workload.tables import Tables

LAZY = ["dq_suite", "dq_all_tables", "profile_table", "top_values", "quarantine_reasons", "v_dq_kpis", "dq16_volume"]


@pytest.fixture
def static(spark):
    """Plans as they are planned: no adaptive execution, no broadcast joins."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    yield Tables(spark, folder("0.001"))
    for key, value in saved.items():
        spark.conf.set(key, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(text, table):
    return [line for line in text.splitlines() if "FileScan" in line and f"/{table}.parquet" in line]


def columns_read(scan):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)))


def test_suite_scans_the_table_once_and_its_keys(static):
    read = sorted((columns_read(s) for s in scans(plan(suite(static, ["lineitem"])), "lineitem")), key=len)
    assert read[:3] == [{"l_orderkey"}, {"l_partkey"}, {"l_orderkey", "l_linenumber"}] or read[:3] == [
        {"l_partkey"},
        {"l_orderkey"},
        {"l_orderkey", "l_linenumber"},
    ]
    assert len(read) == 4


def test_profile_reads_each_column_once(spark, static):
    read = [columns_read(s) for s in scans(plan(profiles(spark, folder("0.001"), ["lineitem"])), "lineitem")]
    assert sum(map(len, read)) == len(set().union(*read)) == 11
    assert len(read) == 4  # bigint, double, string, timestamp


def test_profile_counts_by_hash(spark, static):
    assert "SortAggregate" not in plan(profiles(spark, folder("0.001"), ["lineitem"]))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(driver.queries()[name](spark, folder("0.001")))
    for operator in ("Python", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text


def test_foreign_key_shuffles_counted_keys_once(static):
    frame = orphan_count(static.frame("lineitem"), "l_partkey", static.frame("part"), "p_partkey")
    text = plan(frame)
    assert text.count("Exchange hashpartitioning") == 2  # one per side
    assert text.index("SortMergeJoin") < text.index("HashAggregate(keys=[l_partkey")
    assert "partial_count" in text.split("Exchange hashpartitioning(l_partkey")[1]  # counted before the shuffle


def test_small_parent_is_broadcast_below_the_aggregate(spark):
    tables = Tables(spark, folder("0.001"))
    text = plan(orphan_count(tables.frame("lineitem"), "l_partkey", tables.frame("part"), "p_partkey"))
    assert text.index("HashAggregate(keys=[l_partkey") < text.index("BroadcastHashJoin")


def test_repeated_keys_are_dropped_before_the_shuffle(static):
    text = plan(distinct_count(static.frame("lineitem"), ["l_orderkey", "l_linenumber"]))
    below = text.split("Exchange hashpartitioning")[1]
    assert "HashAggregate(keys=[" in below


def test_history_is_combined_before_the_shuffle(static):
    history = static.frame("orders").selectExpr(
        "'lake' AS catalog",
        "'sales' AS schema",
        "'orders' AS table",
        "o_orderdate AS run_timestamp",
        "o_orderkey AS row_count",
    )
    assert "partial_max_by" in plan(suite(static, ["orders"], history=history))
