"""Counts known beforehand for the test tables at sf0.01 (see FIXTURES.md)."""

import pytest

import __spark_entry__ as driver
from tests.comparison import folder

QUERIES = driver.queries()

# Failed records of the dirtied orders.
FAILED = {
    "dq01_completeness": 634,
    "dq02_accuracy": 72,
    "dq03_validity": 692,
    "dq04_uniqueness": 150,
    "dq05_consistency": 938,
    "dq06_integrity": 457,
    "dq06_integrity_nullable": 302,
    "dq07_timeliness": 133,
    "dq08_conformity": 362,
    "dq09_range": 214,
    "dq10_duplicate": 150,
    "dq11_null": 639,
    "dq12_length": 5671,
    "dq14_pattern": 392,
    "dq15_business_rule": 904,
}


@pytest.mark.parametrize("name", FAILED)
def test_failed_records(spark, name):
    rows = QUERIES[name](spark, folder("0.01")).filter("table = 'orders_dq'").collect()
    assert [r.failed_records for r in rows] == [FAILED[name]]


def test_exactly_one_percent_is_a_warning(spark):
    row = QUERIES["dq04_uniqueness"](spark, folder("0.01")).filter("table = 'orders_dq'").first()
    assert (row.failure_percentage, row.status) == (1.0, "WARNING")


def test_scores(spark):
    rows = QUERIES["dq_score"](spark, folder("0.01")).collect()
    assert {r.table: (r.dq_score, r.overall_status) for r in rows} == {
        "orders": (100.0, "PASS"),
        "customer": (85.0, "WARNING"),
        "orders_dq": (6.0, "FAIL"),
    }


def test_profile(spark):
    rows = QUERIES["profile_table"](spark, folder("0.01")).filter("table = 'orders_dq'").collect()
    assert {r.column_name: (r.null_count, r.distinct_count) for r in rows} == {
        "o_orderkey": (0, 14850),
        "o_custkey": (155, 1501),
        "o_orderstatus": (0, 4),
        "o_totalprice": (0, 15000),
        "o_orderdate": (0, 2399),
        "o_orderdate_str": (0, 2400),
        "o_orderpriority": (484, 7),
    }


def test_top_values(spark):
    rows = QUERIES["top_values"](spark, folder("0.01")).filter("column_name = 'o_orderpriority' AND rank <= 3")
    assert [(r.value, r.value_count) for r in rows.orderBy("rank").collect()] == [
        ("4-NOT SPECIFIED", 2845),
        ("3-MEDIUM", 2834),
        ("5-LOW", 2826),
    ]
