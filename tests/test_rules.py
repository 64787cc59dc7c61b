"""Edge cases of the sixteen rules on small frames."""

import math
from decimal import Decimal

import pytest

from tablewarden import Rulebook, Table
from tablewarden.functions.names import TableRef, resolve, safe_name
from tablewarden.operators.datatypes import type_matches
from tests.helpers import REF, graded

PASS = ("PASS", 0.0, 0)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "ann", 10.0), (2, "bob", None), (2, None, -1.0), (None, "dee", 99.0)]
    return spark.createDataFrame(rows, "id int, name string, score double")


def test_nothing_configured_passes(people):
    assert graded(people) == {f"DQ{i:02d}": PASS for i in range(1, 17)}


def test_completeness_counts_each_row_once(people):
    assert graded(people, {"mandatory_columns": ["id", "name", "score"]}, ["DQ01"])["DQ01"] == ("FAIL", 75.0, 3)


def test_completeness_without_a_column_fails_every_row(people):
    assert graded(people, {"mandatory_columns": ["id", "gone"]}, ["DQ01"])["DQ01"] == ("FAIL", 100.0, 4)


def test_null_condition_fails(people):
    result = graded(people, {"row_expressions": {"a": "score >= 0"}}, ["DQ02"])
    assert result["DQ02"] == ("FAIL", 50.0, 2)


@pytest.mark.parametrize(
    "condition",
    [
        "no_such_column > 1",
        "score >",
        "id",
        "name",
        "count(*) > 0",
        "row_number() OVER (ORDER BY id) > 1",
        "explode(array(true))",
    ],
)
def test_unusable_condition_is_skipped(people, condition):
    assert graded(people, {"row_expressions": {"bad": condition}}, ["DQ02"])["DQ02"] == PASS
    both = {"row_expressions": {"bad": condition, "good": "id = 1"}}
    assert graded(people, both, ["DQ02"])["DQ02"] == ("FAIL", 75.0, 3)


def test_null_condition_literal_fails_all(people):
    assert graded(people, {"business_rules": {"n": "NULL"}}, ["DQ15"])["DQ15"] == ("FAIL", 100.0, 4)


def test_condition_with_subquery(people):
    people.createOrReplaceTempView("people_for_subquery")
    rules = {"row_expressions": {"in": "id IN (SELECT id FROM people_for_subquery WHERE score > 0)"}}
    assert graded(people, rules, ["DQ02"])["DQ02"] == ("FAIL", 75.0, 3)


def test_condition_only_a_filter_takes(people):
    rules = {"row_expressions": {"random": "rand() >= 0 AND id = 1", "plain": "id = 2"}}
    assert graded(people, rules, ["DQ02"])["DQ02"] == ("FAIL", 125.0, 5)


def test_allowed_values(people):
    def check(values):
        return graded(people, {"allowed_values": {"name": values}}, ["DQ03"])["DQ03"]

    assert check(["ann", "bob"]) == ("FAIL", 25.0, 1)  # NULL is not a violation
    assert check(["ann", None]) == PASS  # a NULL in the list never fails
    assert check([]) == ("FAIL", 75.0, 3)


def test_allowed_values_of_another_type_compare_as_text(people):
    assert graded(people, {"allowed_values": {"id": ["1", "x"]}}, ["DQ03"])["DQ03"] == ("FAIL", 50.0, 2)
    assert graded(people, {"allowed_values": {"name": [1, 2]}}, ["DQ03"])["DQ03"] == ("FAIL", 75.0, 3)


def test_absent_columns_add_the_table_and_may_exceed_100(people):
    assert graded(people, {"allowed_values": {"x": [1], "y": [2]}}, ["DQ03"])["DQ03"] == ("FAIL", 200.0, 8)
    assert graded(people, {"range_rules": {"x": {"min": 1}}}, ["DQ09"])["DQ09"] == ("FAIL", 100.0, 4)
    assert graded(people, {"length_rules": {"x": {"min": 1}}}, ["DQ12"])["DQ12"] == ("FAIL", 100.0, 4)
    assert graded(people, {"pattern_rules": {"x": "a"}}, ["DQ14"])["DQ14"] == ("FAIL", 100.0, 4)


def test_uniqueness_counts_null_as_a_value_and_is_shared(people):
    both = graded(people, {"unique_keys": ["id"]}, ["DQ04", "DQ10"])
    assert both == {"DQ04": ("FAIL", 25.0, 1), "DQ10": ("FAIL", 25.0, 1)}


def test_uniqueness_of_long_text(spark):
    long = "x" * 100
    df = spark.createDataFrame([(long + "a",), (long + "a",), (long + "b",), (None,), ("s",)], "t string")
    assert graded(df, {"unique_keys": ["t"]}, ["DQ04"])["DQ04"] == ("FAIL", 20.0, 1)
    binary = df.selectExpr("CAST(t AS BINARY) AS t")
    assert graded(binary, {"unique_keys": ["t"]}, ["DQ04"])["DQ04"] == ("FAIL", 20.0, 1)


def test_uniqueness_with_keys_of_their_own(people):
    rules = {"DQ04": {"unique_keys": ["id"]}, "DQ10": {"unique_keys": ["id", "name"]}}
    assert graded(people, rules, ["DQ04", "DQ10"]) == {"DQ04": ("FAIL", 25.0, 1), "DQ10": PASS}


def test_flat_property_wins_over_nested(people):
    rules = {"unique_keys": ["name"], "DQ04": {"unique_keys": ["id"]}}
    assert graded(people, rules, ["DQ04"])["DQ04"] == PASS


def test_uniqueness_without_a_key_fails(people):
    assert graded(people, {"unique_keys": ["id", "gone"]}, ["DQ04"])["DQ04"] == ("FAIL", 100.0, 4)


def test_timeliness_uses_the_first_column_there_is(spark):
    df = spark.createDataFrame([("2024-02-30", "x"), ("2024-02-28", "y"), (None, "z")], "d string, e string")
    assert graded(df, {"date_columns": ["gone", "d", "e"]}, ["DQ07"])["DQ07"] == ("FAIL", 1 / 3 * 100, 1)
    assert graded(df, {"date_columns": ["gone"]}, ["DQ07"])["DQ07"] == ("FAIL", 100.0, 3)


def test_range_bounds_are_inclusive_and_nan_is_above_max(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (math.nan,), (None,)], "v double")
    assert graded(df, {"range_rules": {"v": {"min": 0, "max": 5}}}, ["DQ09"])["DQ09"] == ("FAIL", 25.0, 1)
    assert graded(df, {"range_rules": {"v": {}}}, ["DQ09"])["DQ09"] == PASS


def test_range_on_text_ignores_what_is_no_number(spark):
    df = spark.createDataFrame([("7",), ("-1",), ("seven",)], "v string")
    assert graded(df, {"range_rules": {"v": {"min": 0}}}, ["DQ09"])["DQ09"] == ("FAIL", 1 / 3 * 100, 1)


def test_null_rule_is_per_cell(people):
    assert graded(people, {"null_columns": ["id", "name"]}, ["DQ11"])["DQ11"] == ("FAIL", 25.0, 2)
    assert graded(people, {"null_columns": ["id", "gone"]}, ["DQ11"])["DQ11"] == ("FAIL", 62.5, 5)
    assert graded(people, {"null_columns": ["id", "id"]}, ["DQ11"])["DQ11"] == ("FAIL", 25.0, 2)


def test_pattern_finds_anywhere(people):
    assert graded(people, {"pattern_rules": {"name": "n|b"}}, ["DQ14"])["DQ14"] == ("FAIL", 25.0, 1)


@pytest.mark.parametrize(
    ("actual", "expected", "fits"),
    [
        ("decimal(10,2)", "double", True),
        ("float", "DoubleType", True),
        ("timestamp_ntz", "timestamp", True),
        ("timestamp", "date", False),
        ("bigint", "int", False),
        ("int", "integer", True),
        ("array<int>", "array<int>", True),
        ("string", "StringType", True),
    ],
)
def test_type_matches(actual, expected, fits):
    assert type_matches(actual, expected) is fits


def test_data_types_count_columns_not_rows(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"))], "a int, b decimal(10,2)")
    rules = {"expected_types": {"a": "int", "b": "double", "c": "string", "A": "int"}}
    assert graded(df, rules, ["DQ13"])["DQ13"] == ("FAIL", 25.0, 1)


def test_rule_that_cannot_be_analysed_is_a_warning(spark):
    df = spark.createDataFrame([([1, 2],), ([3],)], "a array<int>")
    rules = {"length_rules": {"a": {"min": 1}}, "mandatory_columns": ["a"]}
    assert graded(df, rules, ["DQ01", "DQ12"]) == {"DQ01": PASS, "DQ12": ("WARNING", 0.0, 0)}


def test_disabled_rule_is_skipped(people):
    rules = [dict(r) for r in Rulebook().rules.values()]
    rules[0].update(enabled=False, default_weight=0)
    rules[1].update(default_weight=20)
    result = graded(people, {"mandatory_columns": ["id"]}, ["DQ01"], dq_rules=rules)
    assert result["DQ01"] == ("SKIPPED", 0.0, 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, name string")
    rules = {
        "mandatory_columns": ["id", "gone"],
        "row_expressions": {"a": "id > 0"},
        "unique_keys": ["gone"],
        "date_columns": ["gone"],
        "null_columns": ["id"],
        "length_rules": {"id": {"min": 1}},
        "expected_types": {"id": "string"},
    }
    expected = {f"DQ{i:02d}": PASS for i in range(1, 17)} | {
        "DQ01": ("WARNING", 100.0, 0),
        "DQ04": ("FAIL", 100.0, 0),
        "DQ07": ("FAIL", 100.0, 0),
        "DQ13": ("FAIL", 100.0, 1),
        "DQ16": ("FAIL", 100.0, 0),
        "DQ10": ("FAIL", 100.0, 0),
    }
    assert graded(df, rules) == expected


def test_many_columns(spark):
    df = spark.range(2).selectExpr(*(f"IF(id = {i % 2}, NULL, id) AS c{i}" for i in range(400)))
    rules = {"mandatory_columns": df.columns, "null_columns": df.columns}
    assert graded(df, rules, ["DQ01", "DQ11"]) == {"DQ01": ("FAIL", 100.0, 2), "DQ11": ("FAIL", 50.0, 400)}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_of_other_types_do_not_depend_on_ansi_mode(spark, ansi):
    saved = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("1", "2024-01-01", 1), ("x", "soon", 2)], "t string, d string, n int")
        rules = {
            "allowed_values": {"t": [1], "n": ["1"]},
            "range_rules": {"t": {"max": 0}},
            "date_columns": ["d"],
            "length_rules": {"n": {"min": 2}},
        }
        found = graded(df, rules, ["DQ03", "DQ07", "DQ09", "DQ12"])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", saved)
    assert {d: failed for d, (_, _, failed) in found.items()} == {"DQ03": 2, "DQ07": 1, "DQ09": 1, "DQ12": 2}


# --- foreign keys ------------------------------------------------------------------


def relation(**changes):
    return {
        "child_table": REF.full,
        "child_column": "k",
        "parent_table": "parents",
        "parent_column": "k",
        **changes,
    }


@pytest.fixture(scope="module")
def keys(spark):
    child = spark.createDataFrame([(1,), (1,), (7,), (7,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    return child, parent


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, ("FAIL", 40.0, 2)),
        ({"nullable_allowed": False}, ("FAIL", 60.0, 3)),
        ({"child_column": "gone", "nullable_allowed": False}, ("FAIL", 100.0, 5)),
        ({"parent_column": "gone", "nullable_allowed": False}, ("FAIL", 100.0, 5)),
    ],
)
def test_foreign_key(keys, changes, expected):
    child, parent = keys
    result = graded(child, only=["DQ06"], load=lambda name: parent, relationships=[relation(**changes)])
    assert result["DQ06"] == expected


def test_foreign_keys_add_up(keys):
    child, parent = keys
    both = [relation(), relation(nullable_allowed=False)]
    assert graded(child, only=["DQ06"], load=lambda n: parent, relationships=both)["DQ06"] == ("FAIL", 100.0, 5)


def test_missing_parent_table_is_a_warning(keys):
    result = graded(keys[0], only=["DQ06"], relationships=[relation(parent_table="no_such_table")])
    assert result["DQ06"] == ("WARNING", 0.0, 0)


def test_relationships_of_other_tables_are_ignored(keys):
    result = graded(keys[0], only=["DQ06"], relationships=[relation(child_table="lake.unit.other")])
    assert result["DQ06"] == PASS


def test_text_child_key_against_numbers(spark, keys):
    child = spark.createDataFrame([("1",), ("x",), (None,)], "k string")
    result = graded(child, only=["DQ06"], load=lambda n: keys[1], relationships=[relation()])
    assert result["DQ06"] == ("FAIL", 1 / 3 * 100, 1)
    result = graded(keys[0], only=["DQ06"], load=lambda n: child, relationships=[relation()])
    assert result["DQ06"] == ("FAIL", 40.0, 2)


# --- volume -------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("previous", "expected"),
    [
        (100, ("PASS", 0.0, 0)),
        (87, ("PASS", 13 / 87 * 100, 0)),
        (80, ("WARNING", 25.0, 0)),
        (200, ("FAIL", 50.0, 0)),
        (50, ("FAIL", 100.0, 0)),
        (0, PASS),
        (None, PASS),
    ],
)
def test_volume_against_newest_run(spark, previous, expected):
    rows = [("2026-01-01", 10), ("2026-01-03", previous), ("2026-01-02", 20)]
    history = spark.createDataFrame(
        [(*REF, day, n) for day, n in rows] + [("lake", "unit", "other", "2026-01-09", 1)],
        "catalog string, schema string, table string, run_timestamp string, row_count long",
    )
    assert graded(spark.range(100).toDF("id"), only=["DQ16"], history=history) == {"DQ16": expected}


def test_volume_with_useless_history_passes(spark):
    history = spark.range(3).toDF("x")
    assert graded(spark.range(5).toDF("id"), only=["DQ16"], history=history)["DQ16"] == PASS


def test_bounds_of_volume_status(spark):
    for n, status in ((115, "PASS"), (116, "WARNING"), (130, "WARNING"), (131, "FAIL")):
        history = spark.createDataFrame(
            [(*REF, "2026-01-01", 100)],
            "catalog string, schema string, table string, run_timestamp string, row_count long",
        )
        assert graded(spark.range(n).toDF("id"), only=["DQ16"], history=history)["DQ16"][0] == status


# --- names and configuration -----------------------------------------------------------


def test_columns_with_dots_and_blanks(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "`a.b` int, `c d` string")
    rules = {"unique_keys": ["a.b"], "mandatory_columns": ["c d"], "pattern_rules": {"c d": "y"}}
    result = graded(df, rules, ["DQ01", "DQ04", "DQ14"])
    assert result == {d: ("FAIL", 50.0, 1) for d in ("DQ01", "DQ04", "DQ14")}


def test_safe_names():
    assert [safe_name(n) for n in ("A B", "1x", "", "a.b", "__x__y_", "é")] == [
        "a_b",
        "_1x",
        "column",
        "a_b",
        "x_y",
        "column",
    ]
    assert resolve(["a_b", "C"], "A B") == "a_b"
    assert resolve(["a_b", "C"], "c") is None


def test_rulebook_checks_its_input():
    with pytest.raises(ValueError, match="in order"):
        Rulebook({"dq_rules": []})
    with pytest.raises(ValueError, match="pass must lie above"):
        Rulebook({"overall_thresholds": {"pass": 75, "warning": 75}})
    rules = [dict(r) for r in Rulebook().rules.values()]
    rules[3]["default_weight"] = -8
    with pytest.raises(ValueError, match="negative"):
        Rulebook({"dq_rules": rules})
    rules[3]["default_weight"] = 9
    with pytest.raises(ValueError, match="total 100"):
        Rulebook({"dq_rules": rules})


def test_names_are_quoted():
    assert TableRef("a", "b`c", "d").quoted == "`a`.`b``c`.`d`"
    assert Table(REF, None).ref.full == "lake.unit.t"
