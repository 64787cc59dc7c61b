import math

from pyspark.sql import functions as F

from tablewarden.operators.profile import profile_table, rule_candidates, top_values
from tests.helpers import REF


def profiled(df):
    return {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in profile_table(df, REF).collect()}


def test_null_is_a_distinct_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "i int, s string")
    assert profiled(df) == {"i": (3, 0, 2), "s": (3, 2, 2)}


def test_equal_values_across_representations(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 1), (math.nan, 2), (math.nan, 2)], "d double, i int")
    assert profiled(df) == {"d": (4, 0, 2), "i": (4, 0, 2)}


def test_every_type_can_be_profiled(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1Y, 2S, 3, 4L, 1.5F, 2.50BD, true, DATE'2024-01-01', TIMESTAMP'2024-01-01', X'0A',
         array(1), map('k', 1), named_struct('m', map('k', 1)), parse_json('{"a": 1}')),
        (1Y, 2S, 3, 4L, 1.5F, 2.50BD, true, DATE'2024-01-01', TIMESTAMP'2024-01-01', X'0A',
         array(1), map('k', 1), named_struct('m', map('k', 1)), parse_json('{"a": 1}')),
        (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)
        AS t(a, b, c, d, e, f, g, h, i, j, k, l, m, n)"""
    )
    assert set(profiled(df).values()) == {(3, 1, 2)}


def test_empty_table_has_a_profile(spark):
    df = spark.createDataFrame([], "i int, s string")
    rows = profile_table(df, REF).collect()
    assert {(r.column_name, r.data_type, r.row_count, r.null_percentage, r.distinct_count) for r in rows} == {
        ("i", "int", 0, 0.0, 0),
        ("s", "string", 0, 0.0, 0),
    }


def test_all_null_column_gets_both_candidates(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2)], "n int, one int, two int")
    found = {(r.column_name, r.candidate_rule, r.reason) for r in rule_candidates(profile_table(df, REF)).collect()}
    assert found == {
        ("n", "NULL_CHECK", "Null percentage exceeds 1.0%"),
        ("n", "LOW_CARDINALITY", "Column contains one distinct value"),
        ("one", "LOW_CARDINALITY", "Column contains one distinct value"),
    }


def test_threshold_is_exclusive_and_a_single_row_is_no_candidate(spark):
    df = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    assert rule_candidates(profile_table(df, REF)).isEmpty()
    assert rule_candidates(profile_table(df, REF), 0.5).count() == 1
    assert rule_candidates(profile_table(spark.range(1), REF)).isEmpty()


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), ("c", 9), ("c", 10), (None, 2)], "s string, n int")
    found = [tuple(r) for r in top_values(df, 2).orderBy("column_name", "rank").collect()]
    assert found == [("n", "9", 2, 1), ("n", "10", 2, 2), ("s", "c", 2, 1), ("s", "a", 1, 2)]
    assert top_values(df, 2, ["s"]).count() == 2


def test_ranking_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS a", "id AS b")
    plan = top_values(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_wide_table(spark):
    df = spark.range(3).select(*(F.expr(f"id % {i + 1} AS c{i}") for i in range(150)))
    assert profiled(df) == {f"c{i}": (3, 0, min(i + 1, 3)) for i in range(150)}


def test_profile_of_nested_maps_and_variants(spark):
    """Maps are equal whatever the order of entries; microseconds and nested variants count."""
    frame = spark.sql(
        """SELECT map('a', 1, 'b', 2) AS m, named_struct('v', parse_json('{"x": 1}')) AS v,
            named_struct('m', map('k', timestamp'2024-01-01 00:00:00.000001')) AS t, array(map('a', 1, 'b', 2)) AS r
        UNION ALL SELECT map('b', 2, 'a', 1), named_struct('v', parse_json('{"x": 2}')),
            named_struct('m', map('k', timestamp'2024-01-01 00:00:00.000002')), array(map('b', 2, 'a', 1))
        UNION ALL SELECT NULL, NULL, NULL, NULL"""
    )
    found = {r.column_name: (r.null_count, r.distinct_count) for r in profile_table(frame, REF).collect()}
    assert found == {"m": (1, 2), "v": (1, 3), "t": (1, 3), "r": (1, 2)}


def test_top_values_print_floats_as_they_are(spark):
    frame = spark.sql("SELECT CAST(0.1 AS FLOAT) AS f, 0.1D AS d")
    assert {(r.column_name, r.value) for r in top_values(frame).collect()} == {("f", "0.1"), ("d", "0.1")}
