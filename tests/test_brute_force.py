"""Random small tables against counts made in plain Python."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewarden.operators.profile import profile_table
from tests.helpers import REF, graded

RULES = {
    "mandatory_columns": ["k", "s"],
    "row_expressions": {"small": "k < 3", "known": "s IS NOT NULL"},
    "allowed_values": {"s": ["a", "bb"]},
    "unique_keys": ["k", "s"],
    "range_rules": {"k": {"min": 0, "max": 3}},
    "null_columns": ["k", "s"],
    "length_rules": {"s": {"min": 2, "max": 3}},
    "pattern_rules": {"s": "b+"},
    "date_columns": ["d"],
}
RELATION = {"child_table": REF.full, "child_column": "k", "parent_table": "p", "parent_column": "k"}

ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-2, 5)),
        st.one_of(st.none(), st.text("ab", max_size=4)),
        st.sampled_from([None, "2024-01-31", "2024-02-31", "soon"]),
    ),
    min_size=1,
    max_size=40,
)
PARENTS = st.lists(st.one_of(st.none(), st.integers(-2, 5)), max_size=6)


def expected_failures(rows, parents):
    keys = [(k, s) for k, s, _ in rows]
    return {
        "DQ01": sum(k is None or s is None for k, s in keys),
        "DQ02": sum(k is None or k >= 3 for k, _ in keys) + sum(s is None for _, s in keys),
        "DQ03": sum(s is not None and s not in ("a", "bb") for _, s in keys),
        "DQ04": len(keys) - len(set(keys)),
        "DQ06": sum(k is not None and k not in parents for k, _ in keys),
        "DQ07": sum(d in ("2024-02-31", "soon") for *_, d in rows),
        "DQ09": sum(k is not None and not 0 <= k <= 3 for k, _ in keys),
        "DQ11": sum((k is None) + (s is None) for k, s in keys),
        "DQ12": sum(s is not None and not 2 <= len(s) <= 3 for _, s in keys),
        "DQ14": sum(s is not None and not re.search("b+", s) for _, s in keys),
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parents=PARENTS)
def test_failed_records(spark, rows, parents):
    df = spark.createDataFrame(rows, "k int, s string, d string")
    parent = spark.createDataFrame([(p,) for p in parents], "k int")
    expected = expected_failures(rows, parents)
    result = graded(df, RULES, list(expected), load=lambda name: parent, relationships=[RELATION])
    assert {d: failed for d, (_, _, failed) in result.items()} == expected
    for dq_id, (status, pct, failed) in result.items():
        cells = len(rows) * (2 if dq_id == "DQ11" else 1)
        assert pct == failed / cells * 100
        assert status == ("PASS" if pct <= 0 else "WARNING" if pct <= 1 else "FAIL")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_profile(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, d string")
    found = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in profile_table(df, REF).collect()}
    assert found == {
        name: (len(rows), sum(v is None for v in column), len(set(column)))
        for name, column in zip("ksd", zip(*rows))
    }
