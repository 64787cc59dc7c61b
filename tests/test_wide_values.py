"""Long texts, nested values, sketches and held-out weights."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewarden import Run, Store
from tablewarden.operators import profile as profiling
from tablewarden.operators.profile import profile_table, top_values
from tablewarden.operators.sketches import estimated_profile, merge_sketches, sketch_profile
from tablewarden.operators.weights import dynamic_weights, permutation_weights, train_weights
from tests.helpers import REF, book


def plain_top(values, n):
    """Most frequent first, ties in order of UTF-8 bytes, NULL last."""
    counts = Counter(values)
    order = sorted(counts, key=lambda v: (-counts[v], v is None, (v or "").encode()))
    return [(v, counts[v], i + 1) for i, v in enumerate(order[:n])]


def found_top(df, n, column="t"):
    rows = top_values(df, n, [column]).orderBy("rank").collect()
    return [(r.value, r.value_count, r["rank"]) for r in rows]


HEAD = "x" * 70  # longer than what is ranked as it is
TEXTS = [HEAD + f"{i:03d}" for i in range(40)] + ["short", "", None, None, "é" * 40, "é" * 40 + "!", "é" * 32]
TEXTS += [HEAD + "007"] * 3 + ["y" * 64] * 2 + ["y" * 65] * 2 + ["y" * 64 + "ß"]


@pytest.mark.parametrize("n", [1, 3, 6, 12, 100])
def test_top_texts_with_ties_and_a_common_head(spark, n):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").repartition(5)
    assert found_top(df, n) == plain_top(TEXTS, n)


def test_top_texts_of_several_columns_and_none(spark):
    df = spark.createDataFrame([(t, (t or "n")[::-1], 1) for t in TEXTS], "t string, u string, k int")
    assert found_top(df, 5, "u") == plain_top([(t or "n")[::-1] for t in TEXTS], 5)
    assert top_values(df, 5).count() == 11  # five, five and the one number
    assert top_values(df.limit(0), 5).count() == 0
    assert top_values(df.withColumn("b", F.col("t").cast("binary")), 3, ["b"]).count() == 3


def test_no_long_text_in_a_counting_shuffle(spark, monkeypatch):
    """Every row that is counted is a head, a digest and a column number."""
    df = spark.createDataFrame([("z" * 5000 + str(i % 3),) for i in range(30)], "t string")
    seen = {}
    write = Store.write

    def spied(self, frame, schema, table, *rest, **options):
        seen[table] = frame
        return write(self, frame, schema, table, *rest, **options)

    monkeypatch.setattr(profiling.Store, "write", spied)
    assert [r.value_count for r in top_values(df, 3).collect()] == [10, 10, 10]
    kept = seen["kept"]
    assert kept.columns == ["column_index", "head", "digest", "n"]
    assert kept.agg(F.max(F.octet_length("head")), F.max(F.octet_length("digest"))).first() == (64, 32)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    counted = plan.split("Aggregate [column_index")[-1]
    assert "head#" in counted and "sha2" in counted


def test_nested_values_are_counted_by_digest(spark):
    rows = """SELECT map('a', array(1, null), 'b', array()) AS m, named_struct('x', 0.0D, 'y', cast(null AS int)) AS s,
        array(named_struct('q', 'v1:a,b')) AS z, array(cast('nan' AS float)) AS f, timestamp'2020-01-01 00:00:00.000001' AS t
        UNION ALL SELECT map('b', array(), 'a', array(1, null)), named_struct('x', -0.0D, 'y', cast(null AS int)),
        array(named_struct('q', 'v1:a'), named_struct('q', 'b')), array(cast('nan' AS float)), timestamp'2020-01-01 00:00:00.000002'
        UNION ALL SELECT map('b', array(), 'a', array(1)), named_struct('x', cast(null AS double), 'y', 0),
        array(named_struct('q', '')), array(cast(null AS float)), null
        UNION ALL SELECT null, null, array(named_struct('q', null)), array(), null
        UNION ALL SELECT null, named_struct('x', cast(null AS double), 'y', cast(null AS int)), array(), null, null"""
    df = spark.sql(rows)
    expected = {"m": 3, "s": 4, "z": 5, "f": 4, "t": 3}
    assert {r.column_name: r.distinct_count for r in profile_table(df, REF).collect()} == expected
    estimated = estimated_profile(sketch_profile(df, REF)).collect()
    assert {r.column_name: r.distinct_count for r in estimated} == expected
    plan = profile_table(df.select("z", "f"), REF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(column_index" in plan and "sha2" in plan


# --- sketches -----------------------------------------------------------------------------


def test_sketches_of_parts_estimate_the_whole(spark):
    df = spark.range(60_000).select(
        F.col("id").alias("key"),
        (F.col("id") % 7).alias("few"),
        F.concat(F.lit("t" * 80), F.col("id") % 20_000).alias("text"),
        F.when(F.col("id") % 2 == 0, F.array(F.col("id") % 3000, F.lit(None))).alias("list"),
        F.lit(None).cast("double").alias("none"),
    )
    # parts share values of every column but the key
    parts = [sketch_profile(df.filter(F.col("id") % 3 == i), REF) for i in range(3)]
    united = estimated_profile(merge_sketches(parts[0].union(parts[1]).union(parts[2])))
    exact = {r.column_name: r for r in profile_table(df, REF).collect()}
    assert united.columns == profile_table(df, REF).columns
    for r in united.collect():
        e = exact[r.column_name]
        assert (r.row_count, r.null_count, r.null_percentage) == (e.row_count, e.null_count, e.null_percentage)
        assert abs(r.distinct_count / e.distinct_count - 1) < 0.08, r
    assert {r.distinct_count for r in united.filter("column_name IN ('few', 'none')").collect()} == {7, 1}


def test_error_of_the_estimate_over_many_sets(spark):
    """The standard error is 1.04 / sqrt(4096); the mean of twelve errors is far below five of them."""
    df = spark.range(30_000).select(*(F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(12)))
    errors = [r.distinct_count / 30_000 - 1 for r in estimated_profile(sketch_profile(df, REF)).collect()]
    assert max(map(abs, errors)) < 5 * 1.04 / 64 and abs(np.mean(errors)) < 3 * 1.04 / 64 / 12**0.5


def test_a_sketch_needs_no_shuffle_of_values(spark):
    plan = sketch_profile(spark.range(10).withColumn("t", F.lit("x")), REF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan  # one row of a task


def test_runs_keep_sketches_if_asked(spark, tmp_path):
    store = Store(str(tmp_path))
    for asked, days in ((False, 1), (True, 2)):
        rules = book(profiling={"sketches": asked})
        for day in range(days):
            run = Run(spark, rules, store, F.lit(f"2026-01-0{day + 1}").cast("timestamp"), run_id=f"d{day}")
            run.tables([REF], lambda ref, day=day: spark.range(100 * day, 100 * day + 100))
        assert store.exists(spark, "candidate", "dq_profile_sketches") is asked
    united = estimated_profile(merge_sketches(store.read(spark, "candidate", "dq_profile_sketches"))).first()
    assert (united.row_count, united.null_count) == (200, 0) and abs(united.distinct_count - 200) <= 10


def test_a_frame_without_columns(spark):
    with pytest.raises(ValueError, match="no columns"):
        sketch_profile(spark.createDataFrame([], "a int").drop("a"), REF)


# --- weights ------------------------------------------------------------------------------


def history(spark, n=600):
    rng = np.random.default_rng(8)
    rows = [(*map(float, rng.normal(size=3)), int(i)) for i in range(n)]
    return spark.createDataFrame(rows, "calm double, driver double, noise double, serial int").withColumn(
        "impact", 7 * F.col("driver") + 2
    )


FEATURES = ["calm", "driver", "noise", "serial"]


@pytest.mark.parametrize("weigh", [dynamic_weights, permutation_weights])
def test_the_planted_feature_weighs_most(spark, weigh):
    found = {r.kpi: r.dynamic_weight for r in weigh(history(spark), FEATURES, "impact", partitions=2).collect()}
    assert set(found) == set(FEATURES) and found["driver"] > 90 and abs(sum(found.values()) - 100) < 0.001


def test_a_feature_learnt_by_heart_gets_nothing(spark):
    """The target is chance: on the rows trained on the forest finds importances, held out there is none."""
    df = history(spark, 400).withColumn("impact", F.pmod(F.xxhash64("serial", F.lit(3)), F.lit(1000)).cast("double"))
    inside = {r.kpi: r.raw_importance for r in dynamic_weights(df, FEATURES, "impact", partitions=2).collect()}
    held = {r.kpi: r.raw_importance for r in permutation_weights(df, FEATURES, "impact", partitions=2).collect()}
    assert min(inside.values()) > 0.1  # shares of an error of 1, none of which is real
    variance = df.agg(F.variance("impact")).first()[0]
    assert all(v < 0.1 * variance for v in held.values())


def test_weights_by_permutation_need_rows_and_a_method(spark, tmp_path):
    assert permutation_weights(history(spark, 9), FEATURES, "impact") is None
    assert permutation_weights(history(spark, 60), ["driver"], "impact") is None
    constant = spark.range(40).selectExpr("cast(id AS int) a", "cast(id % 3 AS double) b", "1.0D AS impact")
    assert {r.dynamic_weight for r in permutation_weights(constant, ["a", "b"], "impact").collect()} == {0.0}
    settings = {"enabled": True, "incident_table": "h", "feature_columns": FEATURES, "target_column": "impact"}
    store = Store(str(tmp_path))
    train_weights(book(ml_weighting={**settings, "method": "permutation"}), store, lambda n: history(spark))
    top = store.read(spark, "audit", "dq_dynamic_weights").orderBy(F.desc("dynamic_weight")).first()
    assert top.kpi == "driver" and top.dynamic_weight > 90


def test_permuting_keeps_the_values_of_a_feature(spark, monkeypatch):
    """With several buckets too: weights are still those of the driver."""
    monkeypatch.setattr("tablewarden.operators.weights.ROWS_PER_BUCKET", 20)
    found = {r.kpi: r.dynamic_weight for r in permutation_weights(history(spark), FEATURES, "impact").collect()}
    assert found["driver"] > 90
