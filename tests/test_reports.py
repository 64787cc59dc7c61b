from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tablewarden import Rulebook, Store, summarise
from tablewarden.operators import reports
from tablewarden.operators.weights import dynamic_weights, train_weights

SUMMARY = "catalog string, schema string, table string, run_timestamp timestamp, dq_score double"


def summary(spark, rows):
    return spark.createDataFrame([("c", "s", t, at, score) for t, at, score in rows], SUMMARY)


def test_missing_results_are_warnings_and_earn_nothing(spark):
    key = ("c", "s", "t", datetime(2026, 1, 1))
    rows = [(*key, "DQ01", "PASS", 5, 2), (*key, "DQ02", "WARNING", 5, 2)]
    results = spark.createDataFrame(
        rows,
        "catalog string, schema string, table string, run_timestamp timestamp, dq_id string,"
        " status string, row_count long, column_count long",
    )
    row = summarise(results, Rulebook()).collect()[0]
    assert (row.dq01, row.dq02, row.dq03) == ("PASS", "WARNING", "WARNING")
    assert (row.dq_score, row.overall_status) == (10.0, "FAIL")
    assert row.quality_gate == "FAILED"
    off = summarise(results, Rulebook({"quality_gate": {"enabled": False}})).collect()[0]
    assert off.quality_gate == "DISABLED"
    low = summarise(results, Rulebook({"quality_gate": {"threshold": 10}})).collect()[0]
    assert low.quality_gate == "PASSED"


def test_final_report_keeps_the_newest(spark):
    start = datetime(2026, 1, 1)
    frame = summary(spark, [("t", start + timedelta(days=i), float(i)) for i in range(150)])
    report = reports.final_report(frame)
    assert report.count() == 100 and report.agg(F.min("dq_score")).first()[0] == 50.0
    assert "TakeOrderedAndProject" in report._jdf.queryExecution().executedPlan().toString()


def test_history_crosses_months(spark):
    days = [datetime(2026, 1, 5), datetime(2026, 1, 6), datetime(2026, 3, 1), datetime(2026, 3, 2)]
    frame = summary(spark, list(zip("tttt", days, [100.0, 85.0, None, 90.0])) + [("u", days[2], 50.0)])
    rows = reports.score_history(frame).orderBy("table", "run_timestamp").collect()
    assert [(r.previous_score, r.score_change) for r in rows] == [
        (None, None),
        (100.0, -15.0),
        (85.0, None),
        (None, None),
        (None, None),
    ]


def test_latest_results(spark):
    first, second = datetime(2026, 1, 1), datetime(2026, 1, 2)
    frame = summary(spark, [("t", first, 1.0), ("t", second, 2.0), ("u", first, 3.0)])
    assert {(r.table, r.dq_score) for r in reports.latest_results(frame).collect()} == {("t", 2.0), ("u", 3.0)}


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 6),), (None,)], "at timestamp")
    assert reports.freshness(df, "at", datetime(2026, 1, 2, 6)).first().is_stale is False
    assert reports.freshness(df, "at", datetime(2026, 1, 2, 6, 0, 1)).first().is_stale is True
    assert reports.freshness(df, "at", datetime(2026, 1, 1, 7), hours=0.5).first().is_stale is True
    assert reports.freshness(df.filter("at > now()"), "at", datetime(2026, 1, 1)).first().is_stale is True


def incidents(spark, n):
    return spark.range(1, n + 1).selectExpr(
        "CAST(id AS INT) AS incidents", "CAST(id % 7 AS DOUBLE) AS minutes", "3.5D * id + 10 AS impact"
    )


def test_weights_follow_the_driver_of_the_target(spark):
    weights = dynamic_weights(incidents(spark, 60), ["incidents", "minutes", "absent"], "impact", partitions=2)
    found = {r.kpi: r.dynamic_weight for r in weights.collect()}
    assert set(found) == {"incidents", "minutes"} and found["incidents"] > found["minutes"]
    assert abs(sum(found.values()) - 100) < 0.001


def test_weights_need_columns_and_rows(spark):
    assert dynamic_weights(incidents(spark, 9), ["incidents", "minutes"], "impact") is None
    assert dynamic_weights(incidents(spark, 9), ["incidents", "minutes"], "impact", min_rows=9) is not None
    assert dynamic_weights(incidents(spark, 60), ["incidents"], "impact") is None
    assert dynamic_weights(incidents(spark, 60), ["incidents", "minutes"], "gone") is None
    nulls = incidents(spark, 60).withColumn("minutes", F.lit(None).cast("double"))
    assert dynamic_weights(nulls, ["incidents", "minutes"], "impact") is None


def test_weights_are_appended_as_configured(spark, tmp_path):
    settings = {
        "enabled": True,
        "incident_table": "incidents",
        "feature_columns": ["incidents", "minutes"],
        "target_column": "impact",
        "min_training_rows": 20,
    }
    store, frame = Store(str(tmp_path)), incidents(spark, 30)
    assert train_weights(Rulebook({"ml_weighting": {**settings, "enabled": False}}), store, lambda n: frame) is None
    book = Rulebook({"ml_weighting": settings})
    assert train_weights(book, store, lambda n: frame.limit(10)) is None
    for _ in range(2):
        train_weights(book, store, lambda n: frame)
    assert store.read(spark, "audit", "dq_dynamic_weights").count() == 4
