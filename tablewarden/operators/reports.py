"""Reports over the audit frames: newest results, history, KPIs, run totals, freshness."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.functions.names import col
from tablewarden.plans.rulebook import Rulebook

TABLE_KEY = ("catalog", "schema", "table")


def final_report(summary: DataFrame, rows: int = 100) -> DataFrame:
    """The newest summary rows, a top-k report: each task keeps ``rows`` rows at most."""
    return summary.orderBy(F.col("run_timestamp").desc(), *TABLE_KEY).limit(rows)


def latest_results(summary: DataFrame) -> DataFrame:
    """Newest summary row of each table. The rank filter is applied before the shuffle too."""
    others = (F.col(c).desc() for c in summary.columns if c not in (*TABLE_KEY, "run_timestamp"))
    newest_first = W.partitionBy(*TABLE_KEY).orderBy(F.col("run_timestamp").desc(), *others)
    return summary.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def score_history(summary: DataFrame) -> DataFrame:
    """All runs with the previous score of the table and the change since.

    The history of a table is cut into months, so a table with a long or dense history
    is not sorted in one task. Only the last score of each month crosses the cuts.
    """
    month = F.date_trunc("month", F.col("run_timestamp").cast("timestamp"))
    runs = summary.withColumn("_month", month)
    key = (*TABLE_KEY, "_month")
    by_month = W.partitionBy(*TABLE_KEY).orderBy("_month")
    carried = (
        runs.groupBy(*key)
        .agg(F.max_by("dq_score", "run_timestamp").alias("_last"))
        .select(*key, F.lag("_last").over(by_month).alias("_carried"))
    )
    in_month = W.partitionBy(*key).orderBy("run_timestamp")
    previous = F.when(F.row_number().over(in_month) == 1, F.col("_carried")).otherwise(
        F.lag("dq_score").over(in_month)
    )
    return (
        runs.join(carried, list(key), "left")
        .select(*summary.columns, previous.alias("previous_score"))
        .withColumn("score_change", F.col("dq_score") - F.col("previous_score"))
    )


def kpis(detail: DataFrame, book: Rulebook) -> DataFrame:
    """Checks and outcomes per dimension, by table and (table columns NULL) overall.

    Overall, a dimension without checks has a row with 0 checks and no rates. The rule
    catalog that names the dimensions is broadcast: a rulebook has sixteen rules.
    """
    status = F.col("status")
    dimensions = book.catalog_frame(detail.sparkSession).select("dq_id", "dimension")
    graded = (
        detail.filter(status != "SKIPPED")
        .join(F.broadcast(dimensions), "dq_id")
        .select(*TABLE_KEY, "dimension", "status", "failure_percentage")
        .unionByName(dimensions.select("dimension"), allowMissingColumns=True)
    )
    by = [F.col(c) for c in (*TABLE_KEY, "dimension")]
    checks = F.count("status")
    passed = F.count_if(status == "PASS")
    counted = graded.groupingSets([by, by[-1:]], *by).agg(
        F.grouping_id().alias("_set"),
        checks.alias("checks"),
        passed.alias("passed"),
        F.count_if(status == "WARNING").alias("warnings"),
        F.count_if(status == "FAIL").alias("failed"),
        F.round(passed / F.nullif(checks, F.lit(0)) * 100, 4).alias("pass_rate"),
        F.round(F.avg("failure_percentage"), 4).alias("mean_failure_percentage"),
    )
    return counted.filter("_set > 0 OR checks > 0").drop("_set")


def run_totals(
    attempts: DataFrame,
    summary: DataFrame,
    detail: DataFrame,
    profile: DataFrame,
    candidates: DataFrame,
) -> DataFrame:
    """One row per run: tables found, processed and failed, rows of each audit frame.

    ``attempts`` has one row ``(run_timestamp, processed)`` per table tried.
    """
    outcome = F.when(F.col("processed"), "tables_processed").otherwise("tables_failed")
    rows = [
        attempts.select("run_timestamp", outcome.alias("kind")),
        summary.select("run_timestamp", F.lit("summary_records").alias("kind")),
        detail.select("run_timestamp", F.lit("detail_records").alias("kind")),
        profile.select(F.col("profile_timestamp").alias("run_timestamp"), F.lit("profile_records").alias("kind")),
        candidates.select(
            F.col("created_timestamp").alias("run_timestamp"), F.lit("candidate_records").alias("kind")
        ),
    ]
    kinds = (
        "tables_processed",
        "tables_failed",
        "summary_records",
        "detail_records",
        "profile_records",
        "candidate_records",
    )
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy("run_timestamp")
        .agg(
            F.count_if(F.col("kind").startswith("tables_")).alias("tables_discovered"),
            *(F.count_if(F.col("kind") == kind).alias(kind) for kind in kinds),
        )
    )


def freshness(df: DataFrame, column: str, as_of: Column | datetime, hours: float = 24) -> DataFrame:
    """Newest value of a timestamp column, and whether it lies more than ``hours`` before ``as_of``."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    limit = moment - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600))
    return df.agg(F.max(col(column)).alias("newest_timestamp")).withColumn(
        "is_stale", F.coalesce(F.col("newest_timestamp") < limit, F.lit(True))
    )
