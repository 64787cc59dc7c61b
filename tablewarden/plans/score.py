"""From rule results to one summary row per table and run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.grading import overall_status, quality_gate, weighted_score
from tablewarden.plans.rulebook import RULE_IDS, Rulebook

RUN_KEY = ("catalog", "schema", "table", "run_timestamp")


def summarise(rule_results: DataFrame, book: Rulebook) -> DataFrame:
    """Pivot results to ``dq01`` .. ``dq16`` and add score, status and gate.

    One aggregate does the pivot and the score; a rule without a result is a WARNING
    and earns nothing, its weight still counts.
    """
    pivot = [
        F.expr(f"coalesce(max(status) FILTER (WHERE dq_id = '{rule}'), 'WARNING') AS {rule.lower()}")
        for rule in RULE_IDS
    ]
    wide = rule_results.groupBy(*RUN_KEY).agg(
        F.max("row_count").alias("row_count"),
        F.max("column_count").alias("column_count"),
        *pivot,
        weighted_score(book.weights).alias("dq_score"),
    )
    return wide.select(
        "*",
        overall_status(F.col("dq_score"), book.thresholds).alias("overall_status"),
        quality_gate(F.col("dq_score"), book.gate).alias("quality_gate"),
    )
