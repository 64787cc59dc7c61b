"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) set data
and cores. Each query runs once to warm up and twice timed, planning included, until all
its rows are produced; the faster time counts. ``--compare`` also times the one-job-per-check way of doing
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.queries import QUERIES, book
from workload.tables import Tables, ref

HEADLINE = [
    "dq_suite",
    "dq_all_tables",
    "dq_summary",
    "dq04_uniqueness",
    "dq06_integrity",
    "dq16_volume",
    "profile_table",
    "rule_candidates",
    "top_values",
    "table_inventory",
    "bronze",
    "gold",
    "quarantine",
    "quarantine_reasons",
    "v_dq_history",
    "v_dq_kpis",
    "ml_dynamic_weights",
]


def produce(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    """Seconds of the faster of two runs after one to warm up."""
    run()
    seconds = []
    for _ in range(2):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds), 3)


def one_job_per_check(tables: Tables, name: str) -> None:
    """The suite as separate actions: a row count and a filter count for every check."""
    from tablewarden.operators.layers import row_rules

    df, rules = tables.frame(name), book()
    for rule in row_rules(df, ref(name), rules):
        df.count()
        for predicate in rule.failing.values():
            df.filter(predicate).count()
    for _ in ("DQ04", "DQ10"):
        keys = rules.setting(ref(name), "DQ04")
        df.count()
        df.select(*keys).dropDuplicates().count()
    df.count()
    for relation in rules.relationships(ref(name)):
        child, parent = relation["child_column"], relation["parent_column"]
        parents = tables.frame(relation["parent_table"]).select(F.col(parent).alias("p")).dropDuplicates()
        children = df.select(F.col(child).alias("c"))
        children.filter("c IS NULL").count()
        children.filter("c IS NOT NULL").join(parents, F.col("c") == F.col("p"), "left_anti").count()
    df.count()


def one_job_per_column(tables: Tables, name: str) -> None:
    df = tables.frame(name)
    df.count()
    for column in df.columns:
        df.filter(F.col(column).isNull()).count()
        df.select(column).distinct().count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablewarden-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(lambda n=name: produce(QUERIES[n](spark, folder))) for name in HEADLINE}
    if "--compare" in sys.argv:
        for name in ("lineitem", "orders_dq"):
            seconds[f"checks_one_by_one_{name}"] = timed(lambda n=name: one_job_per_check(Tables(spark, folder), n))
            seconds[f"profile_one_by_one_{name}"] = timed(lambda n=name: one_job_per_column(Tables(spark, folder), n))
            from workload.queries import profiles, suite

            seconds[f"checks_fused_{name}"] = timed(lambda n=name: produce(suite(Tables(spark, folder), [n])))
            seconds[f"profile_fused_{name}"] = timed(lambda n=name: produce(profiles(spark, folder, [n])))
    total = round(sum(seconds[name] for name in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
