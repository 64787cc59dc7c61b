"""The registered queries. Each takes (spark, folder) and returns a lazy frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from copy import deepcopy
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.grading import gate_minimum
from tablewarden.functions.names import TableRef
from tablewarden.operators import layers, reports
from tablewarden.operators.datatypes import castable
from tablewarden.operators.profile import profile_table, rule_candidates, top_values
from tablewarden.operators.sketches import estimated_profile, merge_sketches, sketch_profile
from tablewarden.operators.weights import METHODS, train_weights
from tablewarden.plans.rulebook import RULE_IDS, Rulebook
from tablewarden.plans.run import Run, promote
from tablewarden.plans.score import summarise
from tablewarden.plans.suite import detail, run_suite, run_suite_by_period
from tablewarden.sources.inventory import discover_tables, read_table, table_inventory
from tablewarden.sources.store import Store, shared_root
from workload.config import CONFIG
from workload.tables import DIRTIED, SCHEMAS, Tables, ref

Query = Callable[[SparkSession, str], DataFrame]

BASE_TABLES = [name for name in SCHEMAS if name not in DIRTIED]
RULED_TABLES = [name.rpartition(".")[2] for name in CONFIG["table_rules"]]
SCORED_TABLES = ["orders", "customer", "orders_dq"]
SUITE_TABLES = ["orders_dq", "lineitem"]
VOLUME_TABLES = ["orders", "lineitem", "events", "customer"]
LAYERED = ["orders", "orders_dq"]
DISCOVERED = "tablewarden_"  # prefix of the schemas that discovery looks for

# Audit tables by layer and output
STORED = [("audit", "summary"), ("audit", "audit"), ("audit", "pipeline_runs")]
STORED += [("candidate", "profiling"), ("candidate", "candidates")]

RUN_AT = datetime(2026, 1, 5, 6, 0, 0)

# Earlier runs of the volume rule: when they ran and which timestamp says what was loaded.
EARLIER_RUNS = {
    "orders": ("o_orderdate", ["1999-01-01", "2001-01-01", "2000-01-01"]),
    "lineitem": ("l_shipdate", ["1998-01-01", "2000-01-01"]),
    "events": ("ts", ["2024-01-09", "2024-01-17", "2024-01-25"]),
}

# Tables whose rows arrive by period, for a history of runs.
PERIODS = {"orders_dq": ("year", "o_orderdate"), "lineitem": ("year", "l_shipdate"), "events": ("week", "ts")}


def moment(at: datetime = RUN_AT) -> Column:
    """A wall-clock time, the same in every session time zone."""
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def book() -> Rulebook:
    return Rulebook(CONFIG)


def suite(
    tables: Tables,
    names: Sequence[str],
    only: Sequence[str] = RULE_IDS,
    rules: Rulebook | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    listed = [tables.table(name) for name in names]
    return run_suite(listed, rules or book(), moment(), tables.frame, history, only)


# --- single rules -------------------------------------------------------------------


def rule_tables(dq_id: str) -> list[str]:
    """The tables a rule is configured for."""
    if dq_id == "DQ06":
        return list(dict.fromkeys(r["child_table"].rpartition(".")[2] for r in CONFIG["relationships"]))
    if dq_id == "DQ16":
        return VOLUME_TABLES
    return [name for name in RULED_TABLES if book().setting(ref(name), dq_id)]


def rule_query(dq_id: str, rules: Callable[[], Rulebook] = book) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = Tables(spark, folder)
        history = earlier_runs(tables) if dq_id == "DQ16" else None
        graded = suite(tables, rule_tables(dq_id), [dq_id], rules(), history)
        return graded.select("table", "dq_id", "status", "failure_percentage", "failed_records", "row_count")

    return query


def lenient_book() -> Rulebook:
    """NULL keys allowed in every relationship."""
    config = deepcopy(CONFIG)
    for relation in config["relationships"]:
        relation["nullable_allowed"] = True
    return Rulebook(config)


def earlier_runs(tables: Tables) -> DataFrame:
    """Row counts as of each earlier run: one scan per table, only the timestamp read."""
    frames = []
    for name, (column, days) in EARLIER_RUNS.items():
        loaded = F.col(column)
        stamps = [moment(datetime.fromisoformat(day)) for day in days]
        counts = [F.count_if(loaded < at).alias(f"n{i}") for i, at in enumerate(stamps)]
        runs = [
            F.struct(at.alias("run_timestamp"), F.col(f"n{i}").alias("row_count"))
            for i, at in enumerate(stamps)
        ]
        frames.append(named(tables.frame(name).agg(*counts).select(F.inline(F.array(*runs))), ref(name)))
    return union(frames)


def named(df: DataFrame, table: TableRef) -> DataFrame:
    return df.select(
        F.lit(table.catalog).alias("catalog"),
        F.lit(table.schema).alias("schema"),
        F.lit(table.table).alias("table"),
        "*",
    )


def union(frames: Sequence[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def castable_values(spark: SparkSession, folder: str) -> DataFrame:
    orders = Tables(spark, folder).frame("orders_dq")
    texts = orders.select(
        "o_orderdate_str",
        F.col("o_orderpriority").alias("priority_code"),
        F.col("o_custkey").cast("string").alias("custkey_text"),
    )
    return castable(texts, {"o_orderdate_str": "date", "priority_code": "integer", "custkey_text": "bigint"})


# --- suite, score, run ----------------------------------------------------------------


def dq_suite(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    return detail(suite(tables, SUITE_TABLES, history=earlier_runs(tables)))


def dq_score(spark: SparkSession, folder: str) -> DataFrame:
    summary = summarise(suite(Tables(spark, folder), SCORED_TABLES), book())
    return summary.select("table", "dq_score", "overall_status")


def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    summary = summarise(suite(Tables(spark, folder), SCORED_TABLES), book())
    minimum = F.lit(gate_minimum(book().gate)).alias("gate_minimum")
    return summary.select("table", "dq_score", minimum, "quality_gate")


def dq_all_tables(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    return summarise(suite(tables, RULED_TABLES, history=earlier_runs(tables)), book())


def audited_run(spark: SparkSession, folder: str, times: int = 1) -> Store:
    """A run with its audit trail written to the shared folder; repeated under the same id."""
    tables = Tables(spark, folder)
    store = Store(shared_root(spark))
    for _ in range(times):
        run = Run(spark, book(), store, moment(), tables.frame, run_id="daily")
        run.tables([ref(name) for name in SCORED_TABLES], lambda r: tables.frame(r.table))
    return store


def dq_detail(spark: SparkSession, folder: str) -> DataFrame:
    return audited_run(spark, folder).read(spark, book().layer("audit"), book().output("audit"))


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return audited_run(spark, folder).read(spark, book().layer("audit"), book().output("summary"))


def repeated_run(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each audit table after the same run has been done twice."""
    store, found = audited_run(spark, folder, times=2), []
    for layer, output in STORED:
        stored = store.read(spark, book().layer(layer), book().output(output))
        rows = stored.agg(F.count(F.lit(1)).alias("row_count"))
        found.append(rows.select(F.lit(book().output(output)).alias("table"), "row_count"))
    return union(found)


def stored(output: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return audited_run(spark, folder).read(spark, book().layer("candidate"), book().output(output))

    return query


def supplier_history(tables: Tables) -> DataFrame:
    """What drives a supplier's revenue: one training row per supplier."""
    return tables.frame("lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.avg("l_quantity").alias("avg_quantity"),
        F.avg("l_discount").alias("avg_discount"),
        F.avg("l_tax").alias("avg_tax"),
        F.avg((F.col("l_returnflag") == "R").cast("double")).alias("returned_share"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )


def ml_training(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that the weights are trained on; sums of doubles depend on order, hence the rounding."""
    history = supplier_history(Tables(spark, folder))
    rounded = [F.round(c, 6).alias(c) for c in ("avg_quantity", "avg_discount", "avg_tax", "returned_share")]
    return history.select("l_suppkey", "lines", *rounded, F.round("revenue", 2).alias("revenue"))


def ml_dynamic_weights(spark: SparkSession, folder: str) -> DataFrame:
    store, settings = Store(shared_root(spark)), CONFIG["ml_weighting"]
    history = supplier_history(Tables(spark, folder))
    store.write(history, "sales", settings["incident_table"])  # training passes over it several times
    return train_weights(book(), store, lambda name: store.read(spark, "sales", name))


def ml_weight_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Per feature whether its weight is a share of 100, and whether all of them add up to it.

    Which feature weighs most is the forest's finding, not a property that SQL can state.
    """
    whole = ml_dynamic_weights(spark, folder).agg(  # a handful of features
        F.sum("dynamic_weight").alias("total"),
        F.collect_list(F.struct("kpi", "dynamic_weight")).alias("features"),
    )
    return whole.select("total", F.inline("features")).select(
        "kpi",
        F.col("dynamic_weight").between(0, 100).alias("is_share"),
        (F.abs(F.col("total") - 100) < 0.001).alias("adds_up"),
    )


def planted_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The heaviest feature, by each method, of a history whose target is one of them."""
    lines = Tables(spark, folder).frame("lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.avg("l_quantity").alias("avg_quantity"),
        F.avg("l_discount").alias("avg_discount"),
        F.avg("l_tax").alias("avg_tax"),
        F.avg((F.col("l_returnflag") == "R").cast("double")).alias("returned_share"),
    )
    store = Store(shared_root(spark))
    store.write(lines.withColumn("impact", F.lit(5) + F.lit(40) * F.col("avg_discount")), "sales", "planted")
    planted, found = store.read(spark, "sales", "planted"), []
    for method, weigh in METHODS.items():
        weights = weigh(planted, CONFIG["ml_weighting"]["feature_columns"], "impact")
        heaviest = weights.agg(F.max_by("kpi", "dynamic_weight").alias("kpi"))
        found.append(heaviest.select(F.lit(method).alias("method"), "kpi"))
    return union(found)


# --- sources, sinks, layers -------------------------------------------------------------


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    scope = CONFIG["framework"]
    return table_inventory(
        [(ref(name), tables.frame(name)) for name in BASE_TABLES],
        scope["excluded_schemas"],
        scope["source_schema_allowlist"],
    )


def discovered_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Tables found through the session's catalog; one schema is excluded, a view is temporary."""
    for name in BASE_TABLES:
        schema = f"{DISCOVERED}{SCHEMAS[name]}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")  # external: its files stay
        spark.sql(f"CREATE TABLE {schema}.{name} USING parquet LOCATION '{folder.rstrip('/')}/{name}.parquet'")
    spark.range(1).createOrReplaceTempView(f"{DISCOVERED}view")
    scope = [f"{DISCOVERED}{schema}".upper() for schema in set(SCHEMAS.values())]
    found = discover_tables(spark, "spark_catalog", [f"{DISCOVERED}web"], scope)
    return table_inventory([(table, read_table(spark, table)) for table in found])


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    tables, store = Tables(spark, folder), Store(shared_root(spark))
    store.write(tables.frame("customer"), "sales", "orders")
    store.write(tables.frame("orders"), "sales", "orders")  # replaces rows and schema
    return store.read(spark, "sales", "orders")


def sink_append_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The second append brings a column the first did not have."""
    tables, store = Tables(spark, folder), Store(shared_root(spark))
    suppliers = tables.frame("supplier").toDF("key", "name", "nation", "balance")
    customers = tables.frame("customer").toDF("key", "name", "nation", "balance", "segment")
    for frame in (suppliers, customers):
        store.write(frame, "sales", "party", "append")
    return store.read(spark, "sales", "party")


def awkward_part(tables: Tables) -> DataFrame:
    return tables.frame("part").toDF("Part Key", "part.key", "P  Name!", "1st type", "", "part_key_1")


def normalize_columns(spark: SparkSession, folder: str) -> DataFrame:
    return layers.normalize_columns(awkward_part(Tables(spark, folder)))[0]


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    store = Store(shared_root(spark))
    layers.write_bronze(awkward_part(Tables(spark, folder)), ref("part"), store, book(), moment())
    return store.read(spark, book().layer("bronze"), "part")


def layered(spark: SparkSession, folder: str) -> Store:
    """Orders pass the gate into silver and gold, the dirtied orders do not."""
    tables, store = Tables(spark, folder), Store(shared_root(spark))
    scores = summarise(suite(tables, LAYERED), book())
    for name, score, status in scores.select("table", "dq_score", "overall_status").toLocalIterator():
        promote(tables.table(name), book(), store, "run-1", score, status, moment())
    return store


def promoted_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The whole flow: rows per table and layer after checks, quarantine and the gate."""
    store, found = layered(spark, folder), []
    for name in LAYERED:
        for layer in ("bronze", "quarantine", "silver", "gold"):
            stored = f"quarantine_{name}" if layer == "quarantine" else name
            if store.exists(spark, book().layer(layer), stored):
                rows = store.read(spark, book().layer(layer), stored).agg(F.count(F.lit(1)).alias("row_count"))
                found.append(rows.select(F.lit(name).alias("table"), F.lit(layer).alias("layer"), "row_count"))
    return union(found)


def layer_query(layer: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        store = layered(spark, folder)
        written = [n for n in LAYERED if store.exists(spark, book().layer(layer), n)]
        frames = [store.read(spark, book().layer(layer), n).withColumn("table", F.lit(n)) for n in written]
        return union(frames)

    return query


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    tables, store = Tables(spark, folder), Store(shared_root(spark))
    for name in ("orders_dq", "orders"):  # nothing is written for orders
        table = tables.table(name)
        condition = layers.failing_condition(layers.row_rules(table.df, table.ref, book()))
        layers.create_quarantine(table.df, condition, table.ref, store, book(), "run-1", moment())
    return store.read(spark, book().layer("quarantine"), "quarantine_orders_dq")


def quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows fail which combination of rules."""
    table = Tables(spark, folder).table("orders_dq")
    reasons = layers.failure_reasons(layers.row_rules(table.df, table.ref, book()))
    return (
        table.df.groupBy(F.concat_ws(",", reasons).alias("reasons")).agg(F.count(F.lit(1)).alias("row_count"))
    )


# --- profile ------------------------------------------------------------------------------


def profiles(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    tables = Tables(spark, folder)
    return union([profile_table(tables.frame(name), ref(name), moment()) for name in names])


def profile(spark: SparkSession, folder: str) -> DataFrame:
    return profiles(spark, folder, ["orders_dq", "lineitem", "documents"])


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    return rule_candidates(profiles(spark, folder, ["orders_dq", "customer", "labels"]))


def profile_nested(spark: SparkSession, folder: str) -> DataFrame:
    return profiles(spark, folder, ["embeddings", "conversations"])


def profile_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of a table's years, kept apart and united, beside its exact profile."""
    tables, store = Tables(spark, folder), Store(shared_root(spark))
    for name, column, year in (("orders_dq", "o_orderdate", 2000), ("lineitem", "l_shipdate", 1999)):
        late = F.year(column) >= year
        for part in (late, ~F.coalesce(late, F.lit(False))):
            sketches = sketch_profile(tables.frame(name).filter(part), ref(name), moment())
            store.write(sketches, book().layer("candidate"), book().output("sketches"), "append")
    stored = store.read(spark, book().layer("candidate"), book().output("sketches"))
    estimated = estimated_profile(merge_sketches(stored)).withColumnRenamed("distinct_count", "estimate")
    exact = profiles(spark, folder, ["orders_dq", "lineitem"]).select("table", "column_name", "distinct_count")
    off = F.abs(F.col("estimate") / F.col("distinct_count") - 1)
    return estimated.join(exact, ["table", "column_name"]).select(
        "table",
        "column_name",
        "row_count",
        "null_count",
        F.when(F.col("distinct_count") <= 50, F.col("estimate")).alias("few_distinct"),  # sketches count few exactly
        (off <= 0.08).alias("is_close"),  # five standard errors
    )


def most_frequent_texts(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(Tables(spark, folder).frame("documents"), 10)


def most_frequent(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(Tables(spark, folder).frame("orders_dq"), 10)


# --- reports over a history of runs ---------------------------------------------------------


def run_history(tables: Tables) -> DataFrame:
    """Results of all rules by period of arrival: one run per period and table."""
    periods = [
        (tables.table(name), F.date_trunc(period, F.col(column)).cast("timestamp_ntz"))
        for name, (period, column) in PERIODS.items()
    ]
    return run_suite_by_period(periods, book(), tables.frame)


def summary_history(spark: SparkSession, folder: str) -> DataFrame:
    return summarise(run_history(Tables(spark, folder)), book())


def final_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.final_report(summary_history(spark, folder))


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return reports.latest_results(summary_history(spark, folder))


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Over the stored summary, as the history joins it with its own monthly scores."""
    store = Store(shared_root(spark))
    store.write(summary_history(spark, folder), book().layer("audit"), book().output("summary"))
    stored = store.read(spark, book().layer("audit"), book().output("summary"))
    return reports.score_history(stored).select(
        "table", "run_timestamp", "row_count", "dq_score", "previous_score", "score_change"
    )


def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpis(detail(run_history(Tables(spark, folder))), book())


def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of two runs: one over tables that load, one that also meets a missing table."""
    tables, store = Tables(spark, folder), Store(shared_root(spark))
    for at, names in ((RUN_AT, ["orders", "orders_dq"]), (datetime(2026, 1, 6, 6), ["customer", "missing"])):
        run = Run(spark, book(), store, moment(at), tables.frame)
        run.tables([TableRef("lake", "sales", name) for name in names], lambda r: tables.frame(r.table))
    return store.read(spark, book().layer("audit"), book().output("pipeline_runs"))


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    as_of = {"orders": datetime(2001, 8, 2), "lineitem": datetime(2001, 12, 24), "events": datetime(2024, 2, 1)}
    hours = CONFIG["framework"]["default_freshness_hours"]
    frames = [
        reports.freshness(tables.frame(name), EARLIER_RUNS[name][0], moment(at), hours).select(
            F.lit(name).alias("table"), "*"
        )
        for name, at in as_of.items()
    ]
    return union(frames)


QUERIES: dict[str, Query] = {
    "table_inventory": inventory,
    "discovered_inventory": discovered_inventory,
    "sink_roundtrip": sink_roundtrip,
    "sink_append_merge": sink_append_merge,
    "dq_detail": dq_detail,
    "dq_summary": dq_summary,
    "dq_repeated_run": repeated_run,
    "stored_profile": stored("profiling"),
    "stored_candidates": stored("candidates"),
    "dq01_completeness": rule_query("DQ01"),
    "dq02_accuracy": rule_query("DQ02"),
    "dq03_validity": rule_query("DQ03"),
    "dq04_uniqueness": rule_query("DQ04"),
    "dq05_consistency": rule_query("DQ05"),
    "dq06_integrity": rule_query("DQ06"),
    "dq06_integrity_nullable": rule_query("DQ06", lenient_book),
    "dq07_timeliness": rule_query("DQ07"),
    "dq08_conformity": rule_query("DQ08"),
    "dq09_range": rule_query("DQ09"),
    "dq10_duplicate": rule_query("DQ10"),
    "dq11_null": rule_query("DQ11"),
    "dq12_length": rule_query("DQ12"),
    "dq13_data_type": rule_query("DQ13"),
    "dq13_castable": castable_values,
    "dq14_pattern": rule_query("DQ14"),
    "dq15_business_rule": rule_query("DQ15"),
    "dq16_volume": rule_query("DQ16"),
    "dq_suite": dq_suite,
    "dq_all_tables": dq_all_tables,
    "dq_score": dq_score,
    "quality_gate": quality_gate,
    "ml_training": ml_training,
    "ml_dynamic_weights": ml_dynamic_weights,
    "ml_weight_properties": ml_weight_properties,
    "ml_planted_weight": planted_weights,
    "profile_table": profile,
    "profile_nested": profile_nested,
    "profile_merged": profile_merged,
    "rule_candidates": candidates,
    "top_values": most_frequent,
    "top_values_documents": most_frequent_texts,
    "normalize_columns": normalize_columns,
    "bronze": bronze,
    "silver": layer_query("silver"),
    "gold": layer_query("gold"),
    "promoted_tables": promoted_tables,
    "quarantine": quarantine,
    "quarantine_reasons": quarantine_reasons,
    "final_report": final_report,
    "v_dq_final_report": latest,
    "v_dq_history": history,
    "v_dq_kpis": kpis,
    "dq_run_totals": run_totals,
    "freshness": freshness,
}
