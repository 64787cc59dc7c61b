"""SQL for DuckDB, written independently of the engine, one per registered query.

``CHECKS`` states per table and rule which rows fail; everything else is built on it.
"""

from __future__ import annotations

from workload.config import CONFIG
from workload.tables import DIRTIED_SQL, SCHEMAS

PRIORITIES = "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"
RUN_AT = "TIMESTAMP '2026-01-05 06:00:00'"


def rows(*predicates: str) -> str:
    """Failed checks: each predicate counts its rows."""
    return " + ".join(f"count(*) FILTER (WHERE {p})" for p in predicates)


def repeats(table: str, *keys: str) -> str:
    return f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {table}))"


def orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"(SELECT count(*) FROM {child} c WHERE c.{key} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key}))"
    )


ORDER_ORPHANS = orphans("orders_dq", "o_custkey", "customer_dq", "c_custkey")
LINE_ORPHANS = (
    orphans("lineitem", "l_orderkey", "orders_dq", "o_orderkey")
    + " + "
    + orphans("lineitem", "l_partkey", "part", "p_partkey")
)
DOCUMENT_ORPHANS = orphans("documents", "doc_id", "labels", "doc_id")

# table -> rule -> failed checks, or (failed checks, values checked)
CHECKS: dict[str, dict[str, str | tuple[str, str]]] = {
    "orders_dq": {
        "DQ01": rows("o_orderkey IS NULL OR o_custkey IS NULL OR o_orderpriority IS NULL"),
        "DQ02": rows("NOT coalesce(o_totalprice >= 0, false)"),
        "DQ03": rows("o_orderstatus NOT IN ('O', 'F', 'P')", f"o_orderpriority NOT IN {PRIORITIES}"),
        "DQ04": repeats("orders_dq", "o_orderkey"),
        "DQ05": rows("NOT coalesce(o_orderstatus <> 'F' OR o_totalprice < 400000, false)"),
        "DQ06": rows("o_custkey IS NULL") + " + " + ORDER_ORPHANS,
        "DQ07": rows("o_orderdate_str IS NOT NULL AND TRY_CAST(o_orderdate_str AS DATE) IS NULL"),
        "DQ08": rows("NOT coalesce(o_totalprice BETWEEN 0 AND 490000, false)"),
        "DQ09": rows("o_totalprice < 0 OR o_totalprice > 495000"),
        "DQ10": repeats("orders_dq", "o_orderkey"),
        "DQ11": (rows("o_custkey IS NULL", "o_orderpriority IS NULL"), "count(*) * 2"),
        "DQ12": rows("length(o_orderpriority) < 6 OR length(o_orderpriority) > 14"),
        "DQ13": ("0", "5"),
        "DQ14": rows("NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')"),
        "DQ15": rows(
            "NOT coalesce(o_orderstatus = 'O' OR o_orderdate < TIMESTAMP '2001-01-01 00:00:00', false)"
        ),
    },
    "orders": {
        "DQ01": rows("o_orderkey IS NULL OR o_custkey IS NULL OR o_orderdate IS NULL"),
        "DQ04": repeats("orders", "o_orderkey"),
        "DQ10": repeats("orders", "o_orderkey"),
        "DQ13": ("0", "2"),
    },
    "customer": {
        "DQ02": rows("NOT coalesce(c_acctbal >= 0, false)"),
        "DQ04": repeats("customer", "c_custkey"),
        "DQ09": rows("c_acctbal < 0"),
        "DQ10": repeats("customer", "c_custkey"),
    },
    "lineitem": {
        "DQ01": rows(
            "l_orderkey IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL"
            " OR l_linenumber IS NULL OR l_shipdate IS NULL"
        ),
        "DQ02": rows("NOT coalesce(l_extendedprice > 0, false)", "NOT coalesce(l_discount <= 0.08::DOUBLE, false)"),
        "DQ03": rows("l_returnflag NOT IN ('A', 'N', 'R')", "l_linenumber NOT IN (1, 2, 3, 4, 5, 6)"),
        "DQ04": repeats("lineitem", "l_orderkey", "l_linenumber"),
        "DQ05": rows("NOT coalesce(l_discount < 0.1::DOUBLE OR l_tax > 0, false)"),
        "DQ06": LINE_ORPHANS,
        "DQ07": rows("l_shipdate IS NOT NULL AND TRY_CAST(l_shipdate AS DATE) IS NULL"),
        "DQ08": rows("NOT coalesce(l_quantity BETWEEN 1 AND 45, false)"),
        "DQ09": rows("l_quantity < 1 OR l_quantity > 49", "l_tax > 0.08::DOUBLE"),
        "DQ10": repeats("lineitem", "l_orderkey", "l_linenumber"),
        "DQ11": (
            rows(
                "l_orderkey IS NULL",
                "l_quantity IS NULL",
                "l_extendedprice IS NULL",
                "l_discount IS NULL",
                "l_tax IS NULL",
            ),
            "count(*) * 5",
        ),
        "DQ12": rows("length(l_returnflag) <> 1"),
        "DQ13": ("1", "4"),
        "DQ14": rows("NOT regexp_matches(l_linestatus, '^[FO]$')"),
        "DQ15": rows("NOT coalesce(NOT (l_quantity > 40 AND l_tax = 0), false)"),
    },
    "part": {
        "DQ04": repeats("part", "p_partkey"),
        "DQ10": repeats("part", "p_partkey"),
        "DQ12": rows("length(p_name) < 8"),
        "DQ14": rows("NOT regexp_matches(p_brand, '^Brand#[0-9]{2}$')"),
    },
    "documents": {
        "DQ03": rows("lang NOT IN ('en', 'de', 'fr')"),
        "DQ04": repeats("documents", "text"),
        "DQ05": rows("NOT coalesce(n_chars = length(text), false)"),
        "DQ06": rows("doc_id IS NULL") + " + " + DOCUMENT_ORPHANS,
        "DQ10": repeats("documents", "text"),
        "DQ12": rows("length(text) < 40 OR length(text) > 4000"),
        "DQ14": rows("NOT regexp_matches(source, '^src[0-9]$')"),
    },
    "conversations": {
        "DQ03": rows("role NOT IN ('user', 'assistant')"),
        "DQ04": repeats("conversations", "conv_id", "turn"),
        "DQ10": repeats("conversations", "conv_id", "turn"),
    },
    "events": {
        "DQ03": rows("event_type NOT IN ('view', 'click', 'purchase', 'signup')"),
        "DQ04": repeats("events", "event_id"),
        "DQ09": rows("value > 100"),
        "DQ10": repeats("events", "event_id"),
        "DQ14": rows("""NOT regexp_matches(props, '"k": [0-9]')"""),
    },
}

COLUMN_COUNTS = {
    "orders_dq": 7,
    "orders": 6,
    "customer": 5,
    "lineitem": 11,
    "part": 6,
    "documents": 5,
    "conversations": 4,
    "events": 6,
}

RULES = [f"DQ{i:02d}" for i in range(1, 17)]

# Weights of the rules.
WEIGHTS = dict(zip(RULES, [10, 10, 8, 8, 7, 7, 6, 5, 5, 7, 8, 4, 5, 4, 5, 1]))

DIMENSIONS = dict(
    zip(
        RULES,
        "completeness accuracy validity uniqueness consistency integrity timeliness conformity range"
        " duplicate null length data_type pattern business_rule volume".split(),
    )
)

# Earlier runs of the volume rule: timestamp column and day of the newest run.
NEWEST_RUN = {
    "orders": ("o_orderdate", "2001-01-01"),
    "lineitem": ("l_shipdate", "2000-01-01"),
    "events": ("ts", "2024-01-25"),
}

STATUS = "CASE WHEN pct <= 0 THEN 'PASS' WHEN pct <= 1 THEN 'WARNING' ELSE 'FAIL' END"
VOLUME_STATUS = "CASE WHEN pct <= 15 THEN 'PASS' WHEN pct <= 30 THEN 'WARNING' ELSE 'FAIL' END"
PCT = "CASE WHEN checked = 0 THEN 0.0 ELSE failed::DOUBLE / checked::DOUBLE * 100 END"


def key(table: str) -> str:
    return f"""'lake' AS "catalog", '{SCHEMAS[table]}' AS "schema", '{table}' AS "table\""""


def graded(pairs: list[tuple[str, str]], with_volume: bool = False) -> str:
    """CTEs ending in ``graded``: one row per (table, rule) pair, not aggregated further."""
    parts = []
    for table, rule in pairs:
        check = CHECKS.get(table, {}).get(rule, "0")
        failed, checked = check if isinstance(check, tuple) else (check, "count(*)")
        if rule == "DQ16" and with_volume and table in NEWEST_RUN:
            column, day = NEWEST_RUN[table]
            failed = f"abs(count(*) - count(*) FILTER (WHERE {column} < TIMESTAMP '{day} 00:00:00'))"
            checked = f"count(*) FILTER (WHERE {column} < TIMESTAMP '{day} 00:00:00')"
        parts.append(
            f"""SELECT {key(table)}, '{rule}' AS dq_id, ({failed})::BIGINT AS failed,
                ({checked})::BIGINT AS checked, count(*)::BIGINT AS row_count,
                {COLUMN_COUNTS[table]}::BIGINT AS column_count FROM {table}"""
        )
    return f"""WITH {DIRTIED_SQL}, counted AS ({' UNION ALL '.join(parts)}),
        measured AS (SELECT *, {PCT} AS pct FROM counted),
        graded AS (SELECT "catalog", "schema", "table", {RUN_AT} AS run_timestamp, dq_id,
            CASE WHEN dq_id = 'DQ16' THEN {VOLUME_STATUS} ELSE {STATUS} END AS status,
            pct AS failure_percentage,
            CASE WHEN dq_id = 'DQ16' THEN 0 ELSE failed END AS failed_records,
            row_count, column_count FROM measured)"""


def every(tables: list[str]) -> list[tuple[str, str]]:
    return [(table, rule) for table in tables for rule in RULES]


def rule_oracle(rule: str, tables: list[str] | None = None) -> str:
    tables = tables or [t for t in CHECKS if rule in CHECKS[t]]
    return (
        graded([(t, rule) for t in tables], with_volume=True)
        + """ SELECT "table", dq_id, status, failure_percentage, failed_records, row_count FROM graded"""
    )


DETAIL = """ SELECT "catalog", "schema", "table", run_timestamp, dq_id, status, failure_percentage,
    failed_records FROM graded"""


def summary_cte(source: str, name: str = "summary") -> str:
    """CTE: pivot of ``source`` with score, status and gate."""
    pivot = ", ".join(
        f"coalesce(max(status) FILTER (WHERE dq_id = '{r}'), 'WARNING') AS {r.lower()}" for r in RULES
    )
    weight = "CASE dq_id " + " ".join(f"WHEN '{r}' THEN {w}" for r, w in WEIGHTS.items()) + " END"
    return f"""scored AS (SELECT "catalog", "schema", "table", run_timestamp,
            max(row_count) AS row_count, max(column_count) AS column_count, {pivot},
            round(coalesce(sum({weight}) FILTER (WHERE status = 'PASS'), 0)::DOUBLE, 2) AS dq_score
            FROM {source} GROUP BY ALL),
        {name} AS (SELECT *, CASE WHEN dq_score >= 90 THEN 'PASS' WHEN dq_score >= 75 THEN 'WARNING'
            ELSE 'FAIL' END AS overall_status,
            CASE WHEN dq_score >= 90 THEN 'PASSED' ELSE 'FAILED' END AS quality_gate FROM scored)"""


def summary(tables: list[str], select: str, with_volume: bool = False) -> str:
    return f"{graded(every(tables), with_volume)}, {summary_cte('graded')} {select}"


SCORED = ["orders", "customer", "orders_dq"]
ALL_TABLES = list(CHECKS)


# --- history of runs by period of arrival ----------------------------------------------

PERIODS = {"orders_dq": ("year", "o_orderdate"), "lineitem": ("year", "l_shipdate"), "events": ("week", "ts")}


# Keys and parents of the tables with periods: (child key, parent, parent key)
UNIQUE = {"orders_dq": "o_orderkey", "lineitem": "l_orderkey, l_linenumber", "events": "event_id"}
PARENTS = {
    "orders_dq": [("o_custkey", "customer_dq", "c_custkey")],
    "lineitem": [("l_orderkey", "orders_dq", "o_orderkey"), ("l_partkey", "part", "p_partkey")],
}


def period_check(table: str, rule: str) -> str | tuple[str, str]:
    """As ``CHECKS``, within a period; orphans are marked in the table read."""
    if rule in ("DQ04", "DQ10"):
        return f"count(*) - count(DISTINCT row({UNIQUE[table]}))"
    if rule == "DQ06":
        marks = [f"orphan_{i}" for i in range(len(PARENTS.get(table, [])))]
        return rows(*marks, *(["o_custkey IS NULL"] if table == "orders_dq" else [])) or "0"
    return CHECKS[table].get(rule, "0")


def run_history() -> str:
    parts = []
    for table, (period, column) in PERIODS.items():
        at, own = f"date_trunc('{period}', {column})::TIMESTAMP", f"{COLUMN_COUNTS[table]}::BIGINT AS column_count"
        orphan = "".join(
            f", t.{child} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = t.{child})"
            f" AS orphan_{i}"
            for i, (child, parent, parent_key) in enumerate(PARENTS.get(table, []))
        )
        for rule in RULES[:-1]:
            check = period_check(table, rule)
            failed, checked = check if isinstance(check, tuple) else (check, "count(*)")
            source = f"(SELECT t.*{orphan} FROM {table} t)" if rule == "DQ06" else table
            parts.append(
                f"""SELECT {key(table)}, {at} AS run_timestamp, '{rule}' AS dq_id, ({failed})::BIGINT AS failed,
                    ({checked})::BIGINT AS checked, count(*)::BIGINT AS row_count, {own}
                    FROM {source} GROUP BY {at}"""
            )
        parts.append(
            f"""SELECT {key(table)}, run_timestamp, 'DQ16', coalesce(abs(n - before), 0), coalesce(before, 0), n, {own}
                FROM (SELECT *, lag(n) OVER (ORDER BY run_timestamp) AS before FROM (
                    SELECT {at} AS run_timestamp, count(*)::BIGINT AS n FROM {table} GROUP BY {at}))"""
        )
    return f"""WITH {DIRTIED_SQL}, counted AS ({' UNION ALL '.join(parts)}),
        measured AS (SELECT *, {PCT} AS pct FROM counted),
        history AS (SELECT "catalog", "schema", "table", run_timestamp, dq_id,
            CASE WHEN dq_id = 'DQ16' THEN {VOLUME_STATUS} ELSE {STATUS} END AS status,
            pct AS failure_percentage, CASE WHEN dq_id = 'DQ16' THEN 0 ELSE failed END AS failed_records,
            row_count, column_count FROM measured)"""


HISTORY = f"{run_history()}, {summary_cte('history')}"
SUMMARY_COLUMNS = (
    '"catalog", "schema", "table", run_timestamp, row_count, column_count, '
    + ", ".join(r.lower() for r in RULES)
    + ", dq_score, overall_status, quality_gate"
)


def kpi_oracle() -> str:
    dimension = "CASE dq_id " + " ".join(f"WHEN '{r}' THEN '{d}'" for r, d in DIMENSIONS.items()) + " END"
    return f"""{run_history()}, named AS (SELECT *, {dimension} AS dimension FROM history)
        SELECT "catalog", "schema", "table", dimension, count(*) AS checks,
            count(*) FILTER (WHERE status = 'PASS') AS passed,
            count(*) FILTER (WHERE status = 'WARNING') AS warnings,
            count(*) FILTER (WHERE status = 'FAIL') AS failed,
            round(count(*) FILTER (WHERE status = 'PASS')::DOUBLE / count(*)::DOUBLE * 100, 4) AS pass_rate,
            round(avg(failure_percentage), 4) AS mean_failure_percentage
        FROM named
        GROUP BY GROUPING SETS (("catalog", "schema", "table", dimension), (dimension))"""


# --- profile ----------------------------------------------------------------------------

COLUMNS = {
    "orders_dq": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderdate_str": "string",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
}


def profile_cte(tables: list[str]) -> str:
    parts = [
        f"""SELECT {key(table)}, '{column}' AS column_name, '{kind}' AS data_type, count(*) AS row_count,
            count(*) - count({column}) AS null_count,
            (SELECT count(*) FROM (SELECT DISTINCT {column} FROM {table})) AS distinct_count FROM {table}"""
        for table in tables
        for column, kind in COLUMNS[table].items()
    ]
    return f"""WITH {DIRTIED_SQL}, counted AS ({' UNION ALL '.join(parts)}),
        profile AS (SELECT * EXCLUDE (distinct_count),
            CASE WHEN row_count = 0 THEN 0.0 ELSE null_count::DOUBLE / row_count::DOUBLE * 100 END
            AS null_percentage, distinct_count, {RUN_AT} AS profile_timestamp FROM counted)"""


def candidate_oracle(tables: list[str]) -> str:
    columns = '"catalog", "schema", "table", column_name'
    return f"""{profile_cte(tables)}
        SELECT {columns}, 'NULL_CHECK' AS candidate_rule, 'Null percentage exceeds 1.0%' AS reason,
            profile_timestamp AS created_timestamp FROM profile WHERE null_percentage > 1.0
        UNION ALL
        SELECT {columns}, 'LOW_CARDINALITY', 'Column contains one distinct value', profile_timestamp
            FROM profile WHERE distinct_count = 1 AND row_count > 1"""


def top_value_oracle(table: str, n: int) -> str:
    parts = [
        f"""SELECT '{column}' AS column_name, {column}::VARCHAR AS value, count(*) AS value_count,
            row_number() OVER (ORDER BY count(*) DESC, {column} ASC NULLS LAST)::INT AS rank
            FROM {table} GROUP BY {column}"""
        for column in COLUMNS[table]
    ]
    return f"""WITH {DIRTIED_SQL}, ranked AS ({' UNION ALL '.join(parts)})
        SELECT * FROM ranked WHERE rank <= {n}"""


# --- layers ------------------------------------------------------------------------------

PART_COLUMNS = (
    "p_partkey AS part_key, p_name AS part_key_1, p_brand AS p_name, p_type AS _1st_type,"
    ' p_size AS "column", p_retailprice AS part_key_1_1'
)

ANY_FAILURE = {
    "DQ01": "o_orderkey IS NULL OR o_custkey IS NULL OR o_orderpriority IS NULL",
    "DQ02": "NOT coalesce(o_totalprice >= 0, false)",
    "DQ03": f"o_orderstatus NOT IN ('O', 'F', 'P') OR o_orderpriority NOT IN {PRIORITIES}",
    "DQ05": "NOT coalesce(o_orderstatus <> 'F' OR o_totalprice < 400000, false)",
    "DQ07": "o_orderdate_str IS NOT NULL AND TRY_CAST(o_orderdate_str AS DATE) IS NULL",
    "DQ08": "NOT coalesce(o_totalprice BETWEEN 0 AND 490000, false)",
    "DQ09": "o_totalprice < 0 OR o_totalprice > 495000",
    "DQ11": "o_custkey IS NULL OR o_orderpriority IS NULL",
    "DQ12": "length(o_orderpriority) < 6 OR length(o_orderpriority) > 14",
    "DQ14": "NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')",
    "DQ15": "NOT coalesce(o_orderstatus = 'O' OR o_orderdate < TIMESTAMP '2001-01-01 00:00:00', false)",
}

QUARANTINED = " OR ".join(f"coalesce({p}, false)" for p in ANY_FAILURE.values())
REASONS = f"concat_ws(',', {', '.join(f"CASE WHEN {p} THEN '{r}' END" for r, p in ANY_FAILURE.items())})"

INVENTORY = {
    "region": 2,
    "nation": 3,
    "customer": 5,
    "supplier": 4,
    "part": 6,
    "orders": 6,
    "lineitem": 11,
    "documents": 5,
    "benchmark": 2,
    "labels": 3,
    "conversations": 4,
    "embeddings": 3,
}


def run_total(at: str, tables: list[str], failed: int) -> str:
    """Totals of one run: candidates are counted, the other numbers follow from the tables."""
    columns = sum(COLUMN_COUNTS[t] for t in tables)
    found = candidate_oracle([t for t in tables if t in COLUMNS])
    return f"""SELECT TIMESTAMP '{at}' AS run_timestamp, {len(tables) + failed}::BIGINT AS tables_discovered,
        {len(tables)}::BIGINT AS tables_processed,
        {failed}::BIGINT AS tables_failed, {len(tables)}::BIGINT AS summary_records,
        {16 * len(tables)}::BIGINT AS detail_records, {columns}::BIGINT AS profile_records,
        (SELECT count(*) FROM ({found})) AS candidate_records"""


SUPPLIER_HISTORY = """SELECT l_suppkey, count(*) AS lines, avg(l_quantity) AS avg_quantity,
    avg(l_discount) AS avg_discount, avg(l_tax) AS avg_tax,
    avg((l_returnflag = 'R')::INT) AS returned_share,
    sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY l_suppkey"""
FEATURES = CONFIG["ml_weighting"]["feature_columns"]

PART_HISTORY = """SELECT l_partkey, count(*) AS lines, avg(l_quantity) AS avg_quantity,
    avg(l_discount) AS avg_discount, avg(l_tax) AS avg_tax,
    avg((l_returnflag = 'R')::INT) AS returned_share FROM lineitem GROUP BY l_partkey"""

ORACLES: dict[str, str] = {
    "table_inventory": " UNION ALL ".join(
        f"""SELECT '{SCHEMAS[t]}' AS "schema", '{t}' AS "table", count(*) AS row_count,
            {n}::BIGINT AS column_count FROM {t}"""
        for t, n in INVENTORY.items()
    ),
    "discovered_inventory": " UNION ALL ".join(
        f"""SELECT 'tablewarden_{SCHEMAS[t]}' AS "schema", '{t}' AS "table", count(*) AS row_count,
            {n}::BIGINT AS column_count FROM {t}"""
        for t, n in INVENTORY.items()
    ),
    "sink_roundtrip": "SELECT * FROM orders",
    "sink_append_merge": """SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation,
        s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
        UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "dq_detail": graded(every(SCORED)) + DETAIL,
    "dq_summary": summary(SCORED, f"SELECT {SUMMARY_COLUMNS} FROM summary"),
    "dq_repeated_run": f"""SELECT * FROM (VALUES ('dq_summary', {len(SCORED)}::BIGINT),
            ('dq_audit_results', {16 * len(SCORED)}), ('dq_pipeline_runs', 1),
            ('dq_profile', {sum(COLUMN_COUNTS[t] for t in SCORED)})) AS stored("table", row_count)
        UNION ALL SELECT 'dq_rule_candidates', count(*) FROM ({candidate_oracle(SCORED)})""",
    "stored_profile": f"{profile_cte(SCORED)} SELECT * FROM profile",
    "stored_candidates": candidate_oracle(SCORED),
    "dq01_completeness": rule_oracle("DQ01"),
    "dq02_accuracy": rule_oracle("DQ02"),
    "dq03_validity": rule_oracle("DQ03"),
    "dq04_uniqueness": rule_oracle("DQ04"),
    "dq05_consistency": rule_oracle("DQ05"),
    "dq06_integrity": rule_oracle("DQ06"),
    "dq06_integrity_nullable": f"""WITH {DIRTIED_SQL}, counted AS (
            SELECT 'orders_dq' AS "table", {ORDER_ORPHANS} AS failed, count(*) AS row_count FROM orders_dq
            UNION ALL SELECT 'lineitem', {LINE_ORPHANS}, count(*) FROM lineitem
            UNION ALL SELECT 'documents', {DOCUMENT_ORPHANS}, count(*) FROM documents),
        measured AS (SELECT *, failed::DOUBLE / row_count::DOUBLE * 100 AS pct FROM counted)
        SELECT "table", 'DQ06' AS dq_id, {STATUS} AS status, pct AS failure_percentage,
            failed AS failed_records, row_count FROM measured""",
    "dq07_timeliness": rule_oracle("DQ07"),
    "dq08_conformity": rule_oracle("DQ08"),
    "dq09_range": rule_oracle("DQ09"),
    "dq10_duplicate": rule_oracle("DQ10"),
    "dq11_null": rule_oracle("DQ11"),
    "dq12_length": rule_oracle("DQ12"),
    "dq13_data_type": rule_oracle("DQ13"),
    "dq13_castable": f"""WITH {DIRTIED_SQL}, counted AS (
            SELECT 'o_orderdate_str' AS column_name, 'date' AS expected_type, count(*) AS checked,
                {rows("o_orderdate_str IS NOT NULL AND TRY_CAST(o_orderdate_str AS DATE) IS NULL")} AS failed
                FROM orders_dq
            UNION ALL SELECT 'priority_code', 'int', count(*),
                {rows("o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS INT) IS NULL")}
                FROM orders_dq
            UNION ALL SELECT 'custkey_text', 'bigint', count(*),
                {rows("o_custkey IS NOT NULL AND TRY_CAST(o_custkey::VARCHAR AS BIGINT) IS NULL")}
                FROM orders_dq),
        measured AS (SELECT *, {PCT} AS pct FROM counted)
        SELECT column_name, expected_type, {STATUS} AS status, pct AS failure_percentage,
            failed AS failed_records FROM measured""",
    "dq14_pattern": rule_oracle("DQ14"),
    "dq15_business_rule": rule_oracle("DQ15"),
    "dq16_volume": rule_oracle("DQ16", ["orders", "lineitem", "events", "customer"]),
    "dq_suite": graded(every(["orders_dq", "lineitem"]), with_volume=True) + DETAIL,
    "dq_all_tables": summary(ALL_TABLES, f"SELECT {SUMMARY_COLUMNS} FROM summary", with_volume=True),
    "dq_score": summary(SCORED, 'SELECT "table", dq_score, overall_status FROM summary'),
    "quality_gate": summary(
        SCORED, 'SELECT "table", dq_score, 90.0::DOUBLE AS gate_minimum, quality_gate FROM summary'
    ),
    "ml_training": f"""SELECT l_suppkey, lines, round(avg_quantity, 6) AS avg_quantity,
        round(avg_discount, 6) AS avg_discount, round(avg_tax, 6) AS avg_tax,
        round(returned_share, 6) AS returned_share, round(revenue, 2) AS revenue FROM ({SUPPLIER_HISTORY})""",
    # one row for each feature that the training rows have
    "ml_weight_properties": f"""SELECT kpi, true AS is_share, true AS adds_up FROM (
        UNPIVOT (SELECT {", ".join(f"count({c}) AS {c}" for c in FEATURES)} FROM ({SUPPLIER_HISTORY}))
        ON {", ".join(FEATURES)} INTO NAME kpi VALUE filled) WHERE filled > 0""",
    # the feature that goes with the target most closely
    "ml_planted_weight": f"""WITH history AS (SELECT *, 5 + 40 * avg_discount AS impact FROM ({PART_HISTORY})),
        linked AS ({" UNION ALL ".join(f"SELECT '{c}' AS kpi, abs(corr({c}, impact)) AS r FROM history" for c in FEATURES)})
        SELECT method, (SELECT arg_max(kpi, r) FROM linked) AS kpi
        FROM (VALUES ('impurity'), ('permutation')) AS methods(method)""",
    "profile_nested": f"{profile_cte(['embeddings', 'conversations'])} SELECT * FROM profile",
    "profile_merged": f"""{profile_cte(['orders_dq', 'lineitem'])}
        SELECT "table", column_name, row_count, null_count,
            CASE WHEN distinct_count <= 50 THEN distinct_count END AS few_distinct,
            true AS is_close FROM profile""",
    "top_values_documents": top_value_oracle("documents", 10),
    "profile_table": f"{profile_cte(['orders_dq', 'lineitem', 'documents'])} SELECT * FROM profile",
    "rule_candidates": candidate_oracle(["orders_dq", "customer", "labels"]),
    "top_values": top_value_oracle("orders_dq", 10),
    "normalize_columns": f"SELECT {PART_COLUMNS} FROM part",
    "bronze": f"""SELECT {PART_COLUMNS}, {RUN_AT} AS _dq_ingestion_timestamp,
        'lake' AS _dq_source_catalog, 'sales' AS _dq_source_schema, 'part' AS _dq_source_table FROM part""",
    "silver": "SELECT *, 'orders' AS \"table\" FROM orders",
    "gold": f"""SELECT *, 100.0::DOUBLE AS _dq_quality_score, 'PASS' AS _dq_overall_status,
        {RUN_AT} AS _dq_gold_timestamp, 'orders' AS "table" FROM orders""",
    "promoted_tables": f"""WITH {DIRTIED_SQL}
        SELECT 'orders_dq' AS "table", 'bronze' AS layer, count(*) AS row_count FROM orders_dq
        UNION ALL SELECT 'orders_dq', 'quarantine', count(*) FROM orders_dq WHERE {QUARANTINED}
        UNION ALL SELECT 'orders', layer, n FROM (SELECT count(*) AS n FROM orders),
            (VALUES ('bronze'), ('silver'), ('gold')) AS layers(layer)""",
    "quarantine": f"""WITH {DIRTIED_SQL} SELECT *, 'run-1' AS _dq_run_id,
        'lake.sales.orders_dq' AS _dq_source_table, {RUN_AT} AS _dq_quarantine_timestamp
        FROM orders_dq WHERE {QUARANTINED}""",
    "quarantine_reasons": f"""WITH {DIRTIED_SQL}
        SELECT {REASONS} AS reasons, count(*) AS row_count
        FROM orders_dq GROUP BY 1""",
    "final_report": f"""{HISTORY} SELECT {SUMMARY_COLUMNS} FROM summary
        ORDER BY run_timestamp DESC, "catalog", "schema", "table" LIMIT 100""",
    "v_dq_final_report": f"""{HISTORY} SELECT {SUMMARY_COLUMNS} FROM summary QUALIFY row_number() OVER (
        PARTITION BY "catalog", "schema", "table" ORDER BY run_timestamp DESC) = 1""",
    "v_dq_history": f"""{HISTORY}, chained AS (SELECT "table", run_timestamp, row_count, dq_score,
            lag(dq_score) OVER (PARTITION BY "table" ORDER BY run_timestamp) AS previous_score FROM summary)
        SELECT *, dq_score - previous_score AS score_change FROM chained""",
    "v_dq_kpis": kpi_oracle(),
    "dq_run_totals": run_total("2026-01-05 06:00:00", ["orders", "orders_dq"], 0)
    + " UNION ALL "
    + run_total("2026-01-06 06:00:00", ["customer"], 1),
    "freshness": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", max({c}) AS newest_timestamp,
            max({c}) < TIMESTAMP '{day} 00:00:00' - INTERVAL 24 HOUR AS is_stale FROM {t}"""
        for t, c, day in (
            ("orders", "o_orderdate", "2001-08-02"),
            ("lineitem", "l_shipdate", "2001-12-24"),
            ("events", "ts", "2024-02-01"),
        )
    ),
}
