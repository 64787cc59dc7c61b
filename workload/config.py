"""Rules for the test tables, in the dictionary form users write."""

from __future__ import annotations

CONFIG = {
    "framework": {
        "catalog": "lake",
        "excluded_schemas": ["WEB"],
        "source_schema_allowlist": ["Sales", "Text"],
        "default_freshness_hours": 24,
        "volume_default_variance_pct": 30,
    },
    "ml_weighting": {
        "enabled": True,
        "incident_table": "supplier_history",
        "feature_columns": ["lines", "avg_quantity", "avg_discount", "avg_tax", "returned_share"],
        "target_column": "revenue",
    },
    "quality_gate": {"enabled": True, "silver_min_score": 90},
    "table_rules": {
        "lake.sales.orders_dq": {
            "mandatory_columns": ["o_orderkey", "o_custkey", "o_orderpriority"],
            "row_expressions": {"price_not_negative": "o_totalprice >= 0"},
            "allowed_values": {
                "o_orderstatus": ["O", "F", "P"],
                "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
            },
            "unique_keys": ["o_orderkey"],
            "consistency_rules": {"finished_below_limit": "o_orderstatus <> 'F' OR o_totalprice < 400000"},
            "date_columns": ["order date", "o_orderdate_str"],
            "conformity_rules": {"price_band": "o_totalprice BETWEEN 0 AND 490000"},
            "range_rules": {"o_totalprice": {"min": 0, "max": 495000}},
            "null_columns": ["o_custkey", "o_orderpriority"],
            "length_rules": {"o_orderpriority": {"min": 6, "max": 14}},
            "expected_types": {
                "o_orderkey": "bigint",
                "o_custkey": "bigint",
                "o_totalprice": "double",
                "o_orderdate": "timestamp",
                "o_orderdate_str": "string",
            },
            "pattern_rules": {"o_orderpriority": "^[1-5]-[A-Z ]+$"},
            "business_rules": {
                "open_if_recent": "o_orderstatus = 'O' OR o_orderdate < TIMESTAMP '2001-01-01 00:00:00'"
            },
        },
        "lake.sales.orders": {
            "unique_keys": ["o_orderkey"],
            "mandatory_columns": ["o_orderkey", "o_custkey", "o_orderdate"],
            "expected_types": {"o_orderkey": "bigint", "o_orderdate": "timestamp"},
        },
        "lake.sales.customer": {
            "unique_keys": ["c_custkey"],
            "row_expressions": {"balance_not_negative": "c_acctbal >= 0"},
            "DQ09": {"range_rules": {"c_acctbal": {"min": 0}}},
        },
        "lake.sales.lineitem": {
            "unique_keys": ["l_orderkey", "l_linenumber"],
            "mandatory_columns": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"],
            "null_columns": ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
            "row_expressions": {"price_positive": "l_extendedprice > 0", "discount_band": "l_discount <= 0.08"},
            "allowed_values": {"l_returnflag": ["A", "N", "R"], "l_linenumber": [1, 2, 3, 4, 5, 6]},
            "consistency_rules": {"taxed_if_discounted": "l_discount < 0.1 OR l_tax > 0"},
            "conformity_rules": {"quantity_band": "l_quantity BETWEEN 1 AND 45"},
            "range_rules": {"l_quantity": {"min": 1, "max": 49}, "l_tax": {"max": 0.08}},
            "length_rules": {"l_returnflag": {"min": 1, "max": 1}},
            "expected_types": {
                "l_orderkey": "bigint",
                "l_linenumber": "integer",
                "l_quantity": "int",
                "l_tax": "double",
            },
            "pattern_rules": {"l_linestatus": "^[FO]$"},
            "business_rules": {"large_orders_taxed": "NOT (l_quantity > 40 AND l_tax = 0)"},
            "date_columns": ["l_shipdate"],
        },
        "lake.sales.part": {
            "unique_keys": ["p_partkey"],
            "pattern_rules": {"p_brand": "^Brand#[0-9]{2}$"},
            "length_rules": {"p_name": {"min": 8}},
        },
        "lake.text.documents": {
            "unique_keys": ["text"],
            "length_rules": {"text": {"min": 40, "max": 4000}},
            "pattern_rules": {"source": "^src[0-9]$"},
            "allowed_values": {"lang": ["en", "de", "fr"]},
            "consistency_rules": {"length_recorded": "n_chars = length(text)"},
        },
        "lake.text.conversations": {
            "unique_keys": ["conv_id", "turn"],
            "allowed_values": {"role": ["user", "assistant"]},
        },
        "lake.web.events": {
            "unique_keys": ["event_id"],
            "allowed_values": {"event_type": ["view", "click", "purchase", "signup"]},
            "range_rules": {"value": {"max": 100}},
            "pattern_rules": {"props": '"k": [0-9]'},
        },
    },
    "relationships": [
        {
            "name": "order_customer",
            "child_table": "lake.sales.orders_dq",
            "child_column": "o_custkey",
            "parent_table": "lake.sales.customer_dq",
            "parent_column": "c_custkey",
            "nullable_allowed": False,
        },
        {
            "name": "line_order",
            "child_table": "lake.sales.lineitem",
            "child_column": "l_orderkey",
            "parent_table": "lake.sales.orders_dq",
            "parent_column": "o_orderkey",
        },
        {
            "name": "line_part",
            "child_table": "lake.sales.lineitem",
            "child_column": "l_partkey",
            "parent_table": "lake.sales.part",
            "parent_column": "p_partkey",
        },
        {
            "name": "document_label",
            "child_table": "lake.text.documents",
            "child_column": "doc_id",
            "parent_table": "lake.text.labels",
            "parent_column": "doc_id",
            "nullable_allowed": False,
        },
    ],
}
