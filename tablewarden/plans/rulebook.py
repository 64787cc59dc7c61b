"""The rule configuration: a plain dictionary, checked and looked up per table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablewarden.functions.names import TableRef

# The sixteen rules (id, dimension, level, default weight, severity).
RULE_CATALOG = [
    {"id": "DQ01", "dimension": "completeness", "level": "column", "default_weight": 10, "severity": "high"},
    {"id": "DQ02", "dimension": "accuracy", "level": "row", "default_weight": 10, "severity": "high"},
    {"id": "DQ03", "dimension": "validity", "level": "column", "default_weight": 8, "severity": "high"},
    {"id": "DQ04", "dimension": "uniqueness", "level": "dataset", "default_weight": 8, "severity": "critical"},
    {"id": "DQ05", "dimension": "consistency", "level": "row", "default_weight": 7, "severity": "medium"},
    {"id": "DQ06", "dimension": "integrity", "level": "cross_table", "default_weight": 7, "severity": "critical"},
    {"id": "DQ07", "dimension": "timeliness", "level": "dataset", "default_weight": 6, "severity": "high"},
    {"id": "DQ08", "dimension": "conformity", "level": "column", "default_weight": 5, "severity": "medium"},
    {"id": "DQ09", "dimension": "range", "level": "row", "default_weight": 5, "severity": "high"},
    {"id": "DQ10", "dimension": "duplicate", "level": "dataset", "default_weight": 7, "severity": "high"},
    {"id": "DQ11", "dimension": "null", "level": "column", "default_weight": 8, "severity": "high"},
    {"id": "DQ12", "dimension": "length", "level": "column", "default_weight": 4, "severity": "medium"},
    {"id": "DQ13", "dimension": "data_type", "level": "column", "default_weight": 5, "severity": "high"},
    {"id": "DQ14", "dimension": "pattern", "level": "column", "default_weight": 4, "severity": "medium"},
    {"id": "DQ15", "dimension": "business_rule", "level": "row", "default_weight": 5, "severity": "critical"},
    {"id": "DQ16", "dimension": "volume", "level": "dataset", "default_weight": 1, "severity": "medium"},
]

# The table property each rule reads (DQ06 and DQ16 read none).
RULE_PROPERTY = {
    "DQ01": "mandatory_columns",
    "DQ02": "row_expressions",
    "DQ03": "allowed_values",
    "DQ04": "unique_keys",
    "DQ05": "consistency_rules",
    "DQ07": "date_columns",
    "DQ08": "conformity_rules",
    "DQ09": "range_rules",
    "DQ10": "unique_keys",
    "DQ11": "null_columns",
    "DQ12": "length_rules",
    "DQ13": "expected_types",
    "DQ14": "pattern_rules",
    "DQ15": "business_rules",
}

# Names of the output tables.
OUTPUT_TABLES = {
    "audit": "dq_audit_results",
    "summary": "dq_summary",
    "quarantine": "dq_quarantine",
    "profiling": "dq_profile",
    "candidates": "dq_rule_candidates",
    "kpi": "dq_kpis",
    "weights": "dq_dynamic_weights",
    "pipeline_runs": "dq_pipeline_runs",
    "sketches": "dq_profile_sketches",
}

RULE_IDS = tuple(rule["id"] for rule in RULE_CATALOG)


class Rulebook:
    """Read access to one configuration dictionary.

    Sections (all optional): ``framework``, ``overall_thresholds``, ``quality_gate``,
    ``dq_rules``, ``table_rules`` (by full table name), ``relationships``,
    ``profiling``, ``ml_weighting``, ``output_tables``.
    """

    def __init__(self, config: Mapping[str, Any] | None = None):
        self.config = dict(config or {})
        self.rules = {rule["id"]: rule for rule in self.config.get("dq_rules", RULE_CATALOG)}
        self.thresholds = self.config.get("overall_thresholds", {"pass": 90, "warning": 75, "fail": 0})
        self.gate = self.config.get("quality_gate", {})
        self.framework = self.config.get("framework", {})
        self._check()

    def _check(self) -> None:
        listed = [rule["id"] for rule in self.config.get("dq_rules", RULE_CATALOG)]
        if listed != list(RULE_IDS):
            raise ValueError(f"dq_rules must list {RULE_IDS[0]} to {RULE_IDS[-1]} in order, got {listed}")
        if any(float(rule.get("default_weight", 0)) < 0 for rule in self.rules.values()):
            raise ValueError("a rule has a negative default_weight")
        if abs(sum(self.weights.values()) - 100) > 0.01:
            raise ValueError(f"weights of enabled rules must total 100, got {sum(self.weights.values())}")
        if float(self.thresholds["pass"]) <= float(self.thresholds["warning"]):
            raise ValueError("overall_thresholds: pass must lie above warning")

    @property
    def candidate_null_pct(self) -> float:
        return float(self.config.get("profiling", {}).get("candidate_null_rate_pct", 1.0))

    @property
    def sketches(self) -> bool:
        """Whether runs also keep sketches of their profiles, which can be united later."""
        return bool(self.config.get("profiling", {}).get("sketches", False))

    def enabled(self, dq_id: str) -> bool:
        return bool(self.rules[dq_id].get("enabled", True))

    @property
    def weights(self) -> dict[str, float]:
        return {
            dq_id: float(rule.get("default_weight", 0))
            for dq_id, rule in self.rules.items()
            if self.enabled(dq_id)
        }

    @property
    def volume_pass_pct(self) -> float:
        return float(self.framework.get("volume_pass_variance_pct", 15))

    @property
    def volume_warning_pct(self) -> float:
        return float(self.framework.get("volume_default_variance_pct", 30))

    def layer(self, name: str) -> str:
        """Schema of a layer: ``bronze``, ``silver``, ``gold``, ``audit``, ``quarantine``, ``candidate``."""
        return self.framework.get(f"{name}_schema", name)

    def output(self, name: str) -> str:
        """Table name of an output, e.g. ``summary``."""
        return self.config.get("output_tables", {}).get(name, OUTPUT_TABLES[name])

    def setting(self, table: TableRef, dq_id: str) -> Any:
        """What the rule checks on ``table``: flat table property, else nested, else global."""
        name = RULE_PROPERTY[dq_id]
        of_table = self.config.get("table_rules", {}).get(table.full) or {}
        nested = of_table.get(dq_id)
        layers = [of_table, nested if isinstance(nested, Mapping) else {}, self.rules[dq_id]]
        return next((layer[name] for layer in layers if name in layer), None)

    def relationships(self, table: TableRef) -> list[Mapping[str, Any]]:
        return [r for r in self.config.get("relationships") or [] if r.get("child_table") == table.full]

    def catalog_frame(self, spark: SparkSession) -> DataFrame:
        """The rule catalog as data: sixteen rows, to be joined for reports."""
        rows = [
            (
                dq_id,
                rule.get("dimension"),
                rule.get("level"),
                self.enabled(dq_id),
                float(rule.get("default_weight", 0)),
                rule.get("severity"),
            )
            for dq_id, rule in self.rules.items()
        ]
        return spark.createDataFrame(
            rows,
            "dq_id string, dimension string, level string, enabled boolean, weight double, severity string",
        )
