"""Column expressions that turn counts into percentages, statuses, scores and gates."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Failure percentages up to which a rule is PASS, then WARNING.
PASS_UP_TO = 0.0
WARNING_UP_TO = 1.0


def percentage(failed: Column, checked: Column) -> Column:
    """``failed / checked * 100`` as a double; 0 where nothing was checked (ANSI-safe)."""
    ratio = F.try_divide(failed.cast("double"), checked.cast("double"))
    return F.coalesce(ratio * 100, F.lit(0.0))


def rule_status(pct: Column) -> Column:
    return (
        F.when(pct <= PASS_UP_TO, "PASS").when(pct <= WARNING_UP_TO, "WARNING").otherwise("FAIL")
    )


def volume_percentage(current: Column, previous: Column) -> Column:
    """Change against the previous row count; 0 without a usable one, 100 for an empty table."""
    change = percentage(F.abs(current - previous), previous)
    return F.when(current == 0, 100.0).otherwise(F.coalesce(change, F.lit(0.0)))


def volume_status(current: Column, previous: Column, pass_pct: float, warning_pct: float) -> Column:
    change = volume_percentage(current, previous)
    return (
        F.when(current == 0, "FAIL")
        .when(change <= float(pass_pct), "PASS")
        .when(change <= float(warning_pct), "WARNING")
        .otherwise("FAIL")
    )


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Aggregate over ``dq_id, status``: share of the enabled weight earned by PASS.

    In percent, two decimals. ``weights`` lists the enabled rules.
    """
    total = float(sum(weights.values()))
    if not total:
        return F.max(F.lit(0.0))
    weight = " ".join(f"WHEN '{dq_id}' THEN {float(w)}D" for dq_id, w in weights.items())
    earned = F.expr(f"coalesce(sum(CASE dq_id {weight} END) FILTER (WHERE status = 'PASS'), 0D)")
    return F.round(earned / total * 100, 2)


def overall_status(score: Column, thresholds: Mapping[str, Any]) -> Column:
    return (
        F.when(score >= float(thresholds["pass"]), "PASS")
        .when(score >= float(thresholds["warning"]), "WARNING")
        .otherwise("FAIL")
    )


def quality_gate(score: Column, gate: Mapping[str, Any]) -> Column:
    """Outcome of the gate; its ``threshold``, if not set, is the silver layer's minimum."""
    if not gate.get("enabled", True):
        return F.lit("DISABLED")
    threshold = float(gate.get("threshold", gate_minimum(gate)))
    return F.when(score >= threshold, "PASSED").otherwise("FAILED")


def gate_minimum(gate: Mapping[str, Any]) -> float:
    return float(gate.get("silver_min_score", 90))
