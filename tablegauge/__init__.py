"""Declarative data-quality and freshness auditing on Spark DataFrames.

Declare checks per table, measure them with a few map-side-combined aggregates, grade the
values against versioned thresholds and append the outcome to an audit table.
"""

from tablegauge.operators.checks import (
    Check,
    DistinctCount,
    OrphanCount,
    RowCount,
    Suite,
    count_where,
    coverage_gap_pct,
    deactivated_pct,
    foreign_key,
    matches,
    min_age,
    not_null,
    ordered,
    period_drop_pct,
    required_when,
    unique,
)
from tablegauge.operators.config import (
    FreshnessRuleChange,
    ThresholdChange,
    active_config,
    rollup_thresholds,
    update_freshness_rule,
    update_freshness_rules,
    update_threshold,
    update_thresholds,
)
from tablegauge.operators.freshness import (
    freshness_audit,
    lag_freshness,
    latest_runs,
    run_freshness,
)
from tablegauge.operators.grading import dq_audit, dq_grade
from tablegauge.operators.orphans import orphan_rows
from tablegauge.operators.rows import period_drop_summary, surplus_rows, violating_rows
from tablegauge.operators.states import refresh_states, summary_of_states
from tablegauge.operators.summary import dq_summary

__all__ = [
    "Check",
    "DistinctCount",
    "FreshnessRuleChange",
    "OrphanCount",
    "RowCount",
    "Suite",
    "ThresholdChange",
    "active_config",
    "count_where",
    "coverage_gap_pct",
    "deactivated_pct",
    "dq_audit",
    "dq_grade",
    "dq_summary",
    "foreign_key",
    "freshness_audit",
    "lag_freshness",
    "latest_runs",
    "matches",
    "min_age",
    "not_null",
    "ordered",
    "orphan_rows",
    "period_drop_pct",
    "period_drop_summary",
    "refresh_states",
    "required_when",
    "rollup_thresholds",
    "run_freshness",
    "summary_of_states",
    "surplus_rows",
    "unique",
    "update_freshness_rule",
    "update_freshness_rules",
    "update_threshold",
    "update_thresholds",
    "violating_rows",
]
