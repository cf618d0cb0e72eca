"""Versioned thresholds and freshness rules.

A change deactivates the rows it replaces and appends a new active row, so the table keeps its
history. Each function returns the whole new table; `sources.config_store` writes it as a new
version, because a Spark job must not overwrite the files it is reading.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge import schemas
from tablegauge.functions import ntz_literal
from tablegauge.sources.local import local_frame


@dataclass(frozen=True, kw_only=True)
class ThresholdChange:
    table_name: str
    check_name: str
    decision_id: str
    severity: str
    threshold_type: str
    threshold_value: int
    lookback_days: int | None = None
    notes: str | None = None


@dataclass(frozen=True, kw_only=True)
class FreshnessRuleChange:
    target_table: str
    decision_id: str
    rule_name: str
    date_column: str
    severity: str
    expected_lag_days: int | None = None
    sla_hour_et: int | None = None
    notes: str | None = None


# A threshold is replaced by table and check, a rule by decision and rule name.
_THRESHOLD_MATCH = ("table_name", "check_name")
_RULE_MATCH = ("decision_id", "rule_name")


def active_config(config: DataFrame) -> DataFrame:
    return config.filter("is_active")


def rollup_thresholds(thresholds: DataFrame) -> DataFrame:
    """Checks per table: all of them, those that fail, those that warn and the active ones."""
    return (
        thresholds.groupBy("table_name")
        .agg(
            F.count("*").alias("total_checks"),
            F.count_if(F.col("severity") == "FAIL").alias("fail_checks"),
            F.count_if(F.col("severity") == "WARN").alias("warn_checks"),
            F.count_if("is_active").alias("active_checks"),
        )
        .orderBy("table_name")
    )


def _require(changes: Sequence, nullable: set[str]) -> None:
    for change in changes:
        for f in fields(change):
            if getattr(change, f.name) is None and f.name not in nullable:
                raise ValueError(f"{f.name} must be set: {change}")


def _deactivate(
    config: DataFrame, changes: Sequence, match: tuple[str, ...], as_of_ts: datetime
) -> DataFrame:
    """The config with the active rows that any change matches switched off."""
    spark = config.sparkSession
    schema = T.StructType([T.StructField(c, T.StringType()) for c in match])
    keys = list(dict.fromkeys(tuple(getattr(change, c) for c in match) for change in changes))
    replaced = local_frame(spark, keys, schema).withColumn("_replaced", F.lit(True))
    hit = F.col("_replaced").isNotNull() & F.col("is_active")
    return (
        config.join(replaced, list(match), "left")
        .withColumn("updated_ts", F.when(hit, ntz_literal(as_of_ts)).otherwise(F.col("updated_ts")))
        .withColumn("is_active", F.when(hit, False).otherwise(F.col("is_active")))
        .select(*config.columns)
    )


def _appended(changes: Sequence, match: tuple[str, ...], as_of_ts: datetime) -> list[dict]:
    """New rows in order; of several changes to the same key only the last stays active."""
    last = {tuple(getattr(c, m) for m in match): i for i, c in enumerate(changes)}
    return [
        asdict(change)
        | {
            "is_active": last[tuple(getattr(change, m) for m in match)] == i,
            "created_ts": as_of_ts,
            "updated_ts": as_of_ts,
        }
        for i, change in enumerate(changes)
    ]


def update_thresholds(
    thresholds: DataFrame, changes: Sequence[ThresholdChange], as_of_ts: datetime
) -> DataFrame:
    """Apply changes in order. A batch is one plan, however many changes it holds."""
    _require(changes, {"lookback_days", "notes"})
    rows = [
        row | {"threshold_id": offset}
        for offset, row in enumerate(_appended(changes, _THRESHOLD_MATCH, as_of_ts), 1)
    ]
    names = schemas.THRESHOLDS.fieldNames()
    last_id = thresholds.agg(F.coalesce(F.max("threshold_id"), F.lit(0))).scalar()
    new = local_frame(
        thresholds.sparkSession, [tuple(r[n] for n in names) for r in rows], schemas.THRESHOLDS
    ).withColumn("threshold_id", F.col("threshold_id") + last_id)
    return _deactivate(thresholds, changes, _THRESHOLD_MATCH, as_of_ts).unionByName(new)


def update_threshold(
    thresholds: DataFrame,
    *,
    table_name: str,
    check_name: str,
    decision_id: str,
    severity: str,
    threshold_type: str,
    threshold_value: int,
    as_of_ts: datetime,
    lookback_days: int | None = None,
    notes: str | None = None,
) -> DataFrame:
    """Replace the active thresholds of a table's check, whatever their decision."""
    change = ThresholdChange(
        table_name=table_name,
        check_name=check_name,
        decision_id=decision_id,
        severity=severity,
        threshold_type=threshold_type,
        threshold_value=threshold_value,
        lookback_days=lookback_days,
        notes=notes,
    )
    return update_thresholds(thresholds, [change], as_of_ts)


def update_freshness_rules(
    rules: DataFrame, changes: Sequence[FreshnessRuleChange], as_of_ts: datetime
) -> DataFrame:
    """Apply changes in order, as one plan."""
    _require(changes, {"expected_lag_days", "sla_hour_et", "notes"})
    names = schemas.FRESHNESS_RULES.fieldNames()
    rows = [tuple(r[n] for n in names) for r in _appended(changes, _RULE_MATCH, as_of_ts)]
    new = local_frame(rules.sparkSession, rows, schemas.FRESHNESS_RULES)
    return _deactivate(rules, changes, _RULE_MATCH, as_of_ts).unionByName(new)


def update_freshness_rule(
    rules: DataFrame,
    *,
    target_table: str,
    decision_id: str,
    rule_name: str,
    date_column: str,
    severity: str,
    as_of_ts: datetime,
    expected_lag_days: int | None = None,
    sla_hour_et: int | None = None,
    notes: str | None = None,
) -> DataFrame:
    """Replace the active rules of a decision's rule name, whatever their table."""
    change = FreshnessRuleChange(
        target_table=target_table,
        decision_id=decision_id,
        rule_name=rule_name,
        date_column=date_column,
        severity=severity,
        expected_lag_days=expected_lag_days,
        sla_hour_et=sla_hour_et,
        notes=notes,
    )
    return update_freshness_rules(rules, [change], as_of_ts)
