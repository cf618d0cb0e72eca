"""Audits of the four profiled tables, and runs that read config and record the outcome."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tablegauge import schemas
from tablegauge.operators.checks import Suite
from tablegauge.operators.config import (
    FreshnessRuleChange,
    ThresholdChange,
    update_freshness_rules,
    update_thresholds,
)
from tablegauge.operators.freshness import freshness_audit, lag_freshness, run_freshness
from tablegauge.operators.grading import TABLE_KEYS, dq_audit
from tablegauge.operators.summary import dq_summary
from tablegauge.plans import suites
from tablegauge.sources import audit_store, config_store, seeds


@dataclass(frozen=True)
class ProfiledTables:
    spine: DataFrame
    xref: DataFrame
    behavior: DataFrame
    contact: DataFrame


# The tables a run covers, by their attribute in ProfiledTables.
TABLES = ("spine", "xref", "behavior", "contact")
# Their names in audits.
_NAMES = (
    seeds.PERSON_SPINE[0],
    seeds.PERSON_IDENTIFIER_XREF[0],
    seeds.CUSTOMER_BEHAVIOR_DAILY[0],
    seeds.PERSON_CONTACT_PROFILE[0],
)


def table_suite(
    tables: ProfiledTables, table: str, as_of_ts: datetime, *, fk_mode: str = "null_aware"
) -> Suite:
    """The suite of one table."""
    as_of = as_of_ts.date()
    if table == "spine":
        return suites.person_spine(as_of)
    build = {
        "xref": suites.person_identifier_xref,
        "behavior": suites.customer_behavior_daily,
        "contact": suites.person_contact_profile,
    }[table]
    return build(as_of, tables.spine, fk_mode=fk_mode)


def table_summary(
    tables: ProfiledTables, table: str, as_of_ts: datetime, *, fk_mode: str = "null_aware"
) -> DataFrame:
    """Summary of one table under its suite."""
    suite = table_suite(tables, table, as_of_ts, fk_mode=fk_mode)
    return dq_summary(getattr(tables, table), suite)


def dq_audit_all(
    tables: ProfiledTables,
    thresholds: DataFrame,
    as_of_ts: datetime,
    *,
    keys: Sequence[str] = TABLE_KEYS,
    fk_mode: str = "null_aware",
) -> DataFrame:
    """One audit run over all tables: summaries are stacked, then graded together."""
    summaries = [table_summary(tables, table, as_of_ts, fk_mode=fk_mode) for table in TABLES]
    return dq_audit(reduce(DataFrame.unionByName, summaries), thresholds, as_of_ts, keys=keys)


def table_freshness(tables: ProfiledTables, table: str, as_of_ts: datetime) -> DataFrame:
    """Freshness summary of one table: by run, or by lag for the daily table without runs."""
    if table == "behavior":
        return lag_freshness(tables.behavior, seeds.CUSTOMER_BEHAVIOR_DAILY[0], as_of_ts)
    name, _ = {
        "spine": seeds.PERSON_SPINE,
        "xref": seeds.PERSON_IDENTIFIER_XREF,
        "contact": seeds.PERSON_CONTACT_PROFILE,
    }[table]
    return run_freshness(getattr(tables, table), name, as_of_ts)


def table_freshness_audit(
    tables: ProfiledTables, table: str, rules: DataFrame, as_of_ts: datetime
) -> DataFrame:
    """Freshness audit of one table: exact by run, lag-tolerant for the daily table."""
    grade = "lag_tolerant" if table == "behavior" else "exact"
    return freshness_audit(table_freshness(tables, table, as_of_ts), rules, as_of_ts, grade=grade)


def freshness_audit_all(tables: ProfiledTables, rules: DataFrame, as_of_ts: datetime) -> DataFrame:
    audits = [table_freshness_audit(tables, table, rules, as_of_ts) for table in TABLES]
    return reduce(DataFrame.unionByName, audits)


@dataclass(frozen=True)
class Store:
    """Where config versions and audit rows live: paths that Spark can read, or catalog tables."""

    thresholds: str
    freshness_rules: str
    dq_audit: str
    freshness_audit: str

    @classmethod
    def under(cls, root: str) -> Store:
        names = ("dq_thresholds", "freshness_rules", "dq_audit", "freshness_audit")
        return cls(*[f"{root}/{name}" for name in names])

    @classmethod
    def in_catalog(cls, schema: str) -> Store:
        """Catalog tables of the usual names in `schema`, such as `catalog.db`."""
        names = ("dq_thresholds", "freshness_rules", "dq_audit", "freshness_audit")
        return cls(*[f"{schema}.{name}" for name in names])

    def install(self, spark: SparkSession, as_of_ts: datetime) -> None:
        """Write the initial thresholds and rules as version 1."""
        config_store.write_config(
            seeds.seed_thresholds(spark, as_of_ts),
            self.thresholds,
            schemas.THRESHOLDS,
            version=1,
            unique_id="threshold_id",
        )
        config_store.write_config(
            seeds.seed_freshness_rules(spark, as_of_ts),
            self.freshness_rules,
            schemas.FRESHNESS_RULES,
            version=1,
        )

    def change_thresholds(
        self, spark: SparkSession, changes: Sequence[ThresholdChange], as_of_ts: datetime
    ) -> None:
        """Write the latest thresholds with the changes applied as the next version."""
        version = config_store.latest_version(spark, self.thresholds, schemas.THRESHOLDS)
        current = config_store.read_config(spark, self.thresholds, schemas.THRESHOLDS, version)
        config_store.write_config(
            update_thresholds(current, changes, as_of_ts),
            self.thresholds,
            schemas.THRESHOLDS,
            version=version + 1,
            unique_id="threshold_id",
        )

    def change_freshness_rules(
        self, spark: SparkSession, changes: Sequence[FreshnessRuleChange], as_of_ts: datetime
    ) -> None:
        """Write the latest freshness rules with the changes applied as the next version."""
        root, schema = self.freshness_rules, schemas.FRESHNESS_RULES
        version = config_store.latest_version(spark, root, schema)
        current = config_store.read_config(spark, root, schema, version)
        changed = update_freshness_rules(current, changes, as_of_ts)
        config_store.write_config(changed, root, schema, version=version + 1)


def record_audit(
    df: DataFrame,
    suite: Suite,
    thresholds: DataFrame,
    target: str,
    as_of_ts: datetime,
    *,
    keys: Sequence[str] = TABLE_KEYS,
    rerun: str = "refuse",
) -> None:
    """Audit one table under any suite and record the outcome in a path or catalog table.

    A run that is recorded for this table already is refused (`RunRecorded`), or replaced if asked.
    """
    audit = dq_audit(dq_summary(df, suite), thresholds, as_of_ts, keys=keys)
    _record(audit, target, as_of_ts, (suite.table_name,), rerun)


def record_freshness(
    summary: DataFrame,
    rules: DataFrame,
    target: str,
    table_name: str,
    as_of_ts: datetime,
    *,
    grade: str = "exact",
    rerun: str = "refuse",
) -> None:
    """Audit the freshness summary of a table (of `run_freshness` or `lag_freshness`) and record the outcome.

    A table that is recorded at the same clock already is refused, or replaced if asked.
    """
    audit = freshness_audit(summary, rules, as_of_ts, grade=grade)
    _record_freshness(audit, target, as_of_ts, (table_name,), rerun)


def _record(
    audit: DataFrame, target: str, as_of_ts: datetime, names: tuple[str, ...], rerun: str
) -> None:
    run = audit_store.Run(as_of_ts, names, "pipeline_name", "business_date")
    audit_store.record_run(audit, target, schemas.DQ_AUDIT, run, rerun)


def _record_freshness(
    audit: DataFrame, target: str, as_of_ts: datetime, names: tuple[str, ...], rerun: str
) -> None:
    run = audit_store.Run(as_of_ts, names, "target_table", "checked_date")
    audit_store.record_run(audit, target, schemas.FRESHNESS_AUDIT, run, rerun)


def record_dq_audit(
    spark: SparkSession,
    tables: ProfiledTables,
    store: Store,
    as_of_ts: datetime,
    *,
    fk_mode: str = "null_aware",
    rerun: str = "refuse",
) -> None:
    """Audit all tables against the latest thresholds and record the outcome; once per run."""
    thresholds = config_store.read_config(spark, store.thresholds, schemas.THRESHOLDS)
    audit = dq_audit_all(tables, thresholds, as_of_ts, fk_mode=fk_mode)
    _record(audit, store.dq_audit, as_of_ts, _NAMES, rerun)


def record_freshness_audit(
    spark: SparkSession,
    tables: ProfiledTables,
    store: Store,
    as_of_ts: datetime,
    *,
    rerun: str = "refuse",
) -> None:
    """Audit the freshness of all tables against the latest rules and record it; once per run."""
    rules = config_store.read_config(spark, store.freshness_rules, schemas.FRESHNESS_RULES)
    audit = freshness_audit_all(tables, rules, as_of_ts)
    _record_freshness(audit, store.freshness_audit, as_of_ts, _NAMES, rerun)
