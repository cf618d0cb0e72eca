"""Registered queries: each takes a session and a directory of star tables.

The profiled tables, and the config tables of the config queries, are derived from the star
tables, so the work of every query grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.functions import exact_length, like, min_digits
from tablegauge.operators.checks import (
    DistinctCount,
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
from tablegauge.operators.freshness import freshness_audit, latest_runs
from tablegauge.operators.grading import DECISION_KEYS, dq_audit
from tablegauge.operators.orphans import orphan_rows
from tablegauge.operators.rows import period_drop_summary, surplus_rows, violating_rows
from tablegauge.operators.summary import dq_summary
from tablegauge.plans import audits, suites
from tablegauge.sources.sample_tables import AS_OF_TS, SampleTables, star_table
from tablegauge.sources.seeds import seed_freshness_rules, seed_thresholds

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = AS_OF_TS.date()


# --- the four profiled tables ------------------------------------------------------------


def _summary(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return audits.table_summary(SampleTables(spark, sf_dir), table, AS_OF_TS)

    return query


def _audit(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        summary = _summary(table)(spark, sf_dir)
        return dq_audit(summary, seed_thresholds(spark, AS_OF_TS), AS_OF_TS)

    return query


def dq_audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    thresholds = seed_thresholds(spark, AS_OF_TS)
    return audits.dq_audit_all(SampleTables(spark, sf_dir), thresholds, AS_OF_TS)


def dq_audit_all_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    thresholds = seed_thresholds(spark, AS_OF_TS)
    return audits.dq_audit_all(
        SampleTables(spark, sf_dir), thresholds, AS_OF_TS, fk_mode="anti"
    )


def dq_summary_spine_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = SampleTables(spark, sf_dir).spine
    return dq_summary(spine, suites.person_spine(AS_OF), emit_metadata=True)


def dq_summary_contact_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    suite = suites.person_contact_profile(AS_OF, tables.spine)
    return dq_summary(tables.contact, suite, emit_metadata=True)


def xref_unscoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    suite = suites.person_identifier_xref(AS_OF, tables.spine, unscoped=True)
    return dq_summary(tables.xref, suite)


# --- foreign keys ------------------------------------------------------------------------


def _fk_violations(mode: str, clean_reference: bool = False, prefilter: bool = False) -> Query:
    """The foreign-key check alone, on the three tables that refer to the spine."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = SampleTables(spark, sf_dir)
        spine = tables.spine.dropna(subset=["person_id"]) if clean_reference else tables.spine

        def check():
            name = "PERSON_ID_EXISTS"
            return foreign_key(
                name, "person_id", spine, "person_id", mode=mode, prefilter=prefilter
            )

        summaries = [
            dq_summary(df, Suite(name, (check(),)))
            for name, df in [
                ("PERSON_IDENTIFIER_XREF", tables.xref),
                ("CUSTOMER_BEHAVIOR_DAILY", tables.behavior),
                ("PERSON_CONTACT_PROFILE", tables.contact),
            ]
        ]
        return reduce(DataFrame.unionByName, summaries)

    return query


def fk_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    return orphan_rows(tables.xref, "person_id", tables.spine, "person_id")


# --- the rows behind counts ----------------------------------------------------------------


def _violating_rows(table: str) -> Query:
    """The rows of a profiled table that break row checks, with the names of these checks."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = SampleTables(spark, sf_dir)
        suite = audits.table_suite(tables, table, AS_OF_TS)
        rows = violating_rows(getattr(tables, table), suite)
        return rows.withColumn("broken_checks", F.array_join("broken_checks", ","))

    return query


def surplus_rows_xref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open identifier links beyond the first of their key."""
    keys = ("src_system_cd", "source_identifier_type", "source_identifier_value", "person_id")
    still_open = F.col("effective_end_date").isNull()
    return surplus_rows(SampleTables(spark, sf_dir).xref, *keys, scope=still_open)


def period_drop_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return period_drop_summary(
        events, "THR_EVENT_DROP_PCT", "day", AS_OF, table_name="EVENTS", by="event_type"
    )


# --- freshness ---------------------------------------------------------------------------


def latest_run_per_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = SampleTables(spark, sf_dir)
    runs = [latest_runs(df) for df in (tables.spine, tables.xref, tables.contact)]
    return reduce(DataFrame.unionByName, runs)


def _freshness_summary(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return audits.table_freshness(SampleTables(spark, sf_dir), table, AS_OF_TS)

    return query


def _freshness_audit(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = seed_freshness_rules(spark, AS_OF_TS)
        return audits.table_freshness_audit(SampleTables(spark, sf_dir), table, rules, AS_OF_TS)

    return query


def freshness_audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = seed_freshness_rules(spark, AS_OF_TS)
    return audits.freshness_audit_all(SampleTables(spark, sf_dir), rules, AS_OF_TS)


# --- config changes, seen through the next run --------------------------------------------


def threshold_update_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine audit after its SSN threshold is tightened."""
    thresholds = update_threshold(
        seed_thresholds(spark, AS_OF_TS),
        table_name="PERSON_SPINE",
        check_name="THR_SSN_NULL",
        decision_id="LCV1-S1-D01",
        severity="WARN",
        threshold_type="ABSOLUTE_COUNT",
        threshold_value=150,
        notes="Tightened after 30 days",
        as_of_ts=AS_OF_TS,
    )
    return dq_audit(_summary("spine")(spark, sf_dir), thresholds, AS_OF_TS)


def threshold_update_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of all identifier links after the end-date check is raised to FAIL."""
    thresholds = update_threshold(
        seed_thresholds(spark, AS_OF_TS),
        table_name="PERSON_IDENTIFIER_XREF",
        check_name="LOG_EFFECTIVE_START_LS_END_TS",
        decision_id="LCV1-S1-D02",
        severity="FAIL",
        threshold_type="LOGICAL_CONSISTENCY",
        threshold_value=0,
        notes="Elevated to FAIL - critical rule",
        as_of_ts=AS_OF_TS,
    )
    return dq_audit(xref_unscoped(spark, sf_dir), thresholds, AS_OF_TS)


def threshold_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change that names another table replaces nothing.

    Joined without the table name, the check is then graded by both thresholds.
    """
    thresholds = update_threshold(
        seed_thresholds(spark, AS_OF_TS),
        table_name="CUSTOMER_BEHAVIOR_DAILY_SNAPSHOT",
        check_name="THR_RECORD_DROP_PCT",
        decision_id="LCV1-S1-D03",
        severity="WARN",
        threshold_type="PERCENTAGE",
        threshold_value=5,
        lookback_days=1,
        notes="Reduced from 10% to 5%",
        as_of_ts=AS_OF_TS,
    )
    return dq_audit(
        _summary("behavior")(spark, sf_dir), thresholds, AS_OF_TS, keys=DECISION_KEYS
    )


def freshness_rule_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness audit of the daily table after its lag rule is relaxed."""
    rules = update_freshness_rule(
        seed_freshness_rules(spark, AS_OF_TS),
        target_table="CUSTOMER_BEHAVIOR_DAILY",
        decision_id="LCV1-S1-D03",
        rule_name="LAG_DAY",
        date_column="BUSINESS_DATE",
        expected_lag_days=2,
        sla_hour_et=6,
        severity="WARN",
        notes="Relaxed threshold after review",
        as_of_ts=AS_OF_TS,
    )
    summary = _freshness_summary("behavior")(spark, sf_dir)
    return freshness_audit(summary, rules, AS_OF_TS, grade="lag_tolerant")


# --- config tables that grow with the data -------------------------------------------------


def part_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A threshold per part: brands as tables, part names as checks, part types as decisions."""
    return star_table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS threshold_id",
        "p_brand AS table_name",
        "p_name AS check_name",
        "p_type AS decision_id",
        """CASE WHEN p_size <= 20 THEN 'FAIL' WHEN p_size <= 40 THEN 'WARN' ELSE 'INFO' END
            AS severity""",
        "'ABSOLUTE_COUNT' AS threshold_type",
        "CAST(p_size AS BIGINT) AS threshold_value",
        "CAST(NULL AS BIGINT) AS lookback_days",
        "p_retailprice < 1500 AS is_active",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS created_ts",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS updated_ts",
        "CAST(NULL AS STRING) AS notes",
    )


def supplier_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A freshness rule per supplier: nations as tables, suppliers as decisions."""
    return star_table(spark, sf_dir, "supplier").selectExpr(
        "concat('NATION_', CAST(s_nationkey AS STRING)) AS target_table",
        "s_name AS decision_id",
        "CASE WHEN s_acctbal < 5000 THEN 'LAG_DAY' ELSE 'TABLE_FRESHNESS' END AS rule_name",
        "'RECORD_UPDATED_TS' AS date_column",
        "s_nationkey AS expected_lag_days",
        "6 AS sla_hour_et",
        "'FAIL' AS severity",
        "s_acctbal >= 0 AS is_active",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS created_ts",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS updated_ts",
        "CAST(NULL AS STRING) AS notes",
    )


def thresholds_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_thresholds(part_thresholds(spark, sf_dir))


def active_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_config(part_thresholds(spark, sf_dir))


def active_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_config(supplier_rules(spark, sf_dir))


def threshold_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three changes in one batch; the third replaces the first."""
    change = {"severity": "WARN", "threshold_type": "ABSOLUTE_COUNT"}
    ring = {"table_name": "Brand#2", "check_name": "small ring", "decision_id": "ECONOMY"}
    bolt = {"table_name": "Brand#4", "check_name": "blue bolt", "decision_id": "SMALL"}
    changes = [
        ThresholdChange(**ring, **change, threshold_value=7, notes="first"),
        ThresholdChange(**bolt, **change, threshold_value=8, lookback_days=1, notes="second"),
        ThresholdChange(**ring, **change, threshold_value=9, notes="third"),
    ]
    return update_thresholds(part_thresholds(spark, sf_dir), changes, AS_OF_TS)


def freshness_rule_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = FreshnessRuleChange(
        target_table="NATION_15",
        decision_id="Supplier#000000000",
        rule_name="TABLE_FRESHNESS",
        date_column="RECORD_UPDATED_TS",
        expected_lag_days=3,
        severity="WARN",
        notes="relaxed",
    )
    return update_freshness_rules(supplier_rules(spark, sf_dir), [change], AS_OF_TS)


def dq_audit_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision per part: summary and thresholds both grow with the data."""
    lines = star_table(spark, sf_dir, "lineitem").withColumn(
        "decision_id", F.col("l_partkey").cast("string")
    )
    suite = Suite(
        "LINEITEM",
        (
            unique("UNQ_LINE", DistinctCount(("l_orderkey", "l_linenumber"))),
            ordered("LOG_DISCOUNT_LE_TAX", "l_discount", "l_tax"),
            deactivated_pct("THR_RETURNED_PCT", F.col("l_returnflag") == "R", RowCount()),
        ),
    )
    names = [check.name for check in suite.checks]
    thresholds = star_table(spark, sf_dir, "part").select(
        F.lit("LINEITEM").alias("table_name"),
        F.explode(F.array(*[F.lit(name) for name in names])).alias("check_name"),
        F.col("p_partkey").cast("string").alias("decision_id"),
        F.when(F.col("p_size") <= 20, "FAIL").otherwise("WARN").alias("severity"),
        F.col("p_size").cast("bigint").alias("threshold_value"),
        (F.col("p_retailprice") < 1500).alias("is_active"),
    )
    return dq_audit(dq_summary(lines, suite), thresholds, AS_OF_TS)


# --- each check kind on a star table --------------------------------------------------------


def _kind(
    table_name: str, by: str, build: Callable[[SparkSession, str], tuple[DataFrame, tuple]]
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df, checks = build(spark, sf_dir)
        return dq_summary(df, Suite(table_name, checks, by=by))

    return query


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = star_table(spark, sf_dir, "documents")
    return documents.join(star_table(spark, sf_dir, "labels"), "doc_id", "left")


def _not_null(spark: SparkSession, sf_dir: str):
    return _labelled_documents(spark, sf_dir), (
        not_null("REQ_QUALITY", "quality"),
        not_null("REQ_LABELS_LONG", "quality", "toxic", scope=F.col("n_chars") > 1000),
    )


def _unique(spark: SparkSession, sf_dir: str):
    return star_table(spark, sf_dir, "lineitem"), (
        unique("UNQ_LINE", DistinctCount(("l_orderkey", "l_linenumber"))),
        unique("UNQ_OPEN_PART", DistinctCount(("l_partkey",), F.col("l_linestatus") == "O")),
    )


def _shifted_parts(spark: SparkSession, sf_dir: str, *, null: bool = False) -> DataFrame:
    """All of part, its keys shifted so that some lines are orphans; one key in seven NULL if asked."""
    key = F.col("p_partkey") + 100
    if null:
        key = F.when(F.col("p_partkey") % 7 != 0, key)
    return star_table(spark, sf_dir, "part").select(key.alias("known_partkey"))


def _foreign_key(spark: SparkSession, sf_dir: str, *, null: bool = False):
    parts = _shifted_parts(spark, sf_dir, null=null)
    return star_table(spark, sf_dir, "lineitem"), (
        foreign_key("PART_EXISTS", "l_partkey", parts, "known_partkey"),
        foreign_key(
            "PART_EXISTS_NULL_AWARE", "l_partkey", parts, "known_partkey", mode="null_aware"
        ),
    )


def _foreign_key_null(spark: SparkSession, sf_dir: str):
    return _foreign_key(spark, sf_dir, null=True)


def _ordered(spark: SparkSession, sf_dir: str):
    return star_table(spark, sf_dir, "lineitem"), (
        ordered("LOG_DISCOUNT_LE_TAX", "l_discount", "l_tax"),
    )


def _min_age(spark: SparkSession, sf_dir: str):
    return star_table(spark, sf_dir, "orders"), (
        min_age("LOG_ORDER_AGE", "o_orderdate", 27, AS_OF),
    )


def _required_when(spark: SparkSession, sf_dir: str):
    return _labelled_documents(spark, sf_dir), (
        required_when("DEP_LONG_REQUIRES_QUALITY", F.col("n_chars") > 2000, "quality"),
    )


def _matches(spark: SparkSession, sf_dir: str):
    return star_table(spark, sf_dir, "documents"), (
        matches("VAL_HAS_AT", "text", like("%@%")),
        matches("VAL_TEN_DIGITS", "text", min_digits(10), guard=F.col("n_chars") > 500),
        matches("VAL_SOURCE_LENGTH", "source", exact_length(4)),
    )


def _count_where(spark: SparkSession, sf_dir: str):
    return star_table(spark, sf_dir, "orders"), (
        count_where("THR_LARGE", F.col("o_totalprice") > 300000),
        count_where(
            "THR_LARGE_FILLED", F.col("o_totalprice") > 300000, scope=F.col("o_orderstatus") == "F"
        ),
        # Any text names a check.
        count_where("orders.o_custkey `even`", F.col("o_custkey") % 2 == 0),
        count_where("thr_large", F.col("o_totalprice") > 200000),
        count_where("decision_id", F.col("o_orderkey") % 3 == 0),
    )


def _deactivated_pct(spark: SparkSession, sf_dir: str):
    overdrawn = F.col("c_acctbal") < 0
    return star_table(spark, sf_dir, "customer"), (
        deactivated_pct("THR_OVERDRAWN_PCT", overdrawn, RowCount()),
        deactivated_pct("THR_OVERDRAWN_PER_NATION", overdrawn, DistinctCount(("c_nationkey",))),
    )


def _period_drop_pct(spark: SparkSession, sf_dir: str):
    return star_table(spark, sf_dir, "events"), (
        period_drop_pct("THR_EVENT_DROP_PCT", F.to_date("ts"), AS_OF),
    )


def _coverage_gap_pct(spark: SparkSession, sf_dir: str):
    high_value = F.when(F.col("value") > 10, F.col("value"))
    users = DistinctCount(("user_id",))
    return star_table(spark, sf_dir, "events"), (
        coverage_gap_pct("THR_VALUE_GAP", high_value, "ts", date(2024, 1, 30), users),
    )


QUERIES: dict[str, Query] = {
    "dq_summary_person_spine": _summary("spine"),
    "dq_summary_xref": _summary("xref"),
    "dq_summary_behavior": _summary("behavior"),
    "dq_summary_contact": _summary("contact"),
    "dq_summary_spine_metadata": dq_summary_spine_metadata,
    "dq_summary_contact_metadata": dq_summary_contact_metadata,
    "xref_unscoped": xref_unscoped,
    "dq_audit_person_spine": _audit("spine"),
    "dq_audit_xref": _audit("xref"),
    "dq_audit_behavior": _audit("behavior"),
    "dq_audit_contact": _audit("contact"),
    "dq_audit_all": dq_audit_all,
    "dq_audit_all_anti": dq_audit_all_anti,
    "dq_audit_by_part": dq_audit_by_part,
    "fk_violations_null_aware": _fk_violations("null_aware"),
    "fk_violations_null_aware_clean": _fk_violations("null_aware", clean_reference=True),
    "fk_violations_anti": _fk_violations("anti"),
    "fk_violations_prefiltered": _fk_violations("anti", prefilter=True),
    "fk_orphan_rows": fk_orphan_rows,
    "violating_rows_spine": _violating_rows("spine"),
    "violating_rows_xref": _violating_rows("xref"),
    "violating_rows_behavior": _violating_rows("behavior"),
    "violating_rows_contact": _violating_rows("contact"),
    "surplus_rows_xref": surplus_rows_xref,
    "period_drop_two_days": period_drop_two_days,
    "latest_run_per_decision": latest_run_per_decision,
    "freshness_summary_spine": _freshness_summary("spine"),
    "freshness_summary_xref": _freshness_summary("xref"),
    "freshness_summary_behavior": _freshness_summary("behavior"),
    "freshness_summary_contact": _freshness_summary("contact"),
    "freshness_audit_spine": _freshness_audit("spine"),
    "freshness_audit_xref": _freshness_audit("xref"),
    "freshness_audit_behavior": _freshness_audit("behavior"),
    "freshness_audit_contact": _freshness_audit("contact"),
    "freshness_audit_all": freshness_audit_all,
    "threshold_update_value": threshold_update_value,
    "threshold_update_severity": threshold_update_severity,
    "threshold_fanout": threshold_fanout,
    "freshness_rule_update": freshness_rule_update,
    "thresholds_rollup": thresholds_rollup,
    "active_thresholds": active_thresholds,
    "active_rules": active_rules,
    "threshold_history": threshold_history,
    "freshness_rule_history": freshness_rule_history,
    "check_not_null": _kind("DOCUMENTS", "lang", _not_null),
    "check_unique": _kind("LINEITEM", "l_returnflag", _unique),
    "check_foreign_key": _kind("LINEITEM", "l_returnflag", _foreign_key),
    "check_foreign_key_null": _kind("LINEITEM", "l_returnflag", _foreign_key_null),
    "check_foreign_key_by_order": _kind("LINEITEM", "l_orderkey", _foreign_key),
    "check_ordered": _kind("LINEITEM", "l_linestatus", _ordered),
    "check_min_age": _kind("ORDERS", "o_orderpriority", _min_age),
    "check_required_when": _kind("DOCUMENTS", "source", _required_when),
    "check_matches": _kind("DOCUMENTS", "lang", _matches),
    "check_count_where": _kind("ORDERS", "o_orderpriority", _count_where),
    "check_deactivated_pct": _kind("CUSTOMER", "c_mktsegment", _deactivated_pct),
    "check_period_drop_pct": _kind("EVENTS", "event_type", _period_drop_pct),
    "check_coverage_gap_pct": _kind("EVENTS", "event_type", _coverage_gap_pct),
}
