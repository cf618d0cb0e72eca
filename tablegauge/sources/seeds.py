"""The initial thresholds and freshness rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tablegauge import schemas
from tablegauge.sources.local import local_frame

# The decision that owns each profiled table.
PERSON_SPINE = ("PERSON_SPINE", "LCV1-S1-D01")
PERSON_IDENTIFIER_XREF = ("PERSON_IDENTIFIER_XREF", "LCV1-S1-D02")
CUSTOMER_BEHAVIOR_DAILY = ("CUSTOMER_BEHAVIOR_DAILY", "LCV1-S1-D03")
PERSON_CONTACT_PROFILE = ("PERSON_CONTACT_PROFILE", "LCV1-S1-D12")

# Check, severity, threshold type, threshold, lookback days, notes.
THRESHOLD_SEEDS = {
    PERSON_SPINE: [
        ("REQ_PERSON_ID", "FAIL", "NULL_COUNT", 0, None, "Required field - primary key"),
        ("UNQ_PERSON_ID", "FAIL", "DUPLICATE_COUNT", 0, None, "Primary key uniqueness constraint"),
        ("REQ_IDENTITY_TYPE_USED", "FAIL", "NULL_COUNT", 0, None, "Required field - identity classification"),
        ("REQ_SRC_SYSTEM_CD", "FAIL", "NULL_COUNT", 0, None, "Required field - source system identifier"),
        ("REQ_SRC_CUSTOMER_ID", "FAIL", "NULL_COUNT", 0, None, "Required field - source customer reference"),
        ("REQ_CREATE_TS", "FAIL", "NULL_COUNT", 0, None, "Required field - update timestamp"),
        ("LOG_CREATE_LS_UPDATE_TS", "FAIL", "LOGICAL_CONSISTENCY", 0, None, "CREATE_TS must be <= UPDATE_TS"),
        ("LOG_FIRST_LS_LAST_SEEN", "WARN", "LOGICAL_CONSISTENCY", 50, None, "FIRST_SEEN_DATE must be <= LAST_SEEN_DATE"),
        ("LOG_DOB", "WARN", "LOGICAL_CONSISTENCY", 200, None, "age must be >=18"),
        ("THR_SSN_NULL", "WARN", "ABSOLUTE_COUNT", 200, None, "Alert if SSN null count exceeds threshold - may indicate upstream issue"),
        ("THR_DOB_NULL", "WARN", "ABSOLUTE_COUNT", 200, None, "Alert if DOB null count exceeds threshold - should be rare"),
        ("THR_IS_ACTIVE_FALSE", "WARN", "ABSOLUTE_COUNT", 500, None, "Alert if inactive record count exceeds threshold - may indicate data quality issue"),
        ("THR_RECORD_DROP_PCT", "WARN", "PERCENTAGE", 10, None, "Alert if record count drops >10% vs prior period - indicates upstream issue"),
        ("REQ_DECISION_VERSION", "FAIL", "NULL_COUNT", 0, None, "Required field - decision version identifier"),
    ],
    PERSON_IDENTIFIER_XREF: [
        ("REQ_PK", "FAIL", "NULL_COUNT", 0, None, "Required field - primary key"),
        ("UNQ_PK", "FAIL", "DUPLICATE_COUNT", 0, None, "Primary key uniqueness constraint"),
        ("REQ_PERSON_ID_EXISTS", "FAIL", "REFERENTIAL_INTEGRITY", 0, None, "FK to PERSON_SPINE.PERSON_ID"),
        ("REQ_CREATE_TS", "FAIL", "NULL_COUNT", 0, None, "Required field - update timestamp"),
        ("LOG_CREATE_LS_UPDATE_TS", "FAIL", "LOGICAL_CONSISTENCY", 0, None, "RECORD_CREATED_TS must be <= RECORD_UPDATED_TS"),
        ("LOG_EFFECTIVE_START_LS_END_TS", "WARN", "LOGICAL_CONSISTENCY", 200, None, "EFFECTIVE_START_DATE must be <= EFFECTIVE_END_DATE"),
        ("THR_RECORD_DROP_PCT", "WARN", "PERCENTAGE", 10, None, "Alert if record count drops >10% vs prior period - indicates upstream issue"),
    ],
    CUSTOMER_BEHAVIOR_DAILY: [
        ("REQ_PK", "FAIL", "NULL_COUNT", 0, None, "Required field - primary key"),
        ("UNQ_PK", "FAIL", "DUPLICATE_COUNT", 0, None, "Primary key uniqueness constraint"),
        ("REQ_PERSON_ID_EXISTS", "FAIL", "REFERENTIAL_INTEGRITY", 0, None, "FK to PERSON_SPINE.PERSON_ID"),
        ("REQ_SRC_SYSTEM_CD", "FAIL", "NULL_COUNT", 0, None, "Required field - source system identifier"),
        ("REQ_IS_ACTIVE_FLAG", "FAIL", "NULL_COUNT", 0, None, "Required field - status indicator"),
        ("DEP_INACTIVE_REQUIRES_DAYS", "FAIL", "CROSS_FIELD_CONSISTENCY", 0, None, "If IS_ACTIVE_FLAG=false, DAYS_SINCE_INACTIVE must not be null"),
        ("LOG_CREATE_LS_UPDATE_TS", "FAIL", "LOGICAL_CONSISTENCY", 0, None, "RECORD_CREATED_TS must be <= RECORD_UPDATED_TS"),
        ("THR_SSN_NULL", "WARN", "ABSOLUTE_COUNT", 200, None, "Alert if SSN null count exceeds threshold - may indicate upstream issue"),
        ("THR_RECORD_DROP_PCT", "WARN", "PERCENTAGE", 1, 1, "Alert if record count drops >10% vs prior period - indicates upstream issue"),
    ],
    PERSON_CONTACT_PROFILE: [
        ("REQ_PK", "FAIL", "NULL_COUNT", 0, None, "Required field - primary key"),
        ("UNQ_PK", "FAIL", "DUPLICATE_COUNT", 0, None, "Primary key uniqueness constraint"),
        ("REQ_PERSON_ID_EXISTS", "FAIL", "REFERENTIAL_INTEGRITY", 0, None, "FK to PERSON_SPINE.PERSON_ID"),
        ("REQ_RECORD_CREATED_TS", "FAIL", "NULL_COUNT", 0, None, "Create timestamp required"),
        ("VAL_EMAIL_FORMAT", "WARN", "PATTERN_MISMATCH", 100, None, "Valid email format"),
        ("VAL_PHONE_FORMAT", "WARN", "PATTERN_MISMATCH", 100, None, "Valid phone format"),
        ("VAL_STATE_CODE", "FAIL", "PATTERN_MISMATCH", 0, None, "Valid state code"),
        ("LOG_RECORD_CREATED_LS_UPDATED", "FAIL", "LOGICAL_CONSISTENCY", 0, None, "RECORD_CREATED_TS must be <= RECORD_UPDATED_TS"),
        ("THR_EMAIL_COVERAGE_DROP", "WARN", "PERCENTAGE", 5, 1, "Alert if Email coverage >5% drop"),
        ("THR_PHONE_COVERAGE_DROP", "WARN", "PERCENTAGE", 5, 1, "Alert if Phone coverage >5% drop"),
        ("THR_ADDRESS_COVERAGE_DROP", "WARN", "PERCENTAGE", 5, 1, "Alert if Address coverage >5% drop"),
        ("THR_RECORD_DROP_PCT", "WARN", "PERCENTAGE", 5, 1, "Alert if record count >5% drop"),
        ("THR_NAME_NULL", "WARN", "ABSOLUTE_COUNT", 100, 1, "Name nulls >100"),
    ],
}

# Owner, rule, date column, expected lag days, SLA hour (ET), severity, notes.
FRESHNESS_RULE_SEEDS = [
    (CUSTOMER_BEHAVIOR_DAILY, "LAG_DAY", "BUSINESS_DATE", 1, 6, "FAIL", "Critical table - must be updated daily by 6 AM ET"),
    (CUSTOMER_BEHAVIOR_DAILY, "TABLE_FRESHNESS", "RECORD_UPDATED_TS", None, 6, "FAIL", "FAIL level due to downstream impact"),
    (PERSON_CONTACT_PROFILE, "RUN_ID_FRESHNESS", "RUN_ID", None, 6, "FAIL", "Critical table - must be updated daily by 6 AM ET"),
    (PERSON_CONTACT_PROFILE, "TABLE_FRESHNESS", "RECORD_UPDATED_TS", None, 6, "WARN", "FAIL level due to downstream impact"),
    (PERSON_IDENTIFIER_XREF, "RUN_ID_FRESHNESS", "RUN_ID", None, 6, "FAIL", "Critical table - must be updated daily by 6 AM ET"),
    (PERSON_IDENTIFIER_XREF, "TABLE_FRESHNESS", "RECORD_UPDATED_TS", None, 6, "WARN", "WARN -refreshed without any updates"),
    (PERSON_SPINE, "RUN_ID_FRESHNESS", "RUN_ID", None, 6, "FAIL", "Critical table - must be updated daily by 6 AM ET"),
    (PERSON_SPINE, "TABLE_FRESHNESS", "RECORD_UPDATED_TS", None, 6, "WARN", "WARN -refreshed without any updates"),
]


def seed_thresholds(spark: SparkSession, created_ts: datetime) -> DataFrame:
    """The 43 initial thresholds, numbered from 1 in seed order."""
    seeds = [
        (table, check, decision, severity, kind, value, lookback, True, created_ts, created_ts, notes)
        for (table, decision), checks in THRESHOLD_SEEDS.items()
        for check, severity, kind, value, lookback, notes in checks
    ]
    rows = [(number, *seed) for number, seed in enumerate(seeds, 1)]
    return local_frame(spark, rows, schemas.THRESHOLDS)


def seed_freshness_rules(spark: SparkSession, created_ts: datetime) -> DataFrame:
    """The 8 initial freshness rules."""
    rows = [
        (table, decision, rule, column, lag, sla, severity, True, created_ts, created_ts, notes)
        for (table, decision), rule, column, lag, sla, severity, notes in FRESHNESS_RULE_SEEDS
    ]
    return local_frame(spark, rows, schemas.FRESHNESS_RULES)
