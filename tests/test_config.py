from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF_TS
from tablegauge import (
    ThresholdChange,
    active_config,
    rollup_thresholds,
    update_freshness_rule,
    update_threshold,
    update_thresholds,
)
from tablegauge.schemas import FRESHNESS_RULES, THRESHOLDS
from tablegauge.sources.config_store import VersionConflict, latest_version, read_config, write_config
from tablegauge.sources.seeds import seed_freshness_rules, seed_thresholds

LATER = datetime(2024, 2, 1, 6)
TIGHTER = ThresholdChange(
    table_name="PERSON_SPINE",
    check_name="THR_SSN_NULL",
    decision_id="LCV1-S1-D01",
    severity="WARN",
    threshold_type="ABSOLUTE_COUNT",
    threshold_value=150,
    notes="Tightened after 30 days",
)


@pytest.fixture
def thresholds(spark):
    return seed_thresholds(spark, AS_OF_TS)


def test_seeds(spark, thresholds):
    assert thresholds.schema == THRESHOLDS
    assert [r.threshold_id for r in thresholds.collect()] == list(range(1, 44))
    rules = seed_freshness_rules(spark, AS_OF_TS)
    assert rules.schema == FRESHNESS_RULES
    assert rules.count() == 8


def test_rollup(thresholds):
    assert [tuple(r) for r in rollup_thresholds(thresholds).collect()] == [
        ("CUSTOMER_BEHAVIOR_DAILY", 9, 7, 2, 9),
        ("PERSON_CONTACT_PROFILE", 13, 6, 7, 13),
        ("PERSON_IDENTIFIER_XREF", 7, 5, 2, 7),
        ("PERSON_SPINE", 14, 8, 6, 14),
    ]


def _versions(config, check):
    rows = config.filter(F.col("check_name") == check).orderBy("threshold_id").collect()
    return [(r.threshold_id, r.threshold_value, r.is_active, r.updated_ts) for r in rows]


def test_update_keeps_history(thresholds):
    changed = update_thresholds(thresholds, [TIGHTER], LATER)
    assert changed.columns == thresholds.columns
    spine = changed.filter("table_name = 'PERSON_SPINE'")
    assert _versions(spine, "THR_SSN_NULL") == [
        (10, 200, False, LATER),
        (44, 150, True, LATER),
    ]
    assert active_config(changed).count() == 43
    untouched = changed.filter("table_name != 'PERSON_SPINE'")
    assert untouched.filter(F.col("updated_ts") == AS_OF_TS).count() == 29


def test_update_matches_table_and_check_not_decision(thresholds):
    moved = replace(TIGHTER, decision_id="OTHER")
    spine = update_thresholds(thresholds, [moved], LATER).filter("table_name = 'PERSON_SPINE'")
    assert [v[2] for v in _versions(spine, "THR_SSN_NULL")] == [False, True]


def test_update_of_another_table_replaces_nothing(thresholds):
    changed = update_threshold(
        thresholds,
        table_name="CUSTOMER_BEHAVIOR_DAILY_SNAPSHOT",
        check_name="THR_RECORD_DROP_PCT",
        decision_id="LCV1-S1-D03",
        severity="WARN",
        threshold_type="PERCENTAGE",
        threshold_value=5,
        lookback_days=1,
        notes="Reduced from 10% to 5%",
        as_of_ts=LATER,
    )
    active = active_config(changed).filter(
        "decision_id = 'LCV1-S1-D03' AND check_name = 'THR_RECORD_DROP_PCT'"
    )
    assert sorted(r.threshold_value for r in active.collect()) == [1, 5]


def test_batch_equals_changes_one_by_one(thresholds):
    changes = [TIGHTER, replace(TIGHTER, check_name="LOG_DOB"), replace(TIGHTER, threshold_value=9)]
    one_by_one = thresholds
    for change in changes:
        one_by_one = update_thresholds(one_by_one, [change], LATER)
    batch = update_thresholds(thresholds, changes, LATER)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, one_by_one.collect()))


def test_update_of_an_empty_table(spark, thresholds):
    empty = spark.createDataFrame([], THRESHOLDS)
    assert [r.threshold_id for r in update_thresholds(empty, [TIGHTER], LATER).collect()] == [1]


def test_required_arguments(spark, thresholds):
    with pytest.raises(ValueError, match="severity"):
        update_thresholds(thresholds, [replace(TIGHTER, severity=None)], LATER)
    with pytest.raises(TypeError):
        update_freshness_rule(
            seed_freshness_rules(spark, AS_OF_TS),
            target_table="PERSON_SPINE",
            decision_id="LCV1-S1-D01",
            date_column="RECORD_UPDATED_TS",
            severity="FAIL",
            as_of_ts=LATER,
        )


def test_rule_update_matches_decision_and_rule_not_table(spark):
    rules = update_freshness_rule(
        seed_freshness_rules(spark, AS_OF_TS),
        target_table="RENAMED",
        decision_id="LCV1-S1-D03",
        rule_name="LAG_DAY",
        date_column="BUSINESS_DATE",
        expected_lag_days=2,
        sla_hour_et=6,
        severity="WARN",
        notes="Relaxed threshold after review",
        as_of_ts=LATER,
    )
    rows = rules.filter("rule_name = 'LAG_DAY'").orderBy("is_active").collect()
    assert [(r.target_table, r.expected_lag_days, r.severity, r.is_active) for r in rows] == [
        ("CUSTOMER_BEHAVIOR_DAILY", 1, "FAIL", False),
        ("RENAMED", 2, "WARN", True),
    ]
    assert rules.count() == 9


def test_versions_on_files(spark, thresholds, tmp_path):
    root = str(tmp_path / "thresholds")
    write_config(thresholds, root, THRESHOLDS, 1, unique_id="threshold_id")
    current = read_config(spark, root, THRESHOLDS)
    changed = update_thresholds(current, [TIGHTER], LATER)
    write_config(changed, root, THRESHOLDS, 2, unique_id="threshold_id")
    assert latest_version(spark, root, THRESHOLDS) == 2
    assert read_config(spark, root, THRESHOLDS).count() == 44
    assert read_config(spark, root, THRESHOLDS, version=1).count() == 43
    assert read_config(spark, root, THRESHOLDS).columns == THRESHOLDS.fieldNames()
    with pytest.raises(VersionConflict, match="there already"):
        write_config(changed, root, THRESHOLDS, 2)


def test_writer_rejects_bad_rows(spark, thresholds, tmp_path):
    nulled = thresholds.withColumn("severity", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="severity must not be NULL"):
        write_config(nulled, str(tmp_path / "null"), THRESHOLDS, 1)
    twice = thresholds.union(thresholds)
    with pytest.raises(ValueError, match="occurs 2 times"):
        write_config(twice, str(tmp_path / "twice"), THRESHOLDS, 1, unique_id="threshold_id")
