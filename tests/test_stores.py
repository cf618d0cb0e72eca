from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF_TS, plan_of
from tablegauge import FreshnessRuleChange, Suite, ThresholdChange, count_where, run_freshness
from tablegauge.plans.audits import (
    Store,
    dq_audit_all,
    record_audit,
    record_dq_audit,
    record_freshness,
    record_freshness_audit,
)
from tablegauge.schemas import DQ_AUDIT, FRESHNESS_AUDIT, FRESHNESS_RULES, THRESHOLDS
from tablegauge.sources.audit_store import (
    Run,
    RunRecorded,
    append_audit_table,
    create_audit_table,
    read_audit,
    record_run,
    recorded,
)
from tablegauge.sources.config_store import (
    VersionConflict,
    latest_version,
    read_config,
    write_config,
)
from tablegauge.sources.sample_tables import SampleTables
from tablegauge.sources.seeds import seed_thresholds
from tablegauge.sources.tables import load_table

SF_DIR = "/root/testdata/sf0.001"


def test_runs_append_to_the_audit(spark, tmp_path):
    tables, store = SampleTables(spark, SF_DIR), Store.under(str(tmp_path))
    store.install(spark, AS_OF_TS)
    for day in range(2):
        record_dq_audit(spark, tables, store, AS_OF_TS + timedelta(days=day))
        record_freshness_audit(spark, tables, store, AS_OF_TS + timedelta(days=day))
    audit = read_audit(spark, store.dq_audit, DQ_AUDIT)
    assert audit.schema == DQ_AUDIT
    per_day = audit.groupBy("business_date").count().collect()
    assert {(r.business_date.day, r["count"]) for r in per_day} == {(31, 43), (1, 43)}
    freshness = read_audit(spark, store.freshness_audit, FRESHNESS_AUDIT)
    assert freshness.count() == 16
    first = freshness.filter("checked_ts < '2024-02-01'")
    assert first.filter("status = 'PASSED'").count() == 7


def test_a_changed_threshold_grades_the_next_run(spark, tmp_path):
    tables, store = SampleTables(spark, SF_DIR), Store.under(str(tmp_path))
    store.install(spark, AS_OF_TS)
    record_dq_audit(spark, tables, store, AS_OF_TS)
    later = AS_OF_TS + timedelta(hours=1)
    change = ThresholdChange(
        table_name="PERSON_SPINE",
        check_name="THR_SSN_NULL",
        decision_id="LCV1-S1-D01",
        severity="FAIL",
        threshold_type="ABSOLUTE_COUNT",
        threshold_value=10,
    )
    store.change_thresholds(spark, [change], later)
    record_dq_audit(spark, tables, store, later)
    audit = read_audit(spark, store.dq_audit, DQ_AUDIT).filter(
        "pipeline_name = 'PERSON_SPINE' AND check_name = 'THR_SSN_NULL'"
    )
    got = [(r.threshold, r.status) for r in audit.orderBy("created_ts").collect()]
    assert got == [(200, "PASSED"), (10, "FAIL")]


def test_a_changed_rule_grades_the_next_run(spark, tmp_path):
    tables, store = SampleTables(spark, SF_DIR), Store.under(str(tmp_path))
    store.install(spark, AS_OF_TS)
    change = FreshnessRuleChange(
        target_table="CUSTOMER_BEHAVIOR_DAILY",
        decision_id="LCV1-S1-D03",
        rule_name="TABLE_FRESHNESS",
        date_column="RECORD_UPDATED_TS",
        expected_lag_days=1,
        severity="WARN",
    )
    store.change_freshness_rules(spark, [change], AS_OF_TS)
    record_freshness_audit(spark, tables, store, AS_OF_TS)
    audit = read_audit(spark, store.freshness_audit, FRESHNESS_AUDIT)
    row = audit.filter("decision_id = 'LCV1-S1-D03' AND rule_name = 'TABLE_FRESHNESS'").first()
    assert (row.expected_value, row.status) == ("2024-01-30", "PASSED")
    assert audit.count() == 8


def test_catalog_tables(spark):
    tables = SampleTables(spark, SF_DIR)
    audit = dq_audit_all(tables, seed_thresholds(spark, AS_OF_TS), AS_OF_TS)
    try:
        create_audit_table(spark, "dq_audit_t", DQ_AUDIT)
        append_audit_table(audit, "dq_audit_t", DQ_AUDIT)
        create_audit_table(spark, "dq_audit_t", DQ_AUDIT)
        append_audit_table(audit, "dq_audit_t", DQ_AUDIT)
        assert load_table(spark, "dq_audit_t").count() == 86
    finally:
        spark.sql("DROP TABLE IF EXISTS dq_audit_t")


def test_load_table_from_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3).write.json(path)
    assert load_table(spark, path, "json").count() == 3
    assert load_table(spark, f"{SF_DIR}/region.parquet").count() == 5


def test_a_half_written_version_is_ignored(spark, tmp_path):
    root = str(tmp_path / "thresholds")
    rows = seed_thresholds(spark, AS_OF_TS)
    write_config(rows, root, THRESHOLDS, 1)
    write_config(rows.repartition(4), root, THRESHOLDS, 2)
    whole = next((tmp_path / "thresholds" / "version=2").iterdir())
    torn = tmp_path / "thresholds" / "version=3" / whole.name
    torn.mkdir(parents=True)
    part = next(whole.glob("part-*.parquet"))
    (torn / part.name).write_bytes(part.read_bytes())
    assert latest_version(spark, root, THRESHOLDS) == 2
    assert read_config(spark, root, THRESHOLDS).count() == 43
    with pytest.raises(ValueError, match="no whole version 3"):
        read_config(spark, root, THRESHOLDS, 3)


def test_of_two_writers_of_a_version_one_wins(spark, tmp_path):
    root = str(tmp_path / "thresholds")
    rows = seed_thresholds(spark, AS_OF_TS)
    write_config(rows, root, THRESHOLDS, 1)
    first = next((tmp_path / "thresholds" / "version=1").iterdir())
    # A second whole write, as of a writer that began before the first ended.
    smaller = first.with_name("write_id=0")
    smaller.mkdir()
    for part in first.glob("part-*.parquet"):
        (smaller / part.name).write_bytes(part.read_bytes())
    assert read_config(spark, root, THRESHOLDS).count() == 43
    with pytest.raises(VersionConflict):
        write_config(rows, root, THRESHOLDS, 1)
    assert latest_version(spark, root, THRESHOLDS) == 1


def test_configs_that_are_not_there(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError, match="no whole version"):
        read_config(spark, str(empty), THRESHOLDS)
    with pytest.raises(ValueError, match="empty config"):
        write_config(seed_thresholds(spark, AS_OF_TS).limit(0), str(empty), THRESHOLDS, 1)


@pytest.mark.parametrize("catalog", [False, True])
def test_any_suite_is_recorded_once(spark, tmp_path, catalog):
    if catalog:
        spark.sql("CREATE DATABASE IF NOT EXISTS quality")
    store = Store.in_catalog("quality") if catalog else Store.under(str(tmp_path))
    try:
        store.install(spark, AS_OF_TS)
        later = AS_OF_TS + timedelta(hours=1)
        for _ in range(2):  # a change on top of a change
            change = ThresholdChange(
                table_name="ORDERS",
                check_name="a.b",
                decision_id="O",
                severity="FAIL",
                threshold_type="ABSOLUTE_COUNT",
                threshold_value=10,
            )
            store.change_thresholds(spark, [change], later)
        thresholds = read_config(spark, store.thresholds, THRESHOLDS)
        orders = load_table(spark, f"{SF_DIR}/orders.parquet")
        suite = Suite("ORDERS", (count_where("a.b", F.col("o_orderkey") > 0),), by="o_orderstatus")
        record_audit(orders, suite, thresholds, store.dq_audit, later)
        with pytest.raises(RunRecorded):
            record_audit(orders, suite, thresholds, store.dq_audit, later)
        audit = load_table(spark, store.dq_audit)
        assert [(r.check_name, r.status) for r in audit.collect()] == [("a.b", "FAIL")]

        rules = read_config(spark, store.freshness_rules, FRESHNESS_RULES)
        summary = run_freshness(SampleTables(spark, SF_DIR).spine, "PERSON_SPINE", later)
        record_freshness(summary, rules, store.freshness_audit, "PERSON_SPINE", later)
        with pytest.raises(RunRecorded):
            record_freshness(summary, rules, store.freshness_audit, "PERSON_SPINE", later)
        assert load_table(spark, store.freshness_audit).count() == 2
    finally:
        if catalog:
            spark.sql("DROP DATABASE quality CASCADE")


def _orders_suite(limit):
    return Suite(
        "ORDERS", (count_where("a.b", F.col("o_orderkey") > limit),), by="o_orderstatus"
    )


def _orders_thresholds(spark):
    statuses = [(s,) for s in "FOP"]
    return spark.createDataFrame(statuses, "decision_id string").selectExpr(
        "'ORDERS' AS table_name",
        "'a.b' AS check_name",
        "decision_id",
        "'FAIL' AS severity",
        "10L AS threshold_value",
        "true AS is_active",
    )


@pytest.mark.parametrize("catalog", [False, True])
def test_a_rerun_replaces_its_own_partition(spark, tmp_path, catalog):
    target = "dq_audit_r" if catalog else str(tmp_path / "audit")
    orders, thresholds = load_table(spark, f"{SF_DIR}/orders.parquet"), _orders_thresholds(spark)
    try:
        for hour in range(2):
            moment = AS_OF_TS + timedelta(hours=hour)
            record_audit(orders, _orders_suite(-1), thresholds, target, moment)
        # Another table at the same clock is a run of its own.
        other = Suite("OTHER", _orders_suite(-1).checks, by="o_orderstatus")
        record_audit(
            orders, other, thresholds.withColumn("table_name", F.lit("OTHER")), target, AS_OF_TS
        )
        record_audit(orders, _orders_suite(10**9), thresholds, target, AS_OF_TS, rerun="replace")
        rows = load_table(spark, target).groupBy("pipeline_name", "created_ts")
        found = rows.agg(F.count("*").alias("n"), F.sum("violation_count").alias("v")).collect()
        violations = {(r.pipeline_name, r.created_ts.hour): (r.n, r.v) for r in found}
        total = orders.count()
        assert violations == {
            ("ORDERS", 6): (3, 0),
            ("ORDERS", 7): (3, total),
            ("OTHER", 6): (3, total),
        }
        with pytest.raises(ValueError, match="rerun"):
            record_audit(orders, other, thresholds, target, AS_OF_TS, rerun="append")
    finally:
        spark.sql("DROP TABLE IF EXISTS dq_audit_r")


@pytest.mark.parametrize("catalog", [False, True])
def test_the_test_for_a_run_reads_its_partitions_only(spark, tmp_path, catalog):
    target = "dq_audit_p" if catalog else str(tmp_path / "audit")
    orders, thresholds = load_table(spark, f"{SF_DIR}/orders.parquet"), _orders_thresholds(spark)
    try:
        for day in range(3):
            record_audit(orders, _orders_suite(-1), thresholds, target, AS_OF_TS + timedelta(days=day))
        run = Run(AS_OF_TS, ("ORDERS",), "pipeline_name", "business_date")
        held = recorded(spark, target, run)
        filters = plan_of(held).split("PartitionFilters: [")[1].split("]")[0]
        assert "audit_run" in filters and "pipeline_name" in filters and "business_date" in filters
        assert len(held.collect()) == 3
        if not catalog:  # no other day is listed
            assert all("business_date=2024-01-31" in f for f in held.inputFiles())
        nothing = Run(AS_OF_TS, ("PARTS",), "pipeline_name", "business_date")
        assert recorded(spark, target, nothing).count() == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS dq_audit_p")


def test_writers_at_the_same_time(spark, tmp_path, monkeypatch):
    """Different runs all land; of writers of one run that all get past the test, one's rows stand."""
    from concurrent.futures import ThreadPoolExecutor

    target = str(tmp_path / "audit")
    orders, thresholds = load_table(spark, f"{SF_DIR}/orders.parquet"), _orders_thresholds(spark)
    moments = [AS_OF_TS + timedelta(minutes=m) for m in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda m: record_audit(orders, _orders_suite(-1), thresholds, target, m), moments))
    audit = read_audit(spark, target, DQ_AUDIT)
    assert {r["count"] for r in audit.groupBy("created_ts").count().collect()} == {3}
    assert audit.count() == 12

    run = Run(moments[0], ("ORDERS",), "pipeline_name", "business_date")
    monkeypatch.setattr(
        "tablegauge.sources.audit_store.recorded", lambda spark, target, run: spark.range(0)
    )
    rows = audit.filter(F.col("created_ts") == F.lit(moments[0]))
    rows = spark.createDataFrame(rows.collect(), DQ_AUDIT)
    for _ in range(2):  # the second writer tested before the first one wrote
        record_run(rows, target, DQ_AUDIT, run)
    assert read_audit(spark, target, DQ_AUDIT).count() == 12


@pytest.mark.parametrize("catalog", [False, True])
def test_the_latest_version_is_found_without_reading_the_others(spark, tmp_path, catalog):
    rows = seed_thresholds(spark, AS_OF_TS).coalesce(1)
    if catalog:
        spark.sql("CREATE DATABASE IF NOT EXISTS versions")
    target = "versions.thresholds" if catalog else str(tmp_path / "thresholds")
    try:
        write_config(rows, target, THRESHOLDS, 1)
        if catalog:
            write_config(rows.limit(5), target, THRESHOLDS, 2)
            found = read_config(spark, target, THRESHOLDS)
            filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
            assert "version" in filters and "write_id" in filters and found.count() == 5
            assert len(found.inputFiles()) <= 2
            assert latest_version(spark, target, THRESHOLDS) == 2
            return
        # 199 further versions; the files of all but the last whole one cannot be read.
        first = next((tmp_path / "thresholds" / "version=1").iterdir())
        part = next(first.glob("part-*.parquet"))
        for version in range(2, 201):
            folder = tmp_path / "thresholds" / f"version={version}" / f"write_id=w{version}"
            folder.mkdir(parents=True)
            content = part.read_bytes() if version == 200 else b"not a parquet file"
            (folder / part.name).write_bytes(content)
        assert latest_version(spark, target, THRESHOLDS) == 200
        found = read_config(spark, target, THRESHOLDS)
        assert found.count() == 43
        assert all("/version=200/" in f for f in found.inputFiles())
        assert read_config(spark, target, THRESHOLDS, 1).count() == 43
        with pytest.raises(VersionConflict):
            write_config(rows, target, THRESHOLDS, 200)
        write_config(rows.limit(7), target, THRESHOLDS, 201)
        assert read_config(spark, target, THRESHOLDS).count() == 7
    finally:
        if catalog:
            spark.sql("DROP DATABASE versions CASCADE")
