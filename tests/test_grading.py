from pyspark.sql import functions as F

from helpers import AS_OF_TS
from tablegauge import dq_audit, dq_grade
from tablegauge.operators.grading import DECISION_KEYS
from tablegauge.schemas import DQ_AUDIT, SUMMARY

THRESHOLDS = (
    "table_name string, check_name string, decision_id string, severity string,"
    " threshold_value long, is_active boolean"
)


def _audit(spark, value, threshold=10, severity="WARN", check="C", decision="D", **options):
    summary = spark.createDataFrame([(decision, "T", check, value)], SUMMARY)
    rows = [("T", check, "D", severity, threshold, True), ("T", check, "D", "FAIL", 0, False)]
    thresholds = spark.createDataFrame(rows, THRESHOLDS)
    return dq_audit(summary, thresholds, AS_OF_TS, **options).collect()


def test_grade_sees_the_exact_value(spark):
    (row,) = _audit(spark, 10.5)
    assert (row.status, row.violation_count, row.check_value) == ("WARN", 11, 10.5)
    (row,) = _audit(spark, 0.4, threshold=0, severity="FAIL")
    assert (row.status, row.violation_count) == ("FAIL", 0)
    (row,) = _audit(spark, 10.0)
    assert row.status == "PASSED"
    (row,) = _audit(spark, -200.0)
    assert (row.status, row.violation_count) == ("PASSED", -200)


def test_rounding_is_half_away_from_zero(spark):
    counts = [_audit(spark, v)[0].violation_count for v in (2.5, 3.5, -2.5, 2.4)]
    assert counts == [3, 4, -3, 2]


def test_severity_is_the_status(spark):
    assert _audit(spark, 11.0, severity="INFO")[0].status == "INFO"


def test_missing_value_is_unknown(spark):
    assert _audit(spark, None)[0].status == "UNKNOWN"


def test_ungraded_rows_drop_out(spark):
    assert _audit(spark, 1.0, decision=None) == []
    assert _audit(spark, 1.0, decision="OTHER") == []
    assert _audit(spark, 1.0, check="TOTAL_VOL") == []


def test_audit_row(spark):
    (row,) = _audit(spark, 1.0)
    assert row.dq_run_id == "D_20240131060000"
    assert (row.pipeline_name, row.business_date, row.created_ts) == (
        "T",
        AS_OF_TS.date(),
        AS_OF_TS,
    )


def test_audit_schema(spark):
    summary = spark.createDataFrame([], SUMMARY)
    thresholds = spark.createDataFrame([], THRESHOLDS)
    audit = dq_audit(summary, thresholds, AS_OF_TS)
    assert [(f.name, f.dataType) for f in audit.schema] == [
        (f.name, f.dataType) for f in DQ_AUDIT
    ]


def test_joining_without_the_table_name_fans_out(spark):
    summary = spark.createDataFrame([("D", "T", "C", 4.0)], SUMMARY)
    thresholds = spark.createDataFrame(
        [("T", "C", "D", "WARN", 1, True), ("T_SNAPSHOT", "C", "D", "WARN", 5, True)], THRESHOLDS
    )
    assert dq_grade(summary, thresholds).count() == 1
    both = dq_grade(summary, thresholds, DECISION_KEYS).orderBy(F.col("threshold")).collect()
    assert [(r.threshold, r.status) for r in both] == [(1, "WARN"), (5, "PASSED")]
