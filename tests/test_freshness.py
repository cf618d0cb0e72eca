from datetime import datetime

import pytest

from helpers import AS_OF_TS, plan_of
from tablegauge import freshness_audit, lag_freshness, latest_runs, run_freshness
from tablegauge.schemas import FRESHNESS_AUDIT, FRESHNESS_SUMMARY

RULES = (
    "decision_id string, rule_name string, expected_lag_days int, severity string,"
    " is_active boolean"
)
TODAY, YESTERDAY = datetime(2024, 1, 31, 5), datetime(2024, 1, 30, 5)


def _runs(spark, *rows):
    return spark.createDataFrame(
        [("D", *row) for row in rows],
        "decision_id string, run_id string, record_updated_ts timestamp_ntz",
    )


def _actual(df, **options):
    rows = run_freshness(df, "T", AS_OF_TS, **options).collect()
    return {r.rule_name: r.actual_value for r in rows}


def _grade(spark, rule, actual, grade="exact", lag=None):
    summary = spark.createDataFrame(
        [("D", None, AS_OF_TS, "T", rule, actual)], FRESHNESS_SUMMARY
    )
    rules = spark.createDataFrame(
        [("D", rule, lag, "WARN", True), ("D", rule, lag, "FAIL", False)], RULES
    )
    (row,) = freshness_audit(summary, rules, AS_OF_TS, grade=grade).collect()
    return row.expected_value, row.status


def test_freshness_looks_at_the_latest_run_only(spark):
    df = _runs(spark, ("RUN_20240131_01", YESTERDAY), ("RUN_20240130_01", TODAY))
    assert _actual(df) == {"TABLE_FRESHNESS": "2024-01-30", "RUN_ID_FRESHNESS": "2024-01-31"}


def test_run_ids_compare_as_text(spark):
    df = _runs(spark, ("RUN_9", TODAY), ("RUN_20240131", TODAY))
    assert [r.run_id for r in latest_runs(df).collect()] == ["RUN_9"]


def test_null_run_is_the_latest(spark):
    df = _runs(spark, (None, YESTERDAY), ("RUN_20240131", TODAY), (None, None))
    assert [tuple(r) for r in latest_runs(df).collect()] == [("D", None, YESTERDAY.date())]
    assert _actual(df) == {"TABLE_FRESHNESS": "2024-01-30"}


def test_missing_timestamps_yield_no_row(spark):
    df = _runs(spark, ("RUN_20240131", None))
    assert _actual(df) == {"RUN_ID_FRESHNESS": "2024-01-31"}
    assert _actual(df, keep_null_metrics=True)["TABLE_FRESHNESS"] is None


def test_bad_run_id(spark):
    df = _runs(spark, ("RUN_BADVALUE", TODAY))
    assert _actual(df) == {"TABLE_FRESHNESS": "2024-01-31"}
    with pytest.raises(Exception, match="(?i)parse|CANNOT_PARSE"):
        _actual(df, strict_run_id=True)


def test_lag(spark):
    df = spark.createDataFrame(
        [("D", YESTERDAY, YESTERDAY.date()), ("D", None, None)],
        "decision_id string, record_updated_ts timestamp_ntz, business_date date",
    )
    rows = lag_freshness(df, "T", AS_OF_TS).collect()
    assert {r.rule_name: r.actual_value for r in rows} == {
        "TABLE_FRESHNESS": "2024-01-30",
        "LAG_DAY": "1",
    }
    assert {r.run_id for r in rows} == {None}


@pytest.mark.parametrize(
    ("actual", "status"),
    [("2024-01-31", "PASSED"), ("2024-01-30", "WARN"), ("2024-02-01", "WARN"), (None, "WARN")],
)
def test_exact_grade(spark, actual, status):
    assert _grade(spark, "TABLE_FRESHNESS", actual) == ("2024-01-31", status)


@pytest.mark.parametrize(
    ("rule", "actual", "lag", "expected", "status"),
    [
        ("TABLE_FRESHNESS", "2024-01-30", None, "2024-01-31", "WARN"),
        ("TABLE_FRESHNESS", "2024-01-30", 1, "2024-01-30", "PASSED"),
        ("TABLE_FRESHNESS", "2024-02-01", None, "2024-01-31", "PASSED"),
        ("LAG_DAY", "1", 1, "1", "PASSED"),
        ("LAG_DAY", "2", 1, "1", "WARN"),
        ("LAG_DAY", "1", None, "0", "WARN"),
        ("OTHER", "1", 1, None, "WARN"),
    ],
)
def test_lag_tolerant_grade(spark, rule, actual, lag, expected, status):
    assert _grade(spark, rule, actual, "lag_tolerant", lag) == (expected, status)


def test_audit_row(spark):
    summary = spark.createDataFrame(
        [("D", "R", AS_OF_TS, "T", "TABLE_FRESHNESS", "2024-01-31")], FRESHNESS_SUMMARY
    )
    rules = spark.createDataFrame([("D", "TABLE_FRESHNESS", None, "WARN", True)], RULES)
    audit = freshness_audit(summary, rules, AS_OF_TS)
    assert [(f.name, f.dataType) for f in audit.schema] == [
        (f.name, f.dataType) for f in FRESHNESS_AUDIT
    ]
    assert audit.first().details == "Checked at 2024-01-31 06:00:00"


def test_unknown_grade(spark):
    with pytest.raises(ValueError, match="grade"):
        freshness_audit(None, None, AS_OF_TS, grade="loose")


def test_runs_first_reads_the_newest_runs_only(spark, tmp_path):
    """On a table partitioned by decision and run, files of older runs are not opened."""
    path = str(tmp_path / "runs")
    rows = spark.range(600).selectExpr(
        "concat('D', CAST(id % 3 AS STRING)) AS decision_id",
        "concat('RUN_202401', lpad(CAST(1 + id % 20 + id % 3 AS STRING), 2, '0'), '_01') AS run_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 40 AS INT)) AS record_updated_ts",
    )
    rows.write.partitionBy("decision_id", "run_id").parquet(path)
    df = spark.read.schema(rows.schema).parquet(path)
    want = sorted(map(tuple, latest_runs(df).collect()))
    newest = latest_runs(df, runs_first=True)
    assert "run_id" in plan_of(newest).split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(map(tuple, newest.collect())) == want and len(want) == 3
    assert {tuple(r) for r in run_freshness(df, "T", AS_OF_TS, runs_first=True).collect()} == {
        tuple(r) for r in run_freshness(df, "T", AS_OF_TS).collect()
    }
    runs = {r[1] for r in want}
    for part in (tmp_path / "runs").glob("decision_id=*/run_id=*/*.parquet"):
        if part.parent.name.removeprefix("run_id=") not in runs:
            part.write_bytes(b"broken")
            part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert sorted(map(tuple, newest.collect())) == want


def test_runs_first_with_null_runs_and_many_runs(spark, monkeypatch):
    df = _runs(spark, ("RUN_20240131_01", TODAY), (None, YESTERDAY), ("RUN_20240130_01", TODAY))
    other = df.selectExpr("'E' AS decision_id", "coalesce(run_id, 'RUN_1') AS run_id", "record_updated_ts")
    both = df.unionByName(other)
    want = sorted(map(tuple, latest_runs(both).collect()))
    assert sorted(map(tuple, latest_runs(both, runs_first=True).collect())) == want
    monkeypatch.setattr("tablegauge.operators.freshness.NAMED_RUNS", 1)
    assert sorted(map(tuple, latest_runs(both, runs_first=True).collect())) == want
    assert latest_runs(both.limit(0), runs_first=True).collect() == []
