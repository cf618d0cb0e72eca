"""Freshness of tables: latest run, last update and lag, graded against rules."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.functions import ntz_literal, run_id_date
from tablegauge.operators.config import active_config
from tablegauge.operators.summary import metric_rows

GRADES = ("exact", "lag_tolerant")


# Newest runs that are named in a filter; more are found by a join, which prunes nothing by itself.
NAMED_RUNS = 1000


def latest_runs(
    df: DataFrame, updated: str = "record_updated_ts", *, runs_first: bool = False
) -> DataFrame:
    """Last update date within the latest run of each decision.

    Run ids compare as text and a NULL run id comes first. Rows shrink to one per run before
    the window, and ranking keeps one candidate per task before they meet.

    `runs_first` is for tables partitioned by run, best by decision and run: a job at once finds the newest
    run of each decision, reading these two columns alone, and the rest reads the partitions of those runs.
    """
    if runs_first:
        df = _of_newest_runs(df)
    runs = df.groupBy("decision_id", "run_id").agg(
        F.max(F.to_date(updated)).alias("last_updated_date")
    )
    return _newest(runs)


def _newest(runs: DataFrame) -> DataFrame:
    newest_first = Window.partitionBy("decision_id").orderBy(F.desc_nulls_first("run_id"))
    return (
        runs.withColumn("_rank", F.row_number().over(newest_first))
        .filter("_rank = 1")
        .drop("_rank")
    )


def _of_newest_runs(df: DataFrame) -> DataFrame:
    """The rows of `df` in the newest run of some decision."""
    newest = _newest(df.select("decision_id", "run_id").distinct()).select("run_id").distinct()
    named = [row[0] for row in newest.limit(NAMED_RUNS + 1).collect()]
    if len(named) > NAMED_RUNS:
        wanted = newest.withColumnRenamed("run_id", "_run_id")
        return df.join(wanted, F.col("run_id").eqNullSafe(F.col("_run_id")), "left_semi")
    fits = F.col("run_id").isin([r for r in named if r is not None])
    return df.filter(fits | F.col("run_id").isNull() if None in named else fits)


def _summary_rows(
    wide: DataFrame, table_name: str, as_of_ts: datetime, keep_null_metrics: bool
) -> DataFrame:
    ids = ["decision_id", "run_id"]
    metrics = {c: c for c in wide.columns if c not in ids}
    text = wide.select(*ids, *[F.col(c).cast("string").alias(c) for c in metrics])
    return metric_rows(text, ids, metrics, "rule_name", "actual_value", keep_null_metrics).select(
        *ids,
        ntz_literal(as_of_ts).alias("checked_ts"),
        F.lit(table_name).alias("target_table"),
        "rule_name",
        "actual_value",
    )


def run_freshness(
    df: DataFrame,
    table_name: str,
    as_of_ts: datetime,
    *,
    updated: str = "record_updated_ts",
    strict_run_id: bool = False,
    keep_null_metrics: bool = False,
    runs_first: bool = False,
) -> DataFrame:
    """Freshness of the latest run: its last update, and the date written in its run id.

    `runs_first` as in `latest_runs`.
    """
    wide = latest_runs(df, updated, runs_first=runs_first).select(
        "decision_id",
        "run_id",
        F.col("last_updated_date").alias("TABLE_FRESHNESS"),
        run_id_date("run_id", strict=strict_run_id).alias("RUN_ID_FRESHNESS"),
    )
    return _summary_rows(wide, table_name, as_of_ts, keep_null_metrics)


def lag_freshness(
    df: DataFrame,
    table_name: str,
    as_of_ts: datetime,
    *,
    as_of: date | None = None,
    updated: str = "record_updated_ts",
    business_date: str = "business_date",
    keep_null_metrics: bool = False,
) -> DataFrame:
    """Freshness of a table without runs: its last update, and its lag in days."""
    today = F.lit(as_of or as_of_ts.date())
    wide = df.groupBy("decision_id").agg(
        F.lit(None).cast("string").alias("run_id"),
        F.max(F.to_date(updated)).alias("TABLE_FRESHNESS"),
        F.datediff(today, F.max(business_date)).alias("LAG_DAY"),
    )
    return _summary_rows(wide, table_name, as_of_ts, keep_null_metrics)


def freshness_audit(
    summary: DataFrame,
    rules: DataFrame,
    as_of_ts: datetime,
    *,
    as_of: date | None = None,
    grade: str = "exact",
) -> DataFrame:
    """Audit rows of a freshness summary.

    `exact` passes only a date equal to `as_of`, so a future date fails too. `lag_tolerant`
    passes dates and lags within the rule's expected lag, which is 0 where it is not set.
    """
    if grade not in GRADES:
        raise ValueError(f"grade must be one of {GRADES}, not {grade!r}")
    today = F.lit(as_of or as_of_ts.date())
    actual, rule = F.col("actual_value"), F.col("rule_name")
    if grade == "exact":
        expected = today.cast("string")
        passed = actual.try_cast("date") == today
    else:
        lag = F.coalesce("expected_lag_days", F.lit(0))
        oldest = F.date_add(today, -lag)
        expected = F.when(rule == "TABLE_FRESHNESS", oldest.cast("string")).when(
            rule == "LAG_DAY", lag.cast("string")
        )
        passed = F.when(rule == "TABLE_FRESHNESS", actual.try_cast("date") >= oldest).when(
            rule == "LAG_DAY", actual.try_cast("int") <= lag
        )
    limits = active_config(rules).select(
        "decision_id", "rule_name", "expected_lag_days", "severity"
    )
    return summary.join(limits, ["decision_id", "rule_name"], "inner").select(
        "run_id",
        "checked_ts",
        "rule_name",
        "decision_id",
        "target_table",
        expected.alias("expected_value"),
        "actual_value",
        "severity",
        F.when(passed, "PASSED").otherwise(F.col("severity")).alias("status"),
        F.concat(F.lit("Checked at "), ntz_literal(as_of_ts).cast("string")).alias("details"),
    )
