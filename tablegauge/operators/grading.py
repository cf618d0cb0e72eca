"""Grade summary rows against thresholds and build audit rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.functions import ntz_literal
from tablegauge.operators.config import active_config

# Summary rows that carry volumes, not check results.
METADATA_CHECKS = ("TOTAL_VOL", "DISTINCT_PERSON_ID", "DISTINCT_PK")

TABLE_KEYS = ("table_name", "check_name", "decision_id")
# Without the table name a check graded by two active thresholds yields two rows.
DECISION_KEYS = ("check_name", "decision_id")


def dq_grade(
    summary: DataFrame, thresholds: DataFrame, keys: Sequence[str] = TABLE_KEYS
) -> DataFrame:
    """Summary rows with severity, threshold and status; ungraded checks drop out.

    Both sides are normally tiny, but each grows with the number of decisions, so the join
    carries no broadcast hint: Spark broadcasts below its size limit and shuffles above it.
    """
    limits = active_config(thresholds).select(
        *keys, "severity", F.col("threshold_value").alias("threshold")
    )
    value, threshold = F.col("check_value"), F.col("threshold")
    return (
        summary.filter(~F.col("check_name").isin(*METADATA_CHECKS))
        .join(limits, list(keys), "inner")
        .withColumn(
            "status",
            F.when(value <= threshold, "PASSED")
            .when(value > threshold, F.col("severity"))
            .otherwise("UNKNOWN"),
        )
    )


def dq_audit(
    summary: DataFrame,
    thresholds: DataFrame,
    as_of_ts: datetime,
    *,
    as_of: date | None = None,
    keys: Sequence[str] = TABLE_KEYS,
) -> DataFrame:
    """Audit rows of one run. Grading sees the exact value; violation_count is rounded after."""
    return dq_grade(summary, thresholds, keys).select(
        F.concat("decision_id", F.lit(as_of_ts.strftime("_%Y%m%d%H%M%S"))).alias("dq_run_id"),
        F.col("table_name").alias("pipeline_name"),
        "decision_id",
        F.lit(as_of or as_of_ts.date()).alias("business_date"),
        "check_name",
        "severity",
        F.col("check_value").cast("decimal(38,0)").cast("bigint").alias("violation_count"),
        "threshold",
        "status",
        ntz_literal(as_of_ts).alias("created_ts"),
        "check_value",
    )
