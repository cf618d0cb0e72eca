"""Schemas of the config and audit tables."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in fields])


THRESHOLDS = _schema(
    ("threshold_id", T.LongType()),
    ("table_name", T.StringType(), False),
    ("check_name", T.StringType(), False),
    ("decision_id", T.StringType(), False),
    ("severity", T.StringType(), False),
    ("threshold_type", T.StringType(), False),
    ("threshold_value", T.LongType(), False),
    ("lookback_days", T.LongType()),
    ("is_active", T.BooleanType()),
    ("created_ts", T.TimestampNTZType()),
    ("updated_ts", T.TimestampNTZType()),
    ("notes", T.StringType()),
)

FRESHNESS_RULES = _schema(
    ("target_table", T.StringType()),
    ("decision_id", T.StringType()),
    ("rule_name", T.StringType()),
    ("date_column", T.StringType()),
    ("expected_lag_days", T.IntegerType()),
    ("sla_hour_et", T.IntegerType()),
    ("severity", T.StringType()),
    ("is_active", T.BooleanType()),
    ("created_ts", T.TimestampNTZType()),
    ("updated_ts", T.TimestampNTZType()),
    ("notes", T.StringType()),
)

SUMMARY = _schema(
    ("decision_id", T.StringType()),
    ("table_name", T.StringType()),
    ("check_name", T.StringType()),
    ("check_value", T.DoubleType()),
)

# check_value keeps the graded, unrounded value next to the rounded violation_count.
DQ_AUDIT = _schema(
    ("dq_run_id", T.StringType()),
    ("pipeline_name", T.StringType()),
    ("decision_id", T.StringType()),
    ("business_date", T.DateType()),
    ("check_name", T.StringType()),
    ("severity", T.StringType()),
    ("violation_count", T.LongType()),
    ("threshold", T.LongType()),
    ("status", T.StringType()),
    ("created_ts", T.TimestampNTZType()),
    ("check_value", T.DoubleType()),
)

FRESHNESS_SUMMARY = _schema(
    ("decision_id", T.StringType()),
    ("run_id", T.StringType()),
    ("checked_ts", T.TimestampNTZType()),
    ("target_table", T.StringType()),
    ("rule_name", T.StringType()),
    ("actual_value", T.StringType()),
)

FRESHNESS_AUDIT = _schema(
    ("run_id", T.StringType()),
    ("checked_ts", T.TimestampNTZType()),
    ("rule_name", T.StringType()),
    ("decision_id", T.StringType()),
    ("target_table", T.StringType()),
    ("expected_value", T.StringType()),
    ("actual_value", T.StringType()),
    ("severity", T.StringType()),
    ("status", T.StringType()),
    ("details", T.StringType()),
)
