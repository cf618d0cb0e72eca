from datetime import date, datetime

from tablegauge.operators.checks import Suite
from tablegauge.operators.summary import dq_summary

AS_OF = date(2024, 1, 31)
AS_OF_TS = datetime(2024, 1, 31, 6, 0, 0)


def values(df, *checks, **suite):
    """check_name -> value of the only decision in df."""
    rows = dq_summary(df, Suite("T", checks, **suite)).collect()
    return {row.check_name: row.check_value for row in rows}


def keys_frame(spark, keys, decision="D"):
    """A table of string keys."""
    rows = [(decision, key) for key in keys]
    return spark.createDataFrame(rows, "decision_id string, key string")


def plan_of(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
