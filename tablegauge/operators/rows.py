"""The rows behind the counts of a summary: those that break checks, and those beyond the first of a key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.functions import as_column
from tablegauge.operators.checks import Check, RowCount, Suite, period_drop_pct
from tablegauge.operators.summary import dq_summary


def row_checks(suite: Suite) -> dict[str, Column]:
    """The checks of a suite that count rows, by name, with the predicate of a broken row.

    Checks over keys, references or percentages judge no single row and are left out.
    """

    def predicate(check: Check) -> Column | None:
        (measure, *others) = check.measures.values()
        if others or not isinstance(measure, RowCount) or measure.predicate is None:
            return None
        return measure.predicate

    found = {check.name: predicate(check) for check in suite.checks}
    return {name: broken for name, broken in found.items() if broken is not None}


def violating_rows(df: DataFrame, suite: Suite, column: str = "broken_checks") -> DataFrame:
    """The rows of `df` that break any row check of the suite, with the names of the checks they break.

    One scan, no shuffle. `column` is an array in the order of the suite. Counting its names per decision gives
    the values that `dq_summary` has for these checks.
    """
    if column in df.columns:
        raise ValueError(f"the table has a column {column} already; name another")
    checks = row_checks(suite)
    if not checks:
        raise ValueError(f"the suite of {suite.table_name} has no check that judges single rows")
    base = df if suite.scope is None else df.filter(suite.scope)
    broken = F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in checks.items()]))
    # Filtered on the predicates, which can be pushed to the scan; the names are put together after.
    return base.filter(reduce(or_, checks.values())).withColumn(column, broken)


def surplus_rows(
    df: DataFrame,
    *keys: str | Column,
    first: Sequence[str | Column] = (),
    scope: Column | None = None,
    salts: int | None = None,
) -> DataFrame:
    """The rows beyond one per key: as many as `unique` counts. Rows with a NULL in the key are all surplus.

    Of a key the first row in the order of `first` (all columns by default, NULLs first) stays out. Rows are
    ranked twice: among those of their key in one of `salts` pieces of the input (as many as shuffle
    partitions by default), then the first ones of the pieces among themselves. So the rows of a key that holds
    a third of the table are ranked by many tasks.
    """
    pieces = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df if scope is None else df.filter(scope)
    parts = [as_column(k) for k in keys]
    order = [as_column(c) for c in first] or [F.col(f"`{c}`") for c in df.columns]
    rows = base.select(
        F.struct("*").alias("row"),
        F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)]).alias("key"),
        reduce(or_, (p.isNull() for p in parts)).alias("open"),
        F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("at"),
        F.pmod(F.monotonically_increasing_id(), F.lit(pieces)).alias("piece"),
    )
    in_piece = Window.partitionBy("key", "piece").orderBy("at")
    rows = rows.withColumn("rank", F.row_number().over(in_piece))
    # All but the first ones keep to their piece, where they cannot gather.
    among_first = Window.partitionBy("key", F.when(F.col("rank") > 1, F.col("piece"))).orderBy("at")
    rows = rows.withColumn("rank_of_first", F.row_number().over(among_first))
    return rows.filter("open OR rank > 1 OR rank_of_first > 1").select("row.*")


def period_drop_summary(
    df: DataFrame,
    name: str,
    day: str,
    as_of: date,
    *,
    table_name: str,
    by: str = "decision_id",
    decisions: DataFrame | None = None,
) -> DataFrame:
    """Summary rows of `period_drop_pct`, reading the two days it compares and nothing else.

    `day` is a date column; where the table is partitioned by it, two partitions are read. A decision without
    rows on these days has a drop of 0: `decisions` (a column named as `by`) lists those there are. By default
    they are taken from the table, by a scan of that column alone, which opens no column where the table is
    partitioned by decision too.
    """
    two = [F.date_sub(F.lit(as_of), back) for back in (2, 1)]
    suite = Suite(table_name, (period_drop_pct(name, day, as_of),), by=by)
    found = dq_summary(df.filter(F.col(day).isin(two)), suite)
    known = (df if decisions is None else decisions).select(F.col(by).cast("string").alias("decision_id"))
    none = known.distinct().select(
        "decision_id", F.lit(table_name).alias("table_name"), F.lit(name).alias("check_name"), F.lit(0.0).alias("check_value")
    )
    both = found.withColumn("has", F.lit(1)).unionByName(none.withColumn("has", F.lit(0)))
    best = F.max_by("check_value", "has").alias("check_value")
    return both.groupBy("decision_id", "table_name", "check_name").agg(best)
