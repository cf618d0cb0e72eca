"""Column helpers. All are built-in expressions, so they stay in whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def within(scope: Column | None, predicate: Column) -> Column:
    """`predicate` limited to the rows of `scope`."""
    return predicate if scope is None else scope & predicate


def div0(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 for a zero denominator and NULL when either operand is NULL."""
    return F.when((denominator == 0) & numerator.isNotNull(), F.lit(0.0)).otherwise(
        F.try_divide(numerator, denominator)
    )


def percentage(part: Column, whole: Column) -> Column:
    return div0(part, whole) * 100


def ntz_literal(moment: datetime) -> Column:
    """A TIMESTAMP_NTZ constant: `F.lit(datetime)` would be bound to the session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def run_id_date(run_id: str | Column, *, strict: bool = False) -> Column:
    """Date in characters 5-12 of a run id (`RUN_20240131_01`); bad text is NULL, or raises."""
    text = F.substring(as_column(run_id), 5, 8)
    return F.to_date(text, "yyyyMMdd") if strict else F.try_to_date(text, "yyyyMMdd")


# Rules for `matches`: each turns a text column into "the value is well formed".


def like(pattern: str) -> Callable[[Column], Column]:
    return lambda text: text.like(pattern)


def min_digits(count: int) -> Callable[[Column], Column]:
    return lambda text: F.length(F.regexp_replace(text, "[^0-9]+", "")) >= count


def exact_length(count: int) -> Callable[[Column], Column]:
    return lambda text: F.length(text) == count
