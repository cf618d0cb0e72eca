"""Check kinds and the measures they are computed from.

A check is a formula over measures. There are three measures, because they need three
different data movements (see `summary.measure`):

* `RowCount`      - rows where a predicate holds; map-side combined, nothing else to shuffle
* `DistinctCount` - distinct non-NULL keys; shuffles only the key columns
* `OrphanCount`   - rows whose key is missing from a reference; shuffles per-key counts

Measures compare by identity. Passing the same object to several checks (a uniqueness check
and a percentage over the same keys) computes it once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions import as_column, percentage, within

FK_MODES = ("null_aware", "anti")


@dataclass(frozen=True, eq=False)
class RowCount:
    """Rows where `predicate` is true; all rows without one. A NULL predicate is not counted."""

    predicate: Column | None = None

    def aggregate(self) -> Column:
        return F.count("*") if self.predicate is None else F.count_if(self.predicate)


@dataclass(frozen=True, eq=False)
class DistinctCount:
    """Distinct keys among the rows of `scope`. A key with any NULL part is not counted."""

    columns: tuple[str | Column, ...]
    scope: Column | None = None

    def aggregate(self) -> Column:
        keys = [as_column(c) for c in self.columns]
        if self.scope is not None:
            keys = [F.when(self.scope, key) for key in keys]
        return F.count_distinct(*keys)


@dataclass(frozen=True, eq=False)
class OrphanCount:
    """Rows whose non-NULL key does not occur in the reference.

    `null_aware` keeps SQL `NOT IN` semantics: one NULL in the reference makes every unmatched
    comparison unknown, so the count is 0. `anti` ignores NULLs in the reference.

    `prefilter` puts a Bloom filter of the reference before the shuffle: keys that fail it are counted as
    orphans where they are read. It pays where many keys are orphans, as otherwise all keys pass it.
    """

    column: str | Column
    reference: DataFrame
    reference_column: str
    mode: str = "anti"
    scope: Column | None = None
    prefilter: bool = False

    def __post_init__(self) -> None:
        if self.mode not in FK_MODES:
            raise ValueError(f"mode must be one of {FK_MODES}, not {self.mode!r}")


Measure = RowCount | DistinctCount | OrphanCount


@dataclass(frozen=True, eq=False)
class Check:
    name: str
    measures: Mapping[str, Measure]
    formula: Callable[..., Column]


@dataclass(frozen=True)
class Suite:
    """The checks of one table.

    `scope` drops rows before anything is measured. `metadata` are extra summary rows (volume,
    key count) that are never graded; `emit_metadata` says whether the summary shows them.
    """

    table_name: str
    checks: tuple[Check, ...]
    scope: Column | None = None
    metadata: tuple[Check, ...] = ()
    emit_metadata: bool = False
    by: str = "decision_id"

    def __post_init__(self) -> None:
        if not self.checks:
            raise ValueError(f"the suite of {self.table_name} has no checks")
        names = [check.name for check in self.checks + self.metadata]
        repeated = {name for name in names if names.count(name) > 1}
        if repeated:
            raise ValueError(f"check names must be unique, repeated: {sorted(repeated)}")


def measured(name: str, measure: Measure) -> Check:
    """A check whose value is one measure."""
    return Check(name, {"value": measure}, lambda value: value)


def _any_null(columns: tuple[str | Column, ...]) -> Column:
    return reduce(or_, (as_column(c).isNull() for c in columns))


def not_null(name: str, *columns: str | Column, scope: Column | None = None) -> Check:
    """Rows where any of the columns is NULL."""
    return measured(name, RowCount(within(scope, _any_null(columns))))


def unique(name: str, keys: DistinctCount, rows: RowCount | None = None) -> Check:
    """Rows beyond the distinct keys. A NULL key is no distinct key, so it counts as surplus."""
    return Check(
        name,
        {"rows": rows or RowCount(keys.scope), "keys": keys},
        lambda rows, keys: F.greatest(rows - keys, F.lit(0)),
    )


def foreign_key(
    name: str,
    column: str | Column,
    reference: DataFrame,
    reference_column: str,
    *,
    mode: str = "anti",
    scope: Column | None = None,
    prefilter: bool = False,
) -> Check:
    """Rows whose non-NULL key is absent from the reference; `prefilter` as in `OrphanCount`."""
    measure = OrphanCount(column, reference, reference_column, mode, scope, prefilter)
    return measured(name, measure)


def ordered(
    name: str, first: str | Column, second: str | Column, *, scope: Column | None = None
) -> Check:
    """Rows where both values are set and the first is after the second."""
    first, second = as_column(first), as_column(second)
    return measured(
        name, RowCount(within(scope, first.isNotNull() & second.isNotNull() & (first > second)))
    )


def min_age(
    name: str, born: str | Column, years: int, as_of: date, *, scope: Column | None = None
) -> Check:
    """Rows younger than `years` by calendar-year difference, which is not the exact age."""
    born = as_column(born)
    too_young = F.year(F.lit(as_of)) - F.year(born) < years
    return measured(name, RowCount(within(scope, born.isNotNull() & too_young)))


def required_when(
    name: str, condition: Column, column: str | Column, *, scope: Column | None = None
) -> Check:
    """Rows where the condition holds and the column is NULL."""
    return measured(name, RowCount(within(scope, condition & as_column(column).isNull())))


def matches(
    name: str,
    column: str | Column,
    rule: Callable[[Column], Column],
    *,
    guard: Column | None = None,
    scope: Column | None = None,
) -> Check:
    """Rows with a value that breaks the rule, where the guard holds."""
    column = as_column(column)
    broken = column.isNotNull() & ~rule(column)
    return measured(name, RowCount(within(scope, within(guard, broken))))


def count_where(name: str, condition: Column, *, scope: Column | None = None) -> Check:
    """Rows where the condition holds."""
    return measured(name, RowCount(within(scope, condition)))


def deactivated_pct(name: str, condition: Column, denominator: Measure) -> Check:
    """Rows where the condition holds, as a percentage of another measure."""
    return Check(name, {"part": RowCount(condition), "whole": denominator}, percentage)


def period_drop_pct(name: str, day: str | Column, as_of: date) -> Check:
    """Fall in rows from two days before `as_of` to the day before; negative when rows grew."""
    day = as_column(day)
    return Check(
        name,
        {
            "before": RowCount(day == F.date_sub(F.lit(as_of), 2)),
            "after": RowCount(day == F.date_sub(F.lit(as_of), 1)),
        },
        lambda before, after: percentage(before - after, before),
    )


def coverage_gap_pct(
    name: str,
    column: str | Column,
    updated: str | Column,
    as_of: date,
    denominator: Measure,
    *,
    scope: Column | None = None,
) -> Check:
    """Rows updated on or after `as_of` that lack the value, as a percentage of a measure."""
    gap = (as_column(updated) >= F.lit(as_of)) & as_column(column).isNull()
    return Check(name, {"part": RowCount(within(scope, gap)), "whole": denominator}, percentage)
