"""Table profile: one row per decision and check."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions import as_column, within
from tablegauge.operators.checks import Check, DistinctCount, Measure, OrphanCount, RowCount, Suite
from tablegauge.operators.key_filter import check_types, filter_words, with_possible, words_for
from tablegauge.operators.tagged import Tags

# The JVM leaves methods beyond 8000 bytes interpreted, and the generated method of an aggregate
# grows by 150 to 350 bytes per counter.
COUNTS_PER_AGGREGATE = 20


def reference_keys(reference: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL keys, under a name that cannot clash with the profiled table."""
    keys = reference.select(F.col(column).alias("_reference_key"))
    return keys.filter(F.col("_reference_key").isNotNull()).distinct()


def thinned_keys(reference: DataFrame, column: str) -> DataFrame:
    """Non-NULL reference keys, each at most once per partition of the reference.

    Enough to take the weight out of a hot key. A plain distinct would go further, but its final
    aggregate sits between shuffle and join, where adaptive execution no longer splits skew.
    """
    keys = reference.select(F.col(column).alias("_reference_key"))
    return (
        keys.filter(F.col("_reference_key").isNotNull())
        .withColumn("_partition", F.spark_partition_id())
        .distinct()
        .select("_reference_key")
    )


def _orphans(df: DataFrame, by: str, orphan: OrphanCount, name: str) -> DataFrame:
    """Orphaned rows per decision; decisions without any are left out.

    Rows are counted per key before they move, so a key that holds a third of the table reaches the
    join as one row per decision. With decisions as fine as the rows it still is a hot key there;
    both sides of the anti join are plain exchanges, so adaptive execution splits it. The filter
    on the partition is always true. It is there because the optimizer pushes an anti join below
    the count as soon as the reference looks small enough to broadcast, and if that turns out wrong,
    all rows of a hot key are shuffled to one task; it pushes nothing below an expression that is not
    deterministic.
    """
    key = as_column(orphan.column)
    rows = df.filter(within(orphan.scope, key.isNotNull()))
    if orphan.prefilter:
        rows = _possible_keys(rows.select(F.col(by).alias(by), key.alias("_key")), orphan)
        key = F.col("_key")
    per_key = rows.groupBy(by, key.alias("_key")).agg(F.count("*").alias("_rows"))
    return orphans_of_keys(per_key.filter(F.spark_partition_id() >= 0), by, orphan, name)


def orphans_of_keys(per_key: DataFrame, by: str, orphan: OrphanCount, name: str) -> DataFrame:
    """Orphaned rows per decision, for rows counted per decision and `_key`."""
    known = thinned_keys(orphan.reference, orphan.reference_column).hint("merge")
    return (
        per_key.join(known, F.col("_key") == F.col("_reference_key"), "left_anti")
        .groupBy(by)
        .agg(F.sum("_rows").alias(name))
    )


def _possible_keys(rows: DataFrame, orphan: OrphanCount) -> DataFrame:
    """`rows` in which a `_key` that is certainly an orphan is NULL.

    A NULL matches no reference key, and those of a decision are one group, so the certain orphans of a task
    leave it as one row per decision. A job at once estimates the keys of the reference.
    """
    reference, column = orphan.reference, orphan.reference_column
    check_types(rows.schema["_key"].dataType, reference.schema[column].dataType)
    keys = reference.agg(F.approx_count_distinct(F.col(column))).first()[0] or 0
    words = words_for(keys)
    filled = filter_words(reference, column, words)
    return with_possible(rows, F.col("_key"), filled, words, "_key")


def holds_null(orphan: OrphanCount) -> bool:
    """Whether the reference has a NULL: a job that stops at the first one."""
    column = F.col(orphan.reference_column)
    return not orphan.reference.select(column).filter(column.isNull()).isEmpty()


def measure(
    df: DataFrame, by: str, measures: dict[Measure, str], one_scan: bool = False
) -> DataFrame:
    """One row per decision with a column per measure.

    With `one_scan` row counts and distinct counts come from one scan of tagged rows (see `tagged`). Else
    row counts share an aggregate whose shuffle carries a row per decision and task (suites too large for
    one generated method spread them over several scans), and each distinct count is an aggregate of its own
    over its key columns. Plain counters beside a distinct count would be dragged through the shuffle of the
    keys. Each orphan count is an aggregate of its own. The branches meet in a union that is already
    partitioned by decision, which also keeps the NULL decision together.

    For a null-aware foreign key a job runs at once, which asks for a NULL in the reference (once for
    all such checks on one reference). If there is one, no row can be an orphan and neither table is
    read for it.
    """
    counts = [m.aggregate().alias(name) for m, name in measures.items() if isinstance(m, RowCount)]
    one_scan = one_scan and any(isinstance(m, DistinctCount) for m in measures)
    if one_scan:
        tags = Tags({m: n for m, n in measures.items() if not isinstance(m, OrphanCount)})
        branches = [tags.merged(tags.counted(df, [F.col(by)]), by)]
    else:
        branches = [
            df.groupBy(by).agg(*counts[i : i + COUNTS_PER_AGGREGATE])
            for i in range(0, len(counts), COUNTS_PER_AGGREGATE)
        ]
    nulls: dict[tuple[int, str], bool] = {}
    zero = []
    for m, name in measures.items():
        if isinstance(m, OrphanCount) and m.mode == "null_aware":
            reference = (id(m.reference), m.reference_column)
            if reference not in nulls:
                nulls[reference] = holds_null(m)
            if nulls[reference]:
                zero.append(name)
                continue
        if isinstance(m, DistinctCount) and not one_scan:
            branches.append(df.groupBy(by).agg(m.aggregate().alias(name)))
        elif isinstance(m, OrphanCount):
            branches.append(_orphans(df, by, m, name))
    if not any(isinstance(m, RowCount | DistinctCount) for m in measures):
        # Orphan branches leave out decisions without keys; this one brings them back with a zero.
        branches.append(df.groupBy(by).agg(F.count("*").alias("_volume")))
    zeros = [F.lit(0).cast("bigint").alias(name) for name in zero]
    if len(branches) == 1:
        return branches[0].select("*", *zeros)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    found = [name for name in measures.values() if name not in zero]
    return (
        stacked.groupBy(by)
        .agg(*[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in found])
        .select("*", *zeros)
    )


def _value(check: Check, names: dict[Measure, str]) -> Column:
    columns = {role: F.col(names[m]) for role, m in check.measures.items()}
    return check.formula(**columns).cast("double")


def metric_rows(
    wide: DataFrame,
    ids: list[str],
    metrics: dict[str, str],
    name_column: str,
    value_column: str,
    keep_null_metrics: bool,
) -> DataFrame:
    """Turn metric columns into rows. A NULL metric yields no row unless asked for.

    `metrics` gives the column of each metric name. Names go into rows as literals and never name a
    column, so any text will do.
    """
    pairs = [
        F.struct(F.lit(name).alias(name_column), F.col(column).alias(value_column))
        for name, column in metrics.items()
    ]
    rows = wide.select(*ids, F.inline(F.array(*pairs)))
    return rows if keep_null_metrics else rows.filter(F.col(value_column).isNotNull())


def dq_summary(
    df: DataFrame,
    suite: Suite,
    *,
    emit_metadata: bool | None = None,
    keep_null_metrics: bool = False,
    one_scan: bool = True,
) -> DataFrame:
    """(decision_id, table_name, check_name, check_value) for every check of the suite.

    `one_scan=False` gives row counts and each distinct count a column-pruned scan of its own.
    """
    checks = selected_checks(suite, emit_metadata)
    names = measure_names(checks)
    base = df if suite.scope is None else df.filter(suite.scope)
    wide = measure(base, suite.by, names, one_scan)
    return check_rows(wide, suite, checks, names, keep_null_metrics)


def selected_checks(suite: Suite, emit_metadata: bool | None = None) -> tuple[Check, ...]:
    """The checks of a suite, with its metadata if they are shown."""
    shown = suite.emit_metadata if emit_metadata is None else emit_metadata
    return suite.checks + (suite.metadata if shown else ())


def measure_names(checks: Iterable[Check]) -> dict[Measure, str]:
    """A column name for each measure of the checks."""
    measures = dict.fromkeys(m for check in checks for m in check.measures.values())
    return {m: f"_m{i}" for i, m in enumerate(measures)}


def check_rows(
    measured: DataFrame,
    suite: Suite,
    checks: tuple[Check, ...],
    names: dict[Measure, str],
    keep_null_metrics: bool,
) -> DataFrame:
    """Summary rows out of one row of measures per decision."""
    columns = {check.name: f"_v{i}" for i, check in enumerate(checks)}
    wide = measured.select(
        F.col(suite.by).cast("string").alias("decision_id"),
        *[_value(check, names).alias(columns[check.name]) for check in checks],
    )
    rows = metric_rows(
        wide, ["decision_id"], columns, "check_name", "check_value", keep_null_metrics
    )
    return rows.select(
        "decision_id", F.lit(suite.table_name).alias("table_name"), "check_name", "check_value"
    )
