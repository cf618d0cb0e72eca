"""Audits of tables that grow by parts (days, runs): counts are kept for each part and merged on read.

A state holds what a part adds to the measures of a suite: the rows of each combination of predicates, and the
rows of each key of a distinct or orphan count (see `tagged`). These add up exactly, so an audit reads the parts
that are new, and the states of the others. Orphans are judged when states are read, against the reference as
it is then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.functions import as_column
from tablegauge.operators.checks import DistinctCount, Measure, OrphanCount, RowCount, Suite
from tablegauge.operators.summary import (
    check_rows,
    holds_null,
    measure_names,
    orphans_of_keys,
    selected_checks,
)
from tablegauge.operators.tagged import Tags
from tablegauge.sources.audit_store import is_path, overwrite_partitions, partition_names


def _described(measure: Measure) -> str:
    if isinstance(measure, RowCount):
        return f"rows {measure.predicate}"
    keys = measure.columns if isinstance(measure, DistinctCount) else (measure.column,)
    kind = "keys" if isinstance(measure, DistinctCount) else "references"
    return f"{kind} {[str(as_column(k)) for k in keys]} {measure.scope}"


def fingerprint(suite: Suite, part: str) -> str:
    """Names what a state holds: states of a suite that measures anything else are not merged with it."""
    measures = measure_names(selected_checks(suite, True))
    text = "\n".join([suite.by, part, str(suite.scope), *map(_described, measures)])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def refresh_states(
    df: DataFrame, suite: Suite, target: str, part: str, again: Iterable[object] = ()
) -> list[str]:
    """Write the states of the parts of `df` that have none; the parts written.

    `part` is a column, best one that the table is partitioned by: then only new parts are read. `target` is a
    path or catalog table. A part that has changed since is written anew if it is listed in `again`. A part is
    put in place as a whole, so a run that dies leaves parts that are there or are not. Predicates on the
    clock make a new suite of every day, whose states start empty: keep such checks in a suite of their own.
    """
    spark = df.sparkSession
    mark = fingerprint(suite, part)
    text = F.col(part).cast("string")
    there = {row[0] for row in df.select(text).distinct().collect()}
    stored = set(_stored(spark, target, mark)) - {None if a is None else str(a) for a in again}
    new = sorted(there - stored, key=lambda p: (p is None, p or ""))
    if not new:
        return []
    # Compared as the column itself, so that partitions are pruned.
    wanted = [F.lit(p).cast(df.schema[part].dataType) for p in new if p is not None]
    fits = F.col(part).isin(wanted) if wanted else F.lit(False)
    rows = df.filter(fits | F.col(part).isNull() if None in new else fits)
    base = rows if suite.scope is None else rows.filter(suite.scope)
    tags = Tags(measure_names(selected_checks(suite, True)))
    counted = tags.counted(base, [F.col(suite.by), text])
    plain = [c for c in counted.columns if c != "_id1"]
    states = counted.select(*plain, F.lit(mark).alias("state_suite"), F.col("_id1").alias("state_part"))
    overwrite_partitions(states, target, ["state_suite", "state_part"])
    return new


def _stored(spark: SparkSession, target: str, mark: str) -> list[str | None]:
    names = [dict(n) for n in partition_names(spark, target, {"state_suite": mark})]
    return [n["state_part"] for n in names if n.get("state_suite") == mark]


def summary_of_states(
    spark: SparkSession,
    target: str,
    suite: Suite,
    part: str,
    *,
    emit_metadata: bool | None = None,
    keep_null_metrics: bool = False,
) -> DataFrame:
    """What `dq_summary` gives for all parts that have states, without reading the table."""
    names = measure_names(selected_checks(suite, True))
    tags, mark = Tags(names), fingerprint(suite, part)
    if is_path(target):
        stored = spark.read.option("basePath", target).parquet(f"{target.rstrip('/')}/state_suite={mark}")
    else:
        stored = spark.table(target).filter(F.col("state_suite") == mark)
    keys = [p for m in tags.keyed for p in tags.parts(m)]
    merged = stored.groupBy("_id0", "_code", *keys).agg(F.sum("_n").alias("_n"))
    branches = [tags.merged(merged, suite.by)]
    zero = []
    for m in tags.keyed:
        if not isinstance(m, OrphanCount):
            continue
        if m.mode == "null_aware" and holds_null(m):
            zero.append(F.lit(0).cast("bigint").alias(names[m]))
            continue
        rows = stored.filter(tags.carries(m))
        per_key = rows.groupBy(F.col("_id0").alias(suite.by), F.col(tags.parts(m)[0]).alias("_key")).agg(F.sum("_n").alias("_rows"))
        branches.append(orphans_of_keys(per_key.filter(F.spark_partition_id() >= 0), suite.by, m, names[m]))
    wide = branches[0]
    if len(branches) > 1:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
        found = [c for c in stacked.columns if c != suite.by]
        wide = stacked.groupBy(suite.by).agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in found])
    wide = wide.select("*", *zero)
    return check_rows(wide, suite, selected_checks(suite, emit_metadata), names, keep_null_metrics)
