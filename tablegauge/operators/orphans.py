"""The rows behind a foreign-key violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions import as_column, within
from tablegauge.operators.summary import reference_keys, thinned_keys

BROADCAST_BYTES = 64 * 1024 * 1024
# What a broadcast key takes beside its own bytes, rounded up.
BYTES_PER_KEY = 100


# approx_count_distinct errs by 5 percent in one case of three; four times that is not seen.
MARGIN = 1.2


def _fits_broadcast(reference: DataFrame, column: str, limit: int) -> bool:
    """Estimate the distinct keys: file sizes are compressed and prove nothing about memory.

    One pass and one row per task; no key moves. The widest key stands for all.
    """
    key = F.col(column)
    width = F.max(F.octet_length(key.cast("string")))
    size = reference.agg(F.approx_count_distinct(key) * MARGIN * (width + BYTES_PER_KEY)).first()[0]
    return (size or 0) <= limit


def orphan_rows(
    df: DataFrame,
    column: str | Column,
    reference: DataFrame,
    reference_column: str,
    *,
    scope: Column | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows whose non-NULL key is absent from the reference.

    Runs one job at once, which estimates the size of the reference keys. Up to `broadcast_bytes` they are
    broadcast and no row of `df` moves. Beyond, whole rows are shuffled by key. A hot key then
    lands in one partition of the left side, which adaptive execution splits over several tasks.
    """
    key = as_column(column)
    rows = df.filter(within(scope, key.isNotNull()))
    if _fits_broadcast(reference, reference_column, broadcast_bytes):
        known = F.broadcast(reference_keys(reference, reference_column))
    else:
        known = thinned_keys(reference, reference_column).hint("merge")
    return rows.join(known, key == F.col("_reference_key"), "left_anti")
