"""Config tables on plain files: every write of a version is whole or is not there.

Parquet tables know no UPDATE, and a job must not overwrite what it reads. A change therefore
writes the whole (small) table under the next version number. Each row carries the id of its write
and the number of rows of that write. Readers accept a write only when it has that many rows, so
what a writer that died has left behind is never current. Of several whole writes of one version,
the one with the smallest write id counts, for every reader; the other writers learn that they lost.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.sources.audit_store import conform, is_path, partition_columns, partition_names


class Write(NamedTuple):
    """A whole write of a version."""

    version: int
    write_id: str


class VersionConflict(RuntimeError):
    """Another writer has written the same version, and its write counts."""


_MARKS = [T.StructField("row_count", T.LongType())]
_PARTITIONS = [T.StructField("version", T.LongType()), T.StructField("write_id", T.StringType())]


def _versions(spark: SparkSession, target: str) -> list[int]:
    """All version numbers, highest first, from the names of folders or partitions alone."""
    if not is_path(target) and spark.catalog.tableExists(target) and not partition_columns(target, spark):
        # A table that was not made here.
        found = {r[0] for r in spark.table(target).select("version").distinct().collect()}
    else:
        named = (dict(names).get("version") for names in partition_names(spark, target))
        found = {int(v) for v in named if v is not None}
    return sorted(found, reverse=True)


def _writes(spark: SparkSession, target: str, schema: T.StructType, version: int) -> DataFrame:
    """All writes of a version; no file of another version is listed or read."""
    if not is_path(target):
        return spark.table(target).filter(F.col("version") == version)
    whole = T.StructType([*schema, *_MARKS, *_PARTITIONS])
    reader = spark.read.schema(whole).option("basePath", target)
    return reader.parquet(f"{target.rstrip('/')}/version={version}")


def _winner(spark: SparkSession, target: str, schema: T.StructType, version: int) -> Write | None:
    """The write that counts for a version: of the whole ones that of the least id. One small job."""
    writes = _writes(spark, target, schema, version)
    whole = (
        writes.groupBy("version", "write_id")
        .agg(F.count("*").alias("rows"), F.min("row_count").alias("row_count"))
        .filter("rows = row_count")
    )
    first = whole.orderBy("write_id").select("version", "write_id").first()
    return None if first is None else Write(*first)


def _latest(spark: SparkSession, target: str, schema: T.StructType) -> Write | None:
    """The highest version with a whole write, looked for downwards; nearly always the first one."""
    found = (_winner(spark, target, schema, v) for v in _versions(spark, target))
    return next((write for write in found if write is not None), None)


def latest_version(spark: SparkSession, target: str, schema: T.StructType) -> int:
    """The highest version with a whole write."""
    found = _latest(spark, target, schema)
    if found is None:
        raise ValueError(f"{target} holds no whole version of a config table")
    return found.version


def read_config(
    spark: SparkSession, target: str, schema: T.StructType, version: int | None = None
) -> DataFrame:
    """One version of a config table, the latest whole one by default.

    Versions are found by name, so the files of one version are read, however many there are.
    """
    if version is None:
        found = _latest(spark, target, schema)
    else:
        found = _whole(spark, target, schema, version)
    if found is None:
        wanted = "version" if version is None else f"version {version}"
        raise ValueError(f"{target} holds no whole {wanted} of a config table")
    writes = _writes(spark, target, schema, found.version)
    return writes.filter(F.col("write_id") == found.write_id).select(*schema.fieldNames())


def _whole(spark: SparkSession, target: str, schema: T.StructType, version: int) -> Write | None:
    """The write that counts for a version, if there is a whole one."""
    if version not in _versions(spark, target):
        return None
    return _winner(spark, target, schema, version)


def write_config(
    config: DataFrame, target: str, schema: T.StructType, version: int, unique_id: str | None = None
) -> None:
    """Write a new version to a path or a catalog table.

    Raises `VersionConflict` if the version is there already, or if a write of another writer at the
    same time counts. Plain files know no locks: a writer that began before this one ended and commits
    after its last look can still win; readers agree on the winner all the same. Required columns are checked while writing. `unique_id` is checked first, as
    Spark has no primary keys. An empty config is refused: it could not be told from a missing one.
    """
    spark = config.sparkSession
    rows = conform(config, schema)
    if unique_id is not None:
        repeated = rows.groupBy(unique_id).count().filter("count > 1").first()
        if repeated is not None:
            raise ValueError(f"{unique_id} {repeated[unique_id]} occurs {repeated['count']} times")
    n_rows = rows.count()
    if n_rows == 0:
        raise ValueError(f"an empty config is not written to {target}")
    if _whole(spark, target, schema, version) is not None:
        raise VersionConflict(f"version {version} of {target} is there already")
    mine = Write(version, uuid.uuid4().hex)
    marked = rows.withColumn("row_count", F.lit(n_rows).cast("bigint"))
    if is_path(target):
        # A directory of its own: writers of one version do not meet.
        marked.write.parquet(f"{target}/version={version}/write_id={mine.write_id}")
    else:
        marked = marked.withColumn("version", F.lit(version).cast("bigint"))
        marked = marked.withColumn("write_id", F.lit(mine.write_id))
        writer = marked.write.format("parquet").mode("append")
        old = spark.catalog.tableExists(target) and not partition_columns(target, spark)
        (writer if old else writer.partitionBy("version", "write_id")).saveAsTable(target)
    if _winner(spark, target, schema, version) != mine:
        raise VersionConflict(f"version {version} of {target} is another writer's")
