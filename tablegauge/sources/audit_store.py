"""Audit tables, as files under a path or as catalog tables: plain appends, and runs that own partitions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class RunRecorded(ValueError):
    """The audit holds rows of this run already."""


def is_path(target: str) -> bool:
    """Whether a target names files; any other is a catalog table (`db.schema.table`)."""
    return "/" in target


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, in its order and types; a NULL in a required column fails the job.

    Spark accepts NULLs in required parquet columns, so the check is part of the write plan.
    """

    def column(f: T.StructField):
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            missing = F.raise_error(F.lit(f"{f.name} must not be NULL")).cast(f.dataType)
            value = F.when(value.isNull(), missing).otherwise(value)
        return value.alias(f.name)

    return df.select(*[column(f) for f in schema])


def append_audit(
    df: DataFrame, path: str, schema: T.StructType, partition_by: str | None = None
) -> None:
    """Append audit rows as parquet files; earlier runs stay as they are.

    One writer at a time: file appends that commit to the same path at once disturb each other.
    """
    writer = conform(df, schema).write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_audit(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def create_audit_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create a catalog table for audit rows unless it exists. History is never wiped."""
    spark.createDataFrame([], schema).write.format("parquet").mode("ignore").saveAsTable(name)


def append_audit_table(df: DataFrame, name: str, schema: T.StructType) -> None:
    """Append audit rows to a catalog table."""
    conform(df, schema).write.format("parquet").mode("append").saveAsTable(name)


def partition_columns(target: str, spark: SparkSession) -> list[str]:
    """The columns that a catalog table is partitioned by."""
    return [c.name for c in spark.catalog.listColumns(target) if c.isPartition]


def partition_names(
    spark: SparkSession, target: str, within: Mapping[str, str] | None = None
) -> list[list[tuple[str, str | None]]]:
    """(column, value) of the partitions under the partition `within`, from names alone.

    Of a path one level is listed, that of the folders under `within`; of a catalog table whole names.
    """
    above = list((within or {}).items())
    if is_path(target):
        jvm = spark.sparkContext._jvm
        folder = "/".join([target.rstrip("/"), *(f"{c}={v}" for c, v in above)])
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        found = [[f.getPath().getName()] for f in files.listStatus(path) if f.isDirectory()]
        prefix = [f"{c}={v}" for c, v in above]
        found = [prefix + names for names in found]
    elif spark.catalog.tableExists(target):
        found = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
    else:
        return []
    pairs = [[tuple(name.split("=", 1)) for name in names if "=" in name] for names in found]
    return [[(c, None if v == _NULL_PARTITION else unquote(v)) for c, v in names] for names in pairs if names]


#: Fixed value: the folder of a NULL.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Run:
    """What a run writes: one partition for each name (a table that was audited).

    `day` and `stamp` come from the run's clock, not from data, so the partitions of a run are known before
    the audit is computed, and a rerun finds them again.
    """

    moment: datetime
    names: tuple[str, ...]
    name_column: str
    day_column: str

    @property
    def day(self) -> date:
        return self.moment.date()

    @property
    def stamp(self) -> str:
        return self.moment.strftime("%Y%m%d%H%M%S%f")

    @property
    def partition_by(self) -> list[str]:
        return [self.day_column, RUN_COLUMN, self.name_column]

    def rows(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Conforming rows with the partition columns last, as partitioned tables have them."""
        rows = conform(df, schema).withColumn(RUN_COLUMN, F.lit(self.stamp))
        if self.day_column not in schema.fieldNames():
            rows = rows.withColumn(self.day_column, F.lit(self.day))
        plain = [c for c in rows.columns if c not in self.partition_by]
        return rows.select(*plain, *self.partition_by)


#: Partition column of a run's clock.
RUN_COLUMN = "audit_run"

RERUN = ("refuse", "replace")


def recorded(spark: SparkSession, target: str, run: Run) -> DataFrame:
    """The names of the run that the audit holds rows of; reads the run's partitions only.

    Of files, no more than the day's folder is listed.
    """
    schema = T.StructType(
        [
            T.StructField(run.day_column, T.DateType()),
            T.StructField(RUN_COLUMN, T.StringType()),
            T.StructField(run.name_column, T.StringType()),
        ]
    )
    if is_path(target):
        day = f"{target.rstrip('/')}/{run.day_column}={run.day.isoformat()}"
        held = spark.read.schema(schema).option("basePath", target).parquet(day)
    else:
        held = spark.table(target)
    mine = (F.col(RUN_COLUMN) == run.stamp) & F.col(run.name_column).isin(*run.names)
    return held.filter((F.col(run.day_column) == F.lit(run.day)) & mine).select(run.name_column)


def _missing(problem: AnalysisException) -> bool:
    return problem.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def record_run(
    df: DataFrame, target: str, schema: T.StructType, run: Run, rerun: str = "refuse"
) -> None:
    """Write the audit rows of a run to a path or catalog table, once.

    A run owns its partitions. Where the audit holds rows of it already, `refuse` raises `RunRecorded`
    before anything is computed, and `replace` puts the new rows in place of the old. Either way the write
    overwrites just the partitions it fills, each through a staging folder of its own: writers of different
    runs do not disturb each other, and of writers of the same run that get past the test together the last
    one's rows stand, once. Plain files know no locks, so such writers should still not commit a partition in
    the very same moment. A rerun that finds no rows for a table leaves that table's earlier rows.
    """
    if rerun not in RERUN:
        raise ValueError(f"rerun must be one of {RERUN}, not {rerun!r}")
    spark = df.sparkSession
    if rerun == "refuse":
        try:
            again = recorded(spark, target, run).first()
        except AnalysisException as problem:
            if not _missing(problem):
                raise
            again = None
        if again is not None:
            raise RunRecorded(f"{target} holds rows of {again[0]} of {run.moment} already")
    overwrite_partitions(run.rows(df, schema), target, run.partition_by)


def overwrite_partitions(rows: DataFrame, target: str, partition_by: list[str]) -> None:
    """Replace the partitions that `rows` fill; others stay. The partition columns come last."""
    spark = rows.sparkSession
    if is_path(target):
        writer = rows.write.mode("overwrite").partitionBy(*partition_by)
        writer.option("partitionOverwriteMode", "dynamic").parquet(target)
        return
    empty = spark.createDataFrame([], rows.schema).write.format("parquet").mode("ignore")
    empty.partitionBy(*partition_by).saveAsTable(target)
    if partition_columns(target, spark) != partition_by:
        raise ValueError(f"{target} is not partitioned by {', '.join(partition_by)}")
    option = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(option)
    spark.conf.set(option, "dynamic")
    try:
        rows.write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(option, before)
