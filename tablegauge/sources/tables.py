"""Reading tables to profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, name_or_path: str, format: str = "parquet") -> DataFrame:
    """A catalog table (`db.schema.table`), or files when the name is a path."""
    if "/" in name_or_path:
        return spark.read.format(format).load(name_or_path)
    return spark.table(name_or_path)
