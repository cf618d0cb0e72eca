"""Small frames made from Python rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW_TYPES = {
    T.StringType(): pa.string(),
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.DateType(): pa.date32(),
    T.TimestampNTZType(): pa.timestamp("us"),
}


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame whose size the optimizer knows.

    From Arrow, Spark plans a local relation with exact statistics. From a list it plans an RDD
    of unknown size, which it would never choose to broadcast.
    """
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(c, type=_ARROW_TYPES[f.dataType]) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.fieldNames()), schema)
