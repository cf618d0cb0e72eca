"""Helpers shared by the operators: intermediate tables, row keys, words."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parents[1]


#: Work folders of applications without spark.checkpoint.dir.
_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where it is unset, a temporary folder in local mode (one machine) and one in the warehouse elsewhere; it
    is made once per application.
    """
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    context = spark.sparkContext
    if context.applicationId not in _OWN_DIRS:
        one_machine = context.master.startswith("local") and not context.master.startswith("local-cluster")
        work = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        _OWN_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="tablegauge-") if one_machine else work
    return _OWN_DIRS[context.applicationId]


def saved(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The most that a side may take to be broadcast.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, row_bytes: Column | int) -> DataFrame:
    """`df` with a broadcast hint if its measured size allows it; runs one small job over a written table."""
    size = df.agg(F.sum(F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to Python workers that have no path to it, once per session."""
    if any("tablegauge-src" in name for name in spark.sparkContext._python_includes):
        return
    target = Path(tempfile.mkdtemp(prefix="tablegauge-")) / "tablegauge-src.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(str(target))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def boxed(docs: DataFrame, **extra: Column) -> DataFrame:
    """All columns of `docs` as one, named row, beside `extra`: no name of the table can clash with an inner one."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), *[value.alias(name) for name, value in extra.items()])


def text_keys(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that together name a text."""
    return [F.xxhash64(F.lit(17), text).alias("k1"), F.xxhash64(F.lit(29), text).alias("k2")]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
