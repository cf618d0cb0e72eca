import re

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, AS_OF_TS, plan_of
from tablegauge import (
    DistinctCount,
    Suite,
    count_where,
    dq_summary,
    not_null,
    period_drop_pct,
    period_drop_summary,
    surplus_rows,
    unique,
    violating_rows,
)
from tablegauge.operators.rows import row_checks
from tablegauge.plans.audits import TABLES, table_suite
from tablegauge.sources.sample_tables import SampleTables

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table", TABLES)
def test_broken_rows_add_up_to_the_summary(spark, table):
    tables = SampleTables(spark, SF_DIR)
    df, suite = getattr(tables, table), table_suite(tables, table, AS_OF_TS)
    rows = violating_rows(df, suite)
    assert "Exchange" not in plan_of(rows)
    counted = rows.select(F.explode("broken_checks").alias("name")).groupBy("name").count().collect()
    got = {r["name"]: r["count"] for r in counted}
    summary = {r.check_name: r.check_value for r in dq_summary(df, suite).collect()}
    names = row_checks(suite)
    assert got == {n: summary[n] for n in names if summary[n]} and got
    assert not {"UNQ_PK", "UNQ_PERSON_ID", "REQ_PERSON_ID_EXISTS", "THR_RECORD_DROP_PCT"} & set(names)


def test_odd_names_and_nulls_of_broken_rows(spark):
    df = spark.createDataFrame([("D", 1, None), ("D", None, None), (None, 2, 3)], "decision_id string, a int, b int")
    suite = Suite("T", (count_where("a, `b`.c", F.col("a") > 1), not_null("x", "a"), not_null("Y", "b")), scope=F.col("decision_id").isNotNull())
    rows = {(r.a, tuple(r.broken)) for r in violating_rows(df, suite, column="broken").collect()}
    assert rows == {(1, ("Y",)), (None, ("x", "Y"))}
    assert violating_rows(df.limit(0), suite).count() == 0
    with pytest.raises(ValueError, match="already"):
        violating_rows(df, suite, column="a")
    with pytest.raises(ValueError, match="no check that judges"):
        violating_rows(df, Suite("T", (unique("U", DistinctCount(("a",))),)))


def test_surplus_rows_are_all_but_the_first_of_a_key(spark):
    rows = [("k", 2, "x"), ("k", 1, "y"), ("k", 1, "y"), ("l", 5, None), (None, 7, "z"), (None, 7, "z"), ("m", None, "a"), ("m", 3, "b")]
    df = spark.createDataFrame(rows, "key string, `o.rank` int, piece string").repartition(3)
    got = sorted(map(tuple, surplus_rows(df, "key").collect()), key=str)
    assert got == sorted([("k", 2, "x"), ("k", 1, "y"), (None, 7, "z"), (None, 7, "z"), ("m", 3, "b")], key=str)
    last = surplus_rows(df, "key", first=[-F.col("`o.rank`")], salts=1)
    assert sorted(r[1] for r in last.collect() if r.key == "k") == [1, 1]
    assert surplus_rows(df, "key", scope=F.col("key") == "l").count() == 0
    assert surplus_rows(df.limit(0), "key").columns == df.columns


@pytest.mark.parametrize("salts", [1, 7])
def test_a_hot_key_is_ranked_by_many_tasks(spark, salts):
    df = spark.range(0, 30_000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS key", "id")
    rows = surplus_rows(df, "key", salts=salts)
    assert rows.count() == 9_999
    assert rows.agg(F.min("id")).first()[0] == 3  # the first one, 0, stays out
    plan = plan_of(rows)
    # Both windows are dealt by the key and by a piece: a hot key has one task per piece.
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and "piece" in dealt[1] and re.search(r"partitioning\(key#\d+, _w0#", dealt[0])
    pieces = df.withColumn("piece", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    widest = pieces.filter("key = 'hot'").groupBy("piece").count().agg(F.max("count")).first()[0]
    assert widest <= 10_000 // salts + 10


def test_a_drop_reads_two_day_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    days = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'A' WHEN id % 3 = 1 THEN 'B' ELSE 'C' END AS decision_id",
        "DATE '2024-01-20' + CAST(id * id % 12 AS INT) AS business_date",
        "id",
    )
    days = days.filter("decision_id <> 'C' OR business_date < '2024-01-25'")
    days.write.partitionBy("decision_id", "business_date").parquet(path)
    df = spark.read.parquet(path)
    suite = Suite("DAYS", (period_drop_pct("DROP", "business_date", AS_OF),))
    want = sorted(map(tuple, dq_summary(df, suite).collect()))
    found = period_drop_summary(df, "DROP", "business_date", AS_OF, table_name="DAYS")
    assert sorted(map(tuple, found.collect())) == want and len(want) == 3
    assert "business_date#" in plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    listed = spark.createDataFrame([("A",), ("B",), ("C",)], "decision_id string")
    again = period_drop_summary(df, "DROP", "business_date", AS_OF, table_name="DAYS", decisions=listed)
    assert sorted(map(tuple, again.collect())) == want
    # Of the day's files nothing but two days is opened: others may be broken.
    for broken in (tmp_path / "days").glob("decision_id=*/business_date=2024-01-2[0-8]/*.parquet"):
        broken.write_bytes(b"broken")
        broken.with_name(f".{broken.name}.crc").unlink(missing_ok=True)
    assert sorted(map(tuple, again.collect())) == want
