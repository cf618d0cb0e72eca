"""Audits that keep counts for each part of a table."""

import pytest
from pyspark.sql import functions as F

from helpers import keys_frame
from tablegauge import (
    DistinctCount,
    RowCount,
    Suite,
    count_where,
    deactivated_pct,
    dq_summary,
    foreign_key,
    not_null,
    refresh_states,
    summary_of_states,
    unique,
)
from tablegauge.operators.states import fingerprint


@pytest.fixture
def table(spark, tmp_path):
    """Parts of a table, written one by one."""
    path = str(tmp_path / "table")

    def add(day, low, high):
        rows = spark.range(low, high).selectExpr(
            "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS decision_id",
            "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 40 AS STRING) END AS key",
            "id % 7 AS n",
            "CASE WHEN id % 13 = 0 THEN DOUBLE('NaN') WHEN id % 3 = 0 THEN -0.0D ELSE CAST(id % 2 AS DOUBLE) END AS amount",
        ).withColumn("day", F.lit(day).cast("date"))
        rows.write.mode("append").partitionBy("day").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return add


def _suite(spark, mode="anti", limit=3):
    known = keys_frame(spark, [str(i) for i in range(25)]).select("key")
    volume = RowCount()
    return Suite(
        "T",
        (
            not_null("NO_KEY", "key"),
            count_where("LARGE", F.col("n") > limit),
            unique("UNQ", DistinctCount(("key", "n")), volume),
            unique("UNQ_AMOUNT", DistinctCount(("amount",), F.col("n") < 5)),
            foreign_key("KNOWN", "key", known, "key", mode=mode, scope=F.col("n") > 0),
            deactivated_pct("PCT", F.col("n") == 0, volume),
        ),
        scope=F.col("n") != 6,
    )


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("catalog", [False, True])
@pytest.mark.parametrize("mode", ["anti", "null_aware"])
def test_states_of_parts_add_up_to_the_audit(spark, table, tmp_path, catalog, mode):
    target = "part_states" if catalog else str(tmp_path / "states")
    suite = _suite(spark, mode)
    try:
        table("2024-01-01", 0, 500)
        df = table("2024-01-02", 300, 900)
        assert refresh_states(df, suite, target, "day") == ["2024-01-01", "2024-01-02"]
        assert _rows(summary_of_states(spark, target, suite, "day")) == _rows(dq_summary(df, suite))
        df = table(None, 1000, 1300)
        table("2024-01-04", 0, 50)
        df = spark.read.schema(df.schema).parquet(str(tmp_path / "table"))
        assert refresh_states(df, suite, target, "day") == ["2024-01-04", None]
        assert refresh_states(df, suite, target, "day") == []
        assert _rows(summary_of_states(spark, target, suite, "day")) == _rows(dq_summary(df, suite))
        # Late rows of a day: that day is counted again.
        table("2024-01-02", 5000, 5100)
        df = spark.read.schema(df.schema).parquet(str(tmp_path / "table"))
        assert refresh_states(df, suite, target, "day", again=["2024-01-02"]) == ["2024-01-02"]
        assert _rows(summary_of_states(spark, target, suite, "day")) == _rows(dq_summary(df, suite))
    finally:
        spark.sql("DROP TABLE IF EXISTS part_states")


def test_a_second_audit_reads_new_parts_only(spark, table, tmp_path):
    target, suite = str(tmp_path / "states"), _suite(spark)
    df = table("2024-01-01", 0, 500)
    refresh_states(df, suite, target, "day")
    want = _rows(dq_summary(df, suite))
    for part in (tmp_path / "table" / "day=2024-01-01").glob("*.parquet"):
        footer = part.read_bytes()
        # The footer stays, so the part is still listed; none of its values can be read.
        part.write_bytes(b"PAR1" + bytes(len(footer) - 4 - 8 - int.from_bytes(footer[-8:-4], "little")) + footer[-8 - int.from_bytes(footer[-8:-4], "little") :])
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert _rows(summary_of_states(spark, target, suite, "day")) == want
    df = table("2024-01-02", 500, 700)
    assert refresh_states(df, suite, target, "day") == ["2024-01-02"]
    summary = summary_of_states(spark, target, suite, "day")
    assert {r.check_name for r in summary.collect()} == {c.name for c in suite.checks}
    assert all("/states/" in f for f in summary.inputFiles() if "table" in f.split("/"))


def test_states_of_another_suite_are_not_used(spark, table, tmp_path):
    target, df = str(tmp_path / "states"), table("2024-01-01", 0, 500)
    suite, other = _suite(spark), _suite(spark, limit=2)
    assert fingerprint(suite, "day") == fingerprint(_suite(spark), "day") != fingerprint(other, "day")
    refresh_states(df, suite, target, "day")
    assert refresh_states(df, other, target, "day") == ["2024-01-01"]
    for s in (suite, other):
        assert _rows(summary_of_states(spark, target, s, "day")) == _rows(dq_summary(df, s))


def test_one_scan_equals_a_scan_for_each(spark, table):
    """NULL decisions, NaN and both zeros as keys, many predicates, names that the tags use too."""
    df = table("2024-01-01", 0, 3000).withColumns({"_tag": F.col("n"), "_n": F.col("key")})
    checks = tuple(count_where(f"C{i}", F.col("n") % (i + 1) == 0) for i in range(45))
    for by in ("decision_id", "_tag", "_n"):
        suite = Suite("T", (*checks, *_suite(spark).checks), by=by)
        assert _rows(dq_summary(df, suite)) == _rows(dq_summary(df, suite, one_scan=False))
    empty = Suite("T", _suite(spark).checks)
    assert _rows(dq_summary(df.limit(0), empty)) == []
