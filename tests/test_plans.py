"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, AS_OF_TS, keys_frame, plan_of
from tablegauge import (
    DistinctCount,
    Suite,
    count_where,
    dq_audit,
    dq_summary,
    foreign_key,
    latest_runs,
    orphan_rows,
    unique,
)
from tablegauge.operators.orphans import _fits_broadcast
from tablegauge.plans import suites
from tablegauge.plans.registry import QUERIES
from tablegauge.sources.sample_tables import SampleTables
from tablegauge.sources.seeds import seed_thresholds

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = []

    def set_options(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.append(key)
            spark.conf.set(key, value)

    yield set_options
    for key in changed:
        spark.conf.unset(key)


@pytest.fixture
def stored(spark, tmp_path):
    """The sample tables as files, so that plans show real column scans."""
    tables = SampleTables(spark, SF_DIR)
    for name in ("spine", "xref", "contact"):
        getattr(tables, name).write.parquet(str(tmp_path / name))

    class Stored:
        pass

    for name in ("spine", "xref", "contact"):
        setattr(Stored, name, spark.read.parquet(str(tmp_path / name)))
    return Stored


def scans(plan):
    return [s.split(",") for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cross_join(spark, conf, name, broadcast):
    conf(autoBroadcastJoinThreshold=broadcast)
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    # Broadcasts by hint: reference keys of measured size, and a filter of bounded size.
    if broadcast == "-1" and name not in ("fk_orphan_rows", "fk_violations_prefiltered"):
        assert "BroadcastHashJoin" not in plan


def test_row_counts_share_one_scan_and_one_small_shuffle(stored):
    suite = suites.person_spine(AS_OF)
    plan = plan_of(dq_summary(stored.spine, suite, one_scan=False))
    columns = sorted(len(s) for s in scans(plan))
    # One scan for the thirteen row counts, one of the two columns of the distinct count.
    assert columns == [2, 13]
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert sorted(len(k.split(", ")) for k in keys) == [1, 1, 2]
    # Branches are already partitioned by decision where they meet.
    assert not re.search(r"Exchange[^\n]*\n[^\n]*HashAggregate[^\n]*\n[^\n]*Union", plan)


def test_row_and_distinct_counts_share_one_scan(spark, stored, tmp_path):
    """A key moves alone: no counter rides on the shuffle of the keys."""
    plan = plan_of(dq_summary(stored.spine, suites.person_spine(AS_OF)))
    assert [len(s) for s in scans(plan)] == [13]
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert sorted(len(k.split(", ")) for k in dealt) == [1, 3]
    keyed = re.search(r"HashAggregate\(keys=\[[^\]]*_code[^\]]*\], functions=\[([^\n]*)\]", plan)
    assert keyed.group(1).count("count(") == 1 and "sum(" not in keyed.group(1)
    # Two keys beside their row counts.
    path = str(tmp_path / "lineitem")
    lines = ["id DIV 3 AS o", "id % 3 AS l", "id % 50 AS p"]
    spark.range(1000).selectExpr(*lines, "IF(id % 2 = 0, 'O', 'F') AS s", "'D' AS decision_id").write.parquet(path)
    two = (
        unique("A", DistinctCount(("o", "l"))),
        unique("B", DistinctCount(("p",), F.col("s") == "O")),
    )
    summary = dq_summary(spark.read.parquet(path), Suite("T", two))
    assert [len(s) for s in scans(plan_of(summary))] == [5]
    assert sorted(r.check_value for r in summary.collect()) == [0.0, 475.0]


def test_foreign_key_scans_its_own_columns(stored):
    suite = suites.person_identifier_xref(AS_OF, stored.spine, fk_mode="anti")
    plan = plan_of(dq_summary(stored.xref, suite, one_scan=False))
    # Reference keys, foreign key, distinct key, row counts; scope and decision included.
    assert sorted(len(s) for s in scans(plan)) == [1, 3, 6, 9]
    plan = plan_of(dq_summary(stored.xref, suite))
    assert sorted(len(s) for s in scans(plan)) == [1, 3, 9]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_rows_are_counted_before_the_foreign_key_join(stored, conf, broadcast):
    """Even where the reference looks small: it may turn out larger, and a key may be hot."""
    conf(autoBroadcastJoinThreshold=broadcast)
    suite = suites.person_identifier_xref(AS_OF, stored.spine, fk_mode="anti")
    plan = plan_of(dq_summary(stored.xref, suite))
    assert "BroadcastHashJoin" not in plan
    join = re.search(r"SortMergeJoin[^\n]*LeftAnti", plan)
    left = plan[join.end() :].split("_reference_key")[0]
    count = r"HashAggregate\(keys=\[decision_id#\d+, person_id#\d+\], functions=\[count"
    assert re.search(count, left)


def test_a_null_in_the_reference_saves_both_scans(stored):
    suite = suites.person_identifier_xref(AS_OF, stored.spine)
    plan = plan_of(dq_summary(stored.xref, suite))
    assert plan.count("IsNull(effective_end_date)") >= 1
    # Row and distinct counts; nothing of the spine, no scan for the foreign key.
    assert len(scans(plan)) == 1 and "Join" not in plan
    clean = stored.spine.filter("person_id IS NOT NULL")
    suite = suites.person_identifier_xref(AS_OF, clean)
    plan = plan_of(dq_summary(stored.xref, suite))
    assert len(scans(plan)) == 3 and "IsNotNull(person_id)" in plan


def test_hot_key_among_many_decisions_is_split(spark, conf, tmp_path):
    conf(
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    path = str(tmp_path / "rows")
    spark.range(120_000).selectExpr(
        "sha2(CAST(id AS STRING), 256) AS decision_id",
        "CASE WHEN id % 2 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS key",
    ).repartition(8).write.parquet(path)
    df = spark.read.parquet(path)
    reference = keys_frame(spark, [str(i) for i in range(30_000)])
    suite = Suite("T", (foreign_key("ORPHANS", "key", reference, "key"),))
    summary = dq_summary(df, suite)
    assert "SortMergeJoin(skew=true)" in plan_of(summary, final=True)
    found = summary.agg(F.count("*"), F.sum("check_value")).first()
    assert tuple(found) == (120_000, 60_000 + 45_000)


def test_measuring_the_reference_moves_no_keys(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(50_000).selectExpr("CAST(id % 1000 AS STRING) AS key").write.parquet(path)
    reference = spark.read.parquet(path)
    assert _fits_broadcast(reference, "key", 1000 * 110 * 2)
    assert not _fits_broadcast(reference, "key", 1000 * 100 // 2)
    measured = reference.agg(F.approx_count_distinct("key"))
    assert "hashpartitioning" not in plan_of(measured)


def test_latest_run_ranks_before_the_shuffle(stored):
    plan = plan_of(latest_runs(stored.spine))
    assert plan.count("WindowGroupLimit") == 2
    assert [sorted(c.split("#")[0] for c in s) for s in scans(plan)] == [
        ["decision_id", "record_updated_ts", "run_id"]
    ]


def test_seeds_have_known_size(spark, stored):
    summary = dq_summary(stored.spine, suites.person_spine(AS_OF))
    plan = plan_of(dq_audit(summary, seed_thresholds(spark, AS_OF_TS), AS_OF_TS))
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan


def test_spine_keys_are_shuffled_once_for_all_tables(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES["dq_audit_all_anti"](spark, SF_DIR), final=True)
    assert plan.count("ReusedExchange") >= 2


def test_bucketed_tables_need_no_key_shuffle(spark, conf):
    """Where both tables are bucketed by the key, only rows per decision move."""
    conf(autoBroadcastJoinThreshold="-1")
    tables = SampleTables(spark, SF_DIR)
    try:
        for name in ("spine", "xref"):
            writer = getattr(tables, name).write.bucketBy(4, "person_id")
            writer.mode("overwrite").saveAsTable(f"bucketed_{name}")
        suite = suites.person_identifier_xref(
            AS_OF, spark.table("bucketed_spine"), fk_mode="anti"
        )
        plan = plan_of(dq_summary(spark.table("bucketed_xref"), suite, one_scan=False))
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
        assert len(keys) == 3 and all(re.fullmatch(r"decision_id#\d+", k) for k in keys)
    finally:
        for name in ("spine", "xref"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


def test_hot_orphan_key_is_split(spark, conf, tmp_path):
    """A key that holds a third of the rows does not end up in one task."""
    conf(
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    path = str(tmp_path / "rows")
    spark.range(60_000).selectExpr(
        "'D' AS decision_id",
        "CASE WHEN id < 20000 THEN 'hot' ELSE CAST(id AS STRING) END AS key",
        "sha2(CAST(id AS STRING), 256) AS payload",
    ).repartition(8).write.parquet(path)
    df = spark.read.parquet(path)
    reference = keys_frame(spark, [str(i) for i in range(20_000, 60_000)])
    orphans = orphan_rows(df, "key", reference, "key", broadcast_bytes=0)
    assert "SortMergeJoin(skew=true)" in plan_of(orphans, final=True)
    assert orphans.count() == 20_000

    small = orphan_rows(df, "key", reference, "key")
    plan = plan_of(small)
    assert "BroadcastHashJoin" in plan
    assert re.findall(r"hashpartitioning\((\w+)#", plan) == ["_reference_key"]
    assert small.count() == 20_000


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("clean", [True, False])
def test_branches_meet_correctly_for_many_decisions(spark, conf, broadcast, clean):
    """Each branch is coalesced on its own, yet a decision must come out once and complete."""
    conf(
        autoBroadcastJoinThreshold=broadcast,
        shuffle__partitions="50",
        adaptive__coalescePartitions__minPartitionSize="1KB",
        adaptive__advisoryPartitionSizeInBytes="2KB",
    )
    df = spark.range(30_000).selectExpr(
        "CAST(id % 3000 AS STRING) AS decision_id", "CAST(id DIV 2 AS STRING) AS key"
    )
    limit = 15_000 if clean else 14_000
    reference = keys_frame(spark, [str(i) for i in range(limit)])
    suite = Suite(
        "T",
        (
            count_where("ROWS", F.lit(True)),
            unique("DUPLICATES", DistinctCount(("key",))),
            foreign_key("ORPHANS", "key", reference, "key"),
        ),
    )
    summary = dq_summary(df, suite)
    by_check = summary.groupBy("check_name").agg(
        F.count("*").alias("n"),
        F.count_distinct("decision_id").alias("decisions"),
        F.sum("check_value").alias("total"),
    )
    assert {tuple(r) for r in by_check.collect()} == {
        ("ROWS", 3000, 3000, 30_000.0),
        ("DUPLICATES", 3000, 3000, 0.0),
        ("ORPHANS", 3000, 3000, 0.0 if clean else 2000.0),
    }
