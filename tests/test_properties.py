"""Random tables against plain Python, and counts against their parts."""

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helpers import AS_OF
from tablegauge import (
    DistinctCount,
    Suite,
    count_where,
    dq_summary,
    foreign_key,
    not_null,
    orphan_rows,
    unique,
)
from tablegauge.plans import suites
from tablegauge.sources.sample_tables import SampleTables

SCHEMA = "decision_id string, a string, b string, flag boolean"


def _random_rows(rng, size):
    def pick(*choices):
        return rng.choice(choices)

    hot = pick("a1", "a2", None)
    return [
        (
            pick("D1", "D2", None),
            hot if rng.random() < 0.4 else pick("a1", "a2", "a3", "a4", None),
            pick("b1", "b2", None),
            pick(True, False, None),
        )
        for _ in range(size)
    ]


@pytest.mark.parametrize("seed", range(6))
def test_summary_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = _random_rows(rng, rng.randrange(1, 60))
    known = [rng.choice(["a1", "a3", "x"] + ([None] if seed % 2 else [])) for _ in range(3)]
    reference = spark.createDataFrame([(k,) for k in known], "a string")
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    flag = F.col("flag")
    suite = Suite(
        "T",
        (
            not_null("NULLS", "a", "b"),
            unique("DUPLICATES", DistinctCount(("a", "b"))),
            unique("FLAGGED_DUPLICATES", DistinctCount(("a",), flag)),
            count_where("FLAGGED", flag),
            foreign_key("ANTI", "a", reference, "a"),
            foreign_key("NULL_AWARE", "a", reference, "a", mode="null_aware", scope=flag),
        ),
    )
    expected = {}
    for decision in {row[0] for row in rows}:
        mine = [row for row in rows if row[0] == decision]
        flagged = [row for row in mine if row[3]]
        orphans = [row for row in mine if row[1] is not None and row[1] not in known]
        expected[decision] = {
            "NULLS": sum(a is None or b is None for _, a, b, _ in mine),
            "DUPLICATES": len(mine)
            - len({(a, b) for _, a, b, _ in mine if a is not None and b is not None}),
            "FLAGGED_DUPLICATES": len(flagged) - len({a for _, a, _, _ in flagged} - {None}),
            "FLAGGED": len(flagged),
            "ANTI": len(orphans),
            "NULL_AWARE": 0 if None in known else sum(bool(row[3]) for row in orphans),
        }
    got = {}
    for row in dq_summary(df, suite).collect():
        got.setdefault(row.decision_id, {})[row.check_name] = row.check_value
    assert got == expected

    found = orphan_rows(df, "a", reference, "a").collect()
    want = [row for row in rows if row[1] is not None and row[1] not in known]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("table", ["spine", "xref", "behavior", "contact"])
def test_counts_of_parts_add_up(spark, table):
    """Row counts are additive; distinct keys and percentages are not."""
    tables = SampleTables(spark, "/root/testdata/sf0.001")
    df = getattr(tables, table).withColumn("_part", F.pmod(F.xxhash64(F.expr("*")), F.lit(3)))
    if table == "spine":
        suite = suites.person_spine(AS_OF)
    else:
        build = {
            "xref": suites.person_identifier_xref,
            "behavior": suites.customer_behavior_daily,
            "contact": suites.person_contact_profile,
        }[table]
        suite = build(AS_OF, tables.spine, fk_mode="anti")

    def counts(part: DataFrame) -> DataFrame:
        names = F.col("check_name")
        return dq_summary(part, suite, emit_metadata=False).filter(
            ~names.startswith("UNQ") & ~names.endswith("PCT") & ~names.endswith("DROP")
        )

    parts = reduce(
        DataFrame.unionByName, [counts(df.filter(F.col("_part") == i)) for i in range(3)]
    )
    added = parts.groupBy("check_name").agg(F.sum("check_value").alias("check_value"))
    whole = {r.check_name: r.check_value for r in counts(df).collect()}
    assert {r.check_name: r.check_value for r in added.collect()} == whole
    assert len(whole) >= 5
