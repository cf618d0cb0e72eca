"""Row counts and distinct counts of a table from one scan.

Every row is turned into a few tagged rows: one for each group of row counts, which carries a bit per predicate
that holds, and one for each distinct count, which carries the key. Counting equal tagged rows then does for
both at once: of the bits no more than 2**COUNTS_PER_TAG combinations can come up per decision, so they vanish
before the shuffle, and a key moves alone, without a counter beside it. After the shuffle each remaining
row is a distinct key, or a combination with the number of its rows.

The counted rows are also a state that can be kept: states of parts of a table add up, exactly.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions import as_column, within
from tablegauge.operators.checks import DistinctCount, Measure, OrphanCount, RowCount

#: Predicates of one tag. They bound the rows of a tag that a task can send, per decision.
COUNTS_PER_TAG = 16


def _keys(measure: DistinctCount | OrphanCount) -> list[Column]:
    if isinstance(measure, DistinctCount):
        return [as_column(c) for c in measure.columns]
    return [as_column(measure.column)]


class Tags:
    """How the measures of a suite are laid out in tagged rows."""

    def __init__(self, measures: Mapping[Measure, str]) -> None:
        self.counts = [m for m in measures if isinstance(m, RowCount)]
        self.keyed = [m for m in measures if not isinstance(m, RowCount)]
        self.names = dict(measures)
        self.groups = [
            self.counts[i : i + COUNTS_PER_TAG] for i in range(0, len(self.counts), COUNTS_PER_TAG)
        ]

    def holds(self, measure: RowCount) -> Column:
        """Whether a counted row is one of those where the predicate holds."""
        at = self.counts.index(measure)
        code, group = F.col("_code"), at // COUNTS_PER_TAG
        bit = F.lit(1 << at % COUNTS_PER_TAG)
        mine = code.between(group << COUNTS_PER_TAG, (group + 1 << COUNTS_PER_TAG) - 1)
        return mine & (code.bitwiseAND(bit) != 0)

    def carries(self, measure: DistinctCount | OrphanCount) -> Column:
        """Whether a counted row is a key of the measure."""
        return F.col("_code") == self._code(measure)

    def _code(self, measure: DistinctCount | OrphanCount) -> int:
        return -1 - self.keyed.index(measure)

    def parts(self, measure: DistinctCount | OrphanCount) -> list[str]:
        """The columns that hold a key."""
        return [f"_k{self.keyed.index(measure)}_{i}" for i in range(len(_keys(measure)))]

    def counted(self, df: DataFrame, ids: list[Column]) -> DataFrame:
        """_id0.. (the ids), _code, a column per part of a key, _n (rows), for rows of one scan.

        A code that is negative is that of a key; else it is the group of predicates and their bits.

        No column keeps a name of the table, so none can clash.
        """
        every = [(part, key) for m in self.keyed for part, key in zip(self.parts(m), _keys(m))]
        names = [part for part, _ in every]
        # NULLs of the right type, for the keys that a tagged row does not carry.
        none = {part: F.when(F.lit(False), key) for part, key in every}

        def row(code: Column, keys: Mapping[str, Column], when: Column | None = None) -> Column:
            value = F.struct(code.cast("int").alias("_code"), *[keys.get(p, none[p]).alias(p) for p in names])
            return value if when is None else F.when(when, value)

        tagged = {}
        for g, group in enumerate(self.groups):
            bits = [
                F.lit(1 << i) if m.predicate is None else F.when(m.predicate, 1 << i).otherwise(0)
                for i, m in enumerate(group)
            ]
            tagged[f"_c{g}"] = row(reduce(add, bits) + F.lit(g << COUNTS_PER_TAG), {})
        for m in self.keyed:
            keys = dict(zip(self.parts(m), _keys(m)))
            whole = reduce(lambda a, b: a & b, (key.isNotNull() for key in keys.values()))
            tagged[f"_k{-self._code(m)}"] = row(F.lit(self._code(m)), keys, within(m.scope, whole))
        wide = df.select(
            *[c.alias(f"_id{i}") for i, c in enumerate(ids)],
            *[value.alias(tag) for tag, value in tagged.items()],
        )
        old = [f"_id{i}" for i in range(len(ids))]
        rows = wide.unpivot(old, list(tagged), "_tag", "_v").filter("_v IS NOT NULL")
        flat = rows.select(*old, "_v.*")
        return flat.groupBy(*old, "_code", *names).agg(F.count("*").alias("_n"))

    def merged(self, counted: DataFrame, by: str) -> DataFrame:
        """One row per `by` with a column per row count and distinct count of `counted` rows of one id.

        Every distinct key is one row of `counted`.
        """
        out = []
        for m in self.counts:
            out.append(F.sum(F.when(self.holds(m), F.col("_n")).otherwise(0)).alias(self.names[m]))
        for m in self.keyed:
            if isinstance(m, DistinctCount):
                out.append(F.count_if(self.carries(m)).alias(self.names[m]))
        return counted.groupBy(F.col("_id0").alias(by)).agg(*out)
