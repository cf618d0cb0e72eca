"""Exact top-k search by inner product with a KD-tree in every shard.

Vectors are dealt over shards of bounded size by a hash. A shard is a KD-tree: median splits along the
widest dimension, with the tight bounding box of every node. A query walks a tree best-first by the
largest inner product that a box allows, and leaves off below the k-th score known. That score is
propagated: a first pass searches one shard for each query, and its k-th score is where the search of
all other shards starts.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import saved

_LOW = np.iinfo(np.int64).min


class KdTree:
    """Integer vectors with their ids; nodes are arrays of row ranges and boxes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 64) -> None:
        order = np.lexsort((ids,))
        ids, vectors = ids[order], vectors[order]
        rows = np.arange(len(ids))
        self.low, self.high, self.span, self.children = [], [], [], []

        def build(a: int, b: int) -> int:
            part = vectors[rows[a:b]]
            low, high = part.min(axis=0), part.max(axis=0)
            node = len(self.span)
            self.low.append(low)
            self.high.append(high)
            self.span.append((a, b))
            self.children.append(None)
            axis = int((high - low).argmax())
            if b - a > leaf and high[axis] > low[axis]:  # equal vectors stay one leaf
                middle = (b - a) // 2
                rows[a:b] = rows[a:b][np.argpartition(part[:, axis], middle, kind="introselect")]
                self.children[node] = (build(a, a + middle), build(a + middle, b))
            return node

        if len(ids):
            build(0, len(ids))
        self.ids, self.vectors = ids[rows], vectors[rows]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _bound(self, node: int, q: np.ndarray) -> int:
        return int(np.maximum(q * self.low[node], q * self.high[node]).sum())

    def search(self, q: np.ndarray, own: int, k: int, floor: int) -> list[tuple[int, int]]:
        """The best k of (score, id) with scores of at least `floor`, without the id `own`; ties to smaller ids."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst on top
        heap = [(-self._bound(0, q), 0)] if self.span else []
        while heap:
            bound, node = heapq.heappop(heap)
            # Equal bounds may hold ties with smaller ids.
            if -bound < max(floor, best[0][0] if len(best) == k else floor):
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (-self._bound(child, q), child))
                continue
            a, b = self.span[node]
            scores, ids = self.vectors[a:b] @ q, self.ids[a:b]
            keep = (ids != own) & (scores >= floor)
            scores, ids = scores[keep], ids[keep]
            top = np.lexsort((ids, -scores))[:k]
            for score, i in zip(scores[top].tolist(), ids[top].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heapq.heapreplace(best, (score, -i))
        return [(score, -i) for score, i in best]


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null where the vector is, or a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(~bad, whole)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, shard_rows: int = 4096, block_rows: int = 2048
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of `vectors` for each of `queries`, both vec_id and embedding.

    The score is the inner product of the components as integers floor(scale * x), exact while it fits a
    long; ties go to the smaller vec_id; a query's own id is no candidate. Vectors that are null or hold a
    null or non-finite component, and null ids, take no part; a shorter vector counts as padded with zeros,
    an empty one too. Repeated rows of equal id and vector are one. Other columns are ignored; with fewer than k
    candidates all are returned, with none no row.
    """
    rows = vectors.select("vec_id", quantised(F.col("embedding"), scale).alias("v")).filter("v IS NOT NULL AND vec_id IS NOT NULL")
    rows = saved(rows.dropDuplicates(["vec_id", "v"]))
    asked = queries.select(F.col("vec_id").alias("query_id"), quantised(F.col("embedding"), scale).alias("v"))
    asked = saved(asked.filter("v IS NOT NULL AND query_id IS NOT NULL").dropDuplicates(["query_id", "v"]))
    n, m = rows.count(), asked.count()
    # At least one column, of zeros where all vectors are empty.
    width = rows.union(asked).agg(F.max(F.size("v"))).first()[0] or 1
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(m / block_rows))
    shard = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(blocks)).cast("int")
    home = F.pmod(F.xxhash64("query_id", F.lit(7)), F.lit(shards)).cast("int")
    # A block of queries meets every shard, never every row: `blocks` copies of a shard, `shards` of a query.
    every = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    shelves = rows.withColumn("shard", shard).withColumn("block", every(blocks))

    def matrix(column: pd.Series) -> np.ndarray:
        out = np.zeros((len(column), width), dtype=np.int64)
        for i, v in enumerate(column):
            out[i, : len(v)] = v
        return out

    def search(shelf: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(shelf) and len(ask):
            tree = KdTree(shelf["vec_id"].to_numpy(), matrix(shelf["v"]))
            for own, q, floor in zip(ask["query_id"], matrix(ask["v"]), ask["floor"]):
                out += [(own, i, score) for score, i in tree.search(q, own, k, int(floor))]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def searched(ask: DataFrame) -> DataFrame:
        # In a partition for each shard and block: few, large groups.
        groups = ["shard", "block"]
        return shelves.groupBy(groups).cogroup(ask.groupBy(groups)).applyInPandas(search, "query_id long, vec_id long, score long")

    begun = saved(searched(asked.withColumn("floor", F.lit(_LOW)).withColumn("shard", home).withColumn("block", block)))
    # The k-th score of the first pass, where it found k.
    kth = begun.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    rest = asked.join(kth, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(_LOW)))
    rest = rest.withColumn("home", home).withColumn("block", block).withColumn("shard", every(shards)).filter("shard <> home").drop("home")
    found = begun.union(searched(rest))
    best = found.groupBy("query_id").agg(F.collect_set(F.struct((-F.col("score")).alias("worse"), "vec_id")).alias("all"))
    best = best.select("query_id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("place", "hit"))
    return best.select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.worse")).alias("score")
    )
