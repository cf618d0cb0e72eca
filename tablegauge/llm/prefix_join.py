"""Jaccard join on word n-grams by rare-first prefix filtering.

Two sets of n and m n-grams that are similar enough share at least `needed(n, m)` of them. So in any order that
is the same for all sets, one that they share stands so early in both that this many can still follow: only
the first places of a set, its prefix, need to be joined. The order is rare first, so prefixes meet rarely.

* Order: n-grams are counted over all documents, by 2**20 classes of hash values; the rarer class comes first,
  then the hash. These counts have a fixed size, whatever the corpus.
* Sets: equal sets are one class with one representative, so copies take part once. Of two sets the smaller
  is joined with its index prefix, which is about half as long, the other with its full prefix.
* Filters on a shared prefix n-gram: length (the sizes allow the similarity), position (enough may follow).
  On a pair: suffix (of what follows the first shared n-gram, no more can be shared than the lesser count in
  each of 32 classes of the order and hash value). What is left is verified on full sets, once a pair.
* Large groups: in each prefix n-gram, all are first compared with one leader, that in which it stands earliest,
  which among near copies is the one they stem from; then with a second leader, out of what the first one has
  not drawn in. Only pairs of sets that are in different components by then are joined. That loses no link
  that could join two components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.bbit_minhash import Shingles, components
from tablegauge.llm.common import broadcast_if_small, saved, text_keys

_U = np.uint64
#: Classes of hash values that are counted; 1 MB of levels goes to the tasks.
COUNTERS = 1 << 20
#: Bits of a token below its level, and the levels in a group of the suffix filter's classes.
HASH_BITS, LEVELS, GROUPS, BINS = 56, 128, 4, 8
_OFF = _U(64 - HASH_BITS)


def needed(n: Column, m: Column, percent: int) -> Column:
    """The least number of shared n-grams: o with 100 o >= percent * (n + m - o)."""
    return F.floor((percent * (n + m) + (99 + percent)) / F.lit(100 + percent)).cast("long")


def probe_length(n: Column, percent: int) -> Column:
    return n - F.floor((percent * n + 99) / F.lit(100)).cast("long") + 1


def index_length(n: Column, percent: int) -> Column:
    """As `probe_length`, for partners that are no smaller."""
    return n - needed(n, n, percent) + 1


def rare_first(docs: DataFrame, words: int) -> tuple[bytes, list[int]]:
    """The level (about four times the binary logarithm of the count) of each class of n-grams, compressed.

    With it the pivots of the suffix filter: levels that part all n-grams into GROUPS of about equal numbers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(words), np.zeros(COUNTERS, dtype=np.int64)
        waiting, size = [], 0
        for batch in batches:
            for text in batch.column("raw"):
                # An n-gram that a text repeats counts again, which only moves it back in the order.
                waiting.append((shingles.all(text.as_py()) & _U(COUNTERS - 1)).astype(np.int32))
                size += len(waiting[-1])
                if size >= COUNTERS:
                    counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, size = [], 0
        if size:
            counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        at = np.flatnonzero(counts)
        for lo in range(0, len(at), 100_000):
            some = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["class", "n"])

    counts = docs.select(F.col("text").cast("binary").alias("raw")).mapInArrow(count, "class int, n long")
    level = F.least(F.floor(4 * F.log2(F.sum("n"))), F.lit(LEVELS - 1)).cast("tinyint")
    found = counts.groupBy("class").agg(level.alias("level"), F.sum("n").alias("n")).toArrow()
    levels = np.zeros(COUNTERS, dtype=np.uint8)
    levels[found["class"].to_numpy()] = found["level"].to_numpy()
    mass = np.cumsum(np.bincount(found["level"].to_numpy(), found["n"].to_numpy(), LEVELS))
    pivots = [int(np.searchsorted(mass, mass[-1] * g / GROUPS)) + 1 for g in range(1, GROUPS)]
    return zlib.compress(levels.tobytes()), pivots


def prefixes(docs: DataFrame, words: int, percent: int, order: bytes, pivots: list[int]) -> DataFrame:
    """doc_id, k1, k2 (name its text), n, s1, s2 (name the set), bins (counts), prefix (tokens in order), per row.

    A token is the level of its class over the low bits of its hash, so tokens compare in the order of the join.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, levels = Shingles(words), np.frombuffer(zlib.decompress(order), dtype=np.uint8)
        for batch in batches:
            n, s1, s2, bins, prefix = [], [], [], [], []
            for text in batch.column("raw"):
                found = shingles.of(text.as_py())
                size = len(found)
                n.append(size)
                # Sums of products with odd numbers, of the hashes and of the hashes turned around.
                s1.append(int((found * (found >> _U(31) | _U(1))).sum(dtype=_U).astype(np.int64)))
                s2.append(int(((found ^ _U(0xA5A5A5A5A5A5A5A5)) * (found >> _U(17) | _U(1))).sum(dtype=_U).astype(np.int64)))
                level = levels[(found & _U(COUNTERS - 1)).astype(np.int64)].astype(np.int64)
                token = level << HASH_BITS | (found >> _OFF).astype(np.int64)
                kind = np.searchsorted(pivots, level, side="right") * BINS + (found >> _U(61)).astype(np.int64)
                bins.append(np.bincount(kind, minlength=GROUPS * BINS).astype(np.int32))
                first = size - -(-percent * size // 100) + 1 if size else 0
                if 0 < first < size:
                    token = np.partition(token, first - 1)[:first]
                prefix.append(np.sort(token)[:first])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "k1", "k2")]
                + [pa.array(x, pa.int64()) for x in (n, s1, s2)]
                + [pa.array(bins, pa.list_(pa.int32())), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "k1", "k2", "n", "s1", "s2", "bins", "prefix"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("raw"))
    return rows.mapInArrow(sort, f"doc_id {kind}, k1 long, k2 long, n long, s1 long, s2 long, bins array<int>, prefix array<long>")


def _fits(percent: int) -> Column:
    """Length and positional filter on a shared token of sets of n and n2, at places at and at2 (from 0)."""
    length = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
    room = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    return length & (room >= needed(F.col("n"), F.col("n2"), percent))


def _pairs(met: DataFrame) -> DataFrame:
    """a, b, first (the first shared token) for rows of cls, cls2, token."""
    pair = F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b")
    return met.groupBy(*pair).agg(F.min("token").alias("first"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, pivots: list[int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; behind the suffix filter. Written."""
    of = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("bins").alias(f"bins_{x}"))
    near = pairs.join(of("a"), "a").join(of("b"), "b")
    follow = F.lit(0)
    for g, end in enumerate([*pivots, LEVELS]):  # groups that end before the first shared token hold nothing shared
        least = [F.least(F.get("bins_a", F.lit(i)), F.get("bins_b", F.lit(i))) for i in range(g * BINS, g * BINS + BINS)]
        follow = follow + F.when(F.shiftright("first", HASH_BITS) < end, sum(least[1:], least[0])).otherwise(0)
    near = saved(near.filter(follow >= needed(F.col("n_a"), F.col("n_b"), percent)).select("a", "b"))
    wanted = near.select(F.col("a").alias("cls")).union(near.select("b")).distinct()
    texts_of = saved(classes.join(wanted, "cls", "left_semi").select("cls", "doc_id", "k1", "k2"))
    source = docs.select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("raw"))
    same = [source["doc_id"].eqNullSafe(texts_of["doc_id"]), source["k1"] == texts_of["k1"], source["k2"] == texts_of["k2"]]
    # 100 bytes for a row in a hash table. Beyond the limit the texts are shuffled.
    texts = source.join(broadcast_if_small(texts_of, 100), same)
    texts = saved(texts.select("cls", "raw").dropDuplicates(["cls"]))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, ours = Shingles(words), None, None
        for batch in batches:
            keep = []
            for a, raw_a, raw_b in zip(batch.column("a"), batch.column("raw_a"), batch.column("raw_b")):
                if (a := a.as_py()) != last:
                    last, ours = a, shingles.of(raw_a.as_py())
                theirs = shingles.of(raw_b.as_py())
                shared = len(np.intersect1d(ours, theirs, assume_unique=True))
                keep.append(100 * shared >= percent * (len(ours) + len(theirs) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    text = lambda x: texts.select(F.col("cls").alias(x), F.col("raw").alias(f"raw_{x}"))
    return saved(near.join(text("b"), "b").join(text("a"), "a").mapInArrow(verify, "a long, b long"))


def _mixed(rooted: DataFrame) -> DataFrame:
    """token, drawn (the component of its first leader) of tokens that stand in several components. Written."""
    of = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.struct("at", "cls", "root")).alias("l"))
    return saved(of.filter("lo < hi").select("token", F.col("l.root").alias("drawn")))


def _led(rooted: DataFrame, percent: int) -> DataFrame:
    """Pairs of a token's leader, which is in another component than `drawn`, and what is not in the leader's."""
    best = F.min(F.struct("at", "cls", "n", "root")).alias("l")
    leaders = rooted.filter("root <> drawn").groupBy("token").agg(best)
    leaders = saved(leaders.select("token", *(F.col(f"l.{c}").alias(f"{c}2") for c in ("cls", "n", "at", "root"))))
    return _pairs(rooted.join(leaders, "token").filter("root <> root2").filter(_fits(percent)))


def _linked(classes: DataFrame, docs: DataFrame, words: int, percent: int, pivots: list[int]) -> DataFrame:
    """Pairs (a, b) of classes that connect every component: similar classes, or a class and the least it reaches."""
    token = F.posexplode("prefix").alias("at", "token")
    entries = classes.select("cls", "n", token).select("token", "cls", "n", F.col("at").cast("long").alias("at"))
    several = entries.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("token")
    members = saved(entries.join(several, "token"))
    # No component has the number -1: the first leader may be any.
    pairs = saved(_led(members.withColumns({"root": F.col("cls"), "drawn": F.lit(-1)}), percent))
    links = _verified(pairs, classes, docs, words, percent, pivots)
    for last in (False, True):
        roots = components(links).select(F.col("node").alias("cls"), "root")
        rooted = members.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        rooted = saved(rooted.join(_mixed(rooted), "token"))
        if rooted.isEmpty():
            break
        members = rooted.select("token", "cls", "n", "at")
        if last:
            # What is still apart: the smaller set with its index prefix, the other one with its full prefix.
            other = rooted.select("token", *(F.col(c).alias(f"{c}2") for c in ("cls", "n", "at", "root")))
            index = rooted.filter(F.col("at") < index_length(F.col("n"), percent))
            met = index.join(other, "token").filter("root <> root2 AND (n < n2 OR n = n2 AND cls < cls2)")
            more = _pairs(met.filter(_fits(percent)))
        else:
            more = _led(rooted, percent)
        more = saved(more.join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
        pairs = pairs.union(more)
        links = links.union(_verified(more, classes, docs, words, percent, pivots))
    return links


def similar_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    A document's set are its distinct n-grams of `words` words (white space of ASCII parts words, A-Z are lowered);
    a text of fewer words is one n-gram, a text without words or a null text has none and is linked with
    nothing. Documents are linked when 100 * intersection >= percent * union; component_id is the least doc_id
    reachable. Repeated rows are linked like copies; a null doc_id joins a component, but never names it unless
    it is alone. Texts may be of any length, other columns are ignored, an empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    order, pivots = rare_first(docs, words)
    rows = prefixes(docs, words, percent, order, pivots)
    rows = saved(rows.withColumn("cls", F.monotonically_increasing_id()))
    some = rows.filter("n > 0")
    groups = saved(some.groupBy("s1", "s2", "n").agg(F.min("cls").alias("cls"), F.min("doc_id").alias("least_id")))
    one = broadcast_if_small(groups.select("cls"), 40)
    classes = saved(some.join(one, "cls", "left_semi").select("cls", "doc_id", "k1", "k2", "n", "bins", "prefix"))
    roots = components(_linked(classes, docs, words, percent, pivots))
    rooted = groups.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = saved(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    named = rooted.join(broadcast_if_small(least, 60), "root").select("s1", "s2", "n", "component_id")
    named = broadcast_if_small(saved(named), 80)
    out = some.select("doc_id", "s1", "s2", "n").join(named, ["s1", "s2", "n"]).select("doc_id", "n", "component_id")
    out = out.unionByName(rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
