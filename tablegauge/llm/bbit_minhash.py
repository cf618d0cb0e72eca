"""Near duplicates by b-bit MinHash.

1. A document is its set of word shingles. Equal sets form one class, so copies collapse first.
2. Each class gets `bands * rows` minima. Bands of full minima name buckets; classes that share a
   bucket are candidates. The low 4 bits of all minima, packed, are the signature kept for estimates.
3. In a bucket, members are compared with one leader: the member that meets most others over all its
   buckets, which in a family of copies is the one they stem from. Bit counts of the signatures,
   corrected for chance collisions of 4-bit values, drop far pairs; full sets decide the rest.
4. Links join classes into components. Members of buckets that still hold several components are then
   joined exactly, so no link is lost that could join two: similar sets share one of their rarest
   shingles (prefix filter), at places that leave room for enough others (positional filter). In a large
   family of copies the rare shingles are each copy's own, so far copies meet nobody.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tablegauge.llm.common import boxed, broadcast_if_small, saved, text_keys

_U = np.uint64
#: One bit in each 4-bit field of a signed 64-bit number.
_FIELDS = 0x1111111111111111


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    """Hashed word shingles of texts."""

    def __init__(self, words: int) -> None:
        self.words = words

    def of(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words none."""
        return np.unique(self.all(text))

    def all(self, text: bytes | None) -> np.ndarray:
        """The shingle hashes in the order of the text."""
        # bytes.lower() and bytes.split() know ASCII only: A-Z, and the white space of the word rule.
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, dtype=_U)
        h = np.fromiter(map(xxh64_intdigest, words), dtype=_U, count=len(words))
        width = min(self.words, len(words))
        out = np.full(len(h) - width + 1, width, dtype=_U)
        for j in range(width):
            out = _mix(out * _U(0x9E3779B97F4A7C15) + h[j : len(h) - width + 1 + j])
        return out


def _minima(shingles: np.ndarray, n: int) -> np.ndarray:
    seeds = _mix(np.arange(1, n + 1, dtype=_U))
    factors = _mix(seeds) | _U(1)
    out = np.full(n, np.iinfo(_U).max, dtype=_U)
    for at in range(0, len(shingles), 1024):  # bounded memory for very long texts
        block = shingles[at : at + 1024]
        np.minimum(out, ((block[None, :] ^ seeds[:, None]) * factors[:, None]).min(axis=1), out=out)
    return _mix(out)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, k1, k2, n, s1, s2 (name the set), sig (longs of 4-bit fields), buckets, of each row."""
    n_minima = bands * rows
    assert n_minima % 16 == 0

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        shifts = (4 * np.arange(16, dtype=_U))[None, :]
        for batch in batches:
            n, s1, s2, sig, buckets = [], [], [], [], []
            for text in batch.column("raw"):
                found = shingles.of(text.as_py())
                n.append(len(found))
                s1.append(int(_mix(found).sum(dtype=_U).astype(np.int64)))
                s2.append(int(_mix(found ^ _U(0xA5A5A5A5)).sum(dtype=_U).astype(np.int64)))
                if len(found):
                    minima = _minima(found, n_minima)
                    low = ((minima & _U(15)).reshape(-1, 16) << shifts).sum(axis=1, dtype=_U)
                    band = np.arange(bands, dtype=_U)
                    for j in range(rows):
                        band = _mix(band * _U(0x9E3779B97F4A7C15) + minima[j * bands : (j + 1) * bands])
                    sig.append(low.astype(np.int64))
                    buckets.append(band.astype(np.int64))
                else:
                    sig.append([])
                    buckets.append([])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "k1", "k2")]
                + [pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64())]
                + [pa.array(sig, pa.list_(pa.int64())), pa.array(buckets, pa.list_(pa.int64()))],
                names=["doc_id", "k1", "k2", "n", "s1", "s2", "sig", "buckets"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows_in = docs.select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("raw"))
    return rows_in.mapInArrow(
        sign,
        f"doc_id {kind}, k1 long, k2 long, n long, s1 long, s2 long, sig array<long>, buckets array<long>",
    )


def estimate(a: Column, b: Column, n_minima: int) -> Column:
    """Similarity from two packed signatures: equal 4-bit fields, corrected for chance equality."""
    unequal = F.lit(0)
    for i in range(n_minima // 16):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        unequal = unequal + F.bit_count(x.bitwiseAND(_FIELDS))
    return ((1 - unequal / n_minima) - 1 / 16) / (1 - 1 / 16)


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for edges (a, b) of longs, by alternating large and small stars.

    Every round is written to the shared folder; the rounds grow with the logarithm of the longest chain.
    """
    edges = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    # The edges only get fewer: about a million of them in a file.
    files = -(-edges.count() // 1_000_000) or 1
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(edges.groupBy("u").agg(F.min("v").alias("v"))).filter("u > v").distinct()
        # Small star: all smaller neighbours of a node, and the node, hang on the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct().coalesce(files))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _texts(classes: DataFrame, docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and raw (the text of its first document) for the column `cls` of `wanted`. Written."""
    needed = saved(classes.join(wanted.distinct(), "cls").select("cls", "doc_id", "k1", "k2"))
    source = docs.select("doc_id", *text_keys(F.col("text")), F.col("text").cast("binary").alias("raw"))
    same = [source["doc_id"].eqNullSafe(needed["doc_id"]), source["k1"] == needed["k1"], source["k2"] == needed["k2"]]
    # 100 bytes for a row in a hash table. Beyond the limit the texts are shuffled.
    near = source.join(broadcast_if_small(needed, 100), same)
    return saved(near.select("cls", "raw").dropDuplicates(["cls"]))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, n_minima: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    at = lambda side: classes.select(F.col("cls").alias(side), F.col("sig").alias(f"sig_{side}"), F.col("n").alias(f"n_{side}"))
    near = pairs.join(at("a"), "a").join(at("b"), "b")
    # The sizes alone bound the similarity; an estimate 0.2 too low is more than five standard errors away.
    near = near.filter(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
    near = near.filter(estimate(F.col("sig_a"), F.col("sig_b"), n_minima) >= percent / 100 - 0.2)
    near = saved(near.select("a", "b"))
    texts = _texts(classes, docs, near.select(F.col("a").alias("cls")).union(near.select("b")))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, ours = Shingles(words), None, None
        for batch in batches:
            keep = []
            for a, raw_a, raw_b in zip(batch.column("a"), batch.column("raw_a"), batch.column("raw_b")):
                if (a := a.as_py()) != last:
                    last, ours = a, shingles.of(raw_a.as_py())
                theirs = shingles.of(raw_b.as_py())
                common = len(np.intersect1d(ours, theirs, assume_unique=True))
                keep.append(100 * common >= percent * (len(ours) + len(theirs) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    text_of = lambda side: texts.select(F.col("cls").alias(side), F.col("raw").alias(f"raw_{side}"))
    return saved(near.join(text_of("b"), "b").join(text_of("a"), "a").mapInArrow(confirm, "a long, b long"))


def _links(classes: DataFrame, docs: DataFrame, words: int, percent: int, n_minima: int) -> DataFrame:
    """Pairs of classes that connect every component: similar classes, or a class and the least one it reaches."""
    entries = classes.select("cls", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = saved(entries.join(shared, "bucket"))
    met = members.groupBy("cls").agg(F.sum("m").alias("met"))
    leaders = members.join(met, "cls").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("cls")).alias("c"))).alias("best"))
    leaders = saved(leaders.select("bucket", (-F.col("best.c")).alias("leader")))
    led = members.select("bucket", "cls").join(leaders, "bucket").filter("cls <> leader")
    first = led.select(F.least("leader", "cls").alias("a"), F.greatest("leader", "cls").alias("b")).distinct()
    links = _confirmed(first, classes, docs, words, percent, n_minima)

    # Members other than the leader that are still apart from one another.
    roots = components(links)
    apart = led.select("bucket", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    apart = apart.select("bucket", "cls", F.coalesce("root", "cls").alias("root"))
    mixed = apart.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    apart = apart.join(saved(mixed.select("bucket")), "bucket").join(classes.select("cls", "n"), "cls")
    # Of each class, the size of the smallest set that it shares a bucket with.
    least = saved(apart.groupBy("bucket").agg(F.min("n").alias("least")))
    apart = saved(apart.join(least, "bucket").groupBy("cls", "root", "n").agg(F.min("least").alias("least")))
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    if apart.isEmpty():
        return stars
    pairs = _prefix_pairs(apart, _texts(classes, docs, apart.select("cls")), words, percent)
    return stars.union(_confirmed(pairs, classes, docs, words, percent, n_minima))


def _prefix_pairs(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of `members` (cls, root, n, least) of different roots that may reach the similarity.

    Sets x and y that do share at least percent / (100 + percent) * (|x| + |y|) shingles. In an order by
    frequency, the first one they share is then so early that this many can still follow in both.
    """

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            found = [shingles.of(raw.as_py()) for raw in batch.column("raw")]
            row = np.repeat(np.arange(len(found)), [len(x) for x in found])
            token = np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("cls").take(pa.array(row)), pa.array(token)], names=["cls", "token"])

    tokens = saved(texts.mapInArrow(shingle, "cls long, token long"))
    counts = saved(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    ranked = tokens.join(counts, "token", "left").join(members, "cls")
    by_rarity = Window.partitionBy("cls").orderBy(F.coalesce("df", F.lit(1)), "token")
    ranked = ranked.withColumn("at", F.row_number().over(by_rarity))
    needed = lambda n, m: F.ceil(F.lit(percent) * (n + m) / F.lit(100.0 + percent) - 1e-9)
    smallest = F.greatest("least", F.ceil(F.lit(percent / 100) * F.col("n") - 1e-9))
    prefix = ranked.filter("df > 1").filter(F.col("at") <= F.col("n") - needed(F.col("n"), smallest) + 1)
    prefix = saved(prefix.select("token", "cls", "root", "n", "at"))
    other = prefix.select("token", *(F.col(c).alias(f"{c}2") for c in ("cls", "root", "n", "at")))
    room = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) + 1
    met = prefix.join(other, "token").filter("root < root2").filter(room >= needed(F.col("n"), F.col("n2")))
    return met.select(F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 4) -> DataFrame:
    """One row per row of `docs`: doc_id, k1, k2 (name its text), n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets; component_id
    is the least doc_id reachable. Null and empty texts, and texts without words, have no shingles and
    are linked with nothing. Repeated rows are linked like copies; a null doc_id joins a component, but
    never names it, and is not kept unless it is alone. Other columns are ignored; an empty table is fine.
    """
    signed = saved(signatures(docs, words, bands, rows).withColumn("cls", F.monotonically_increasing_id()))
    some = signed.filter("n > 0")
    groups = saved(some.groupBy("s1", "s2", "n").agg(F.min("cls").alias("cls"), F.min("doc_id").alias("least_id")))
    classes = saved(some.join(groups.select("cls"), "cls", "left_semi").select("cls", "doc_id", "k1", "k2", "n", "sig", "buckets"))
    roots = components(_links(classes, docs, words, percent, bands * rows))
    rooted = groups.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = saved(rooted.join(named, "root").select("s1", "s2", "n", "component_id"))
    out = some.join(named, ["s1", "s2", "n"]).select("doc_id", "k1", "k2", "n", "component_id")
    out = out.unionByName(signed.filter("n = 0").select("doc_id", "k1", "k2", "n", F.col("doc_id").alias("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "k1", "k2", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def deduplicated(docs: DataFrame, **parameters: int) -> DataFrame:
    """The rows of `docs` that `near_duplicates` keeps, one for each component, with all their columns.

    Rows of equal id and text are one document, of which one row stays; which one is open where others of its
    columns differ. Rows without words and null texts are linked with nothing and stay.
    """
    kept = near_duplicates(docs, **parameters).filter("kept").select(F.struct("doc_id", "k1", "k2").alias("key"))
    marked = boxed(docs, key=F.struct("doc_id", *text_keys(F.col("text"))))
    # Rows with equal id and text are one document.
    return marked.join(saved(kept.distinct()), "key", "left_semi").dropDuplicates(["key"]).select("row.*")
