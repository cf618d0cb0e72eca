"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Of every window of `span` words, the k-gram with the least hash is kept (k + width - 1 = span, so a
window holds `width` k-grams). Equal windows keep the same k-gram, so every shared window meets in the
join of kept k-grams, whatever stands around it. A hit is extended word by word to both sides and
counts when `span` words in a row are equal; extension compares the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import boxed, broadcast_if_small, lower_ascii, saved, text_keys

#: Words are made of 0-9, a-z and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A kept k-gram is one long: 36 bits of hash over 28 bits of position.
_PLACE_BITS = 28
#: The most that one broadcast of benchmark k-grams may take; more are probed in several blocks.
BLOCK_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Lower-cased words; none for a null or empty text."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row; a plain column would be inlined into lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _grams(hashes: Column, k: int) -> Column:
    """Hash and position of every k-gram, as longs; for k words and more."""
    high = F.lit(-(1 << _PLACE_BITS)).cast("long")
    return F.transform(
        F.sequence(F.lit(0), F.size(hashes) - F.lit(k)),
        lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k))).bitwiseAND(high).bitwiseOR(i.cast("long")),
    )


def _least(values: Column, width: int) -> Column:
    """The least value of every `width` neighbours, and of fewer at the end."""
    have = 1
    body = [lambda v: v]
    while have < width:  # of runs of `have` to runs of up to twice that
        step = min(have, width - have)
        body.append(
            lambda v, inner=body[-1], step=step: _let(inner(v), lambda u: F.transform(u, lambda x, i: F.least(x, F.get(u, i + step))))
        )
        have += step
    return body[-1](values)


def _kept(w: Column, k: int, span: int) -> Column:
    """The k-grams that some window of `span` words keeps; null for fewer words."""
    width = span - k + 1
    kept = _let(_hashes(w), lambda h: F.slice(_least(_grams(h, k), width), F.lit(1), F.size(h) - F.lit(span - 1)))
    return F.when(F.size(w) >= span, F.array_distinct(kept))


def _all_grams(w: Column, m: int) -> Column:
    """Every m-gram; null for fewer words."""
    return F.when(F.size(w) >= m, _let(_hashes(w), lambda h: _grams(h, m)))


def _place(kept: Column) -> Column:
    return kept.bitwiseAND((1 << _PLACE_BITS) - 1).cast("int")


def _item_grams(benchmark: DataFrame, k: int, span: int) -> DataFrame:
    """key, gram, left (nearest first), right, items: one row per k-gram and surroundings.

    An item shorter than `span` is one gram without surroundings.
    """
    side = span - k
    items = benchmark.select(F.col("item_id").alias("item"), words(F.col("text")).alias("w"))
    items = saved(items.withColumn("n", F.size("w")).filter("n > 0 AND item IS NOT NULL"))
    whole = items.filter(F.col("n") >= span).select("item", "w", F.explode_outer(_kept(F.col("w"), k, span)).alias("e"))
    whole = whole.withColumn("p", _place(F.col("e"))).select(
        "item",
        F.shiftright("e", _PLACE_BITS).alias("key"),
        F.slice("w", F.col("p") + 1, k).alias("gram"),
        F.reverse(F.slice("w", F.greatest(F.col("p") - side, F.lit(0)) + 1, F.least(F.col("p"), F.lit(side)))).alias("left"),
        F.slice("w", F.col("p") + (k + 1), side).alias("right"),
    )
    none = F.array().cast("array<string>")
    short = items.filter(F.col("n") < span).select(
        "item", F.shiftright(F.xxhash64(_hashes(F.col("w"))), _PLACE_BITS).alias("key"), F.col("w").alias("gram"), none.alias("left"), none.alias("right")
    )
    return whole.unionByName(short).groupBy("key", "gram", "left", "right").agg(F.collect_set("item").alias("items"))


def _run(ours: list[Column], theirs: Column) -> Column:
    """How many of `ours` equal `theirs` from the first on."""
    out = F.lit(len(ours))
    for j in reversed(range(len(ours))):
        same = F.coalesce(ours[j] == F.get(theirs, F.lit(j)), F.lit(False))
        out = F.when(~same, F.lit(j)).otherwise(out)
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, k: int = 6, span: int = 13) -> DataFrame:
    """k1, k2 (names of a text), n (its words), start, stop (words), items: every stretch shared with a benchmark item.

    `docs` has `text`; equal texts give equal rows.
    """
    side = span - k
    grams = saved(_item_grams(benchmark, k, span))
    size = F.octet_length(F.concat_ws(" ", "gram", "left", "right")) + 12 * F.size("items") + 100
    n_bytes = grams.agg(F.sum(size + 24 * (F.size("gram") + F.size("left") + F.size("right")))).first()[0] or 0
    blocks = -(-n_bytes // BLOCK_BYTES)
    shorts = [r[0] for r in grams.select(F.size("gram")).filter((F.size("left") == 0) & (F.size("right") == 0)).distinct().collect()]

    d = docs.select(*text_keys(F.col("text")), words(F.col("text")).alias("w"))
    # explode_outer, because for explode the optimizer adds a filter that computes the array once more.
    # The array is a column of its own, so that exploding and probing are compiled together and carry the
    # words of a document by reference.
    arrays = [_kept(F.col("w"), k, span), *(_all_grams(F.col("w"), m) for m in shorts)]
    exploded = [
        d.withColumn("a", a).select("k1", "k2", F.size("w").alias("n"), "w", F.explode_outer("a").alias("e")) for a in arrays
    ]
    p = F.col("p")
    found = []
    for block in range(blocks):
        part = grams.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block) if blocks > 1 else grams
        for rows in exploded:
            near = rows.select("k1", "k2", "n", "w", F.shiftright("e", _PLACE_BITS).alias("key"), _place(F.col("e")).alias("p")).join(
                F.broadcast(part), "key"
            )
            near = near.filter(F.slice("w", p + 1, F.size("gram")) == F.col("gram"))
            before = _run([F.get("w", p - (1 + j)) for j in range(side)], F.col("left"))
            after = _run([F.get("w", p + F.size("gram") + j) for j in range(side)], F.col("right"))
            alone = (F.size("left") == 0) & (F.size("right") == 0)
            near = near.select(
                "k1", "k2", "n", "items", alone.alias("alone"), (p - before).alias("start"), (p + F.size("gram") + after).alias("stop")
            )
            found.append(near.filter(F.col("alone") | (F.col("stop") - F.col("start") >= span)).drop("alone"))
    if not found:
        kind = grams.schema["items"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"k1 long, k2 long, n int, items {kind}, start int, stop int")
    return reduce(DataFrame.unionByName, found)


def _judged(docs: DataFrame, benchmark: DataFrame, k: int, span: int, one_in: int) -> DataFrame:
    """k1, k2, n_hit, items (as sorted strings), contaminated, for texts with hits."""
    hits = saved(benchmark_hits(docs, benchmark, k, span))
    by_text = Window.partitionBy("k1", "k2").orderBy("start", "stop")
    reached = F.coalesce(F.max("stop").over(by_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = hits.select("k1", "k2", "n", "start", "stop").distinct()
    spans = spans.withColumn("new", F.greatest(F.col("stop") - F.greatest(F.col("start"), reached), F.lit(0)))
    counts = spans.groupBy("k1", "k2").agg(F.sum("new").alias("n_hit"), F.first("n").alias("n"))
    items = hits.select("k1", "k2", F.explode("items").alias("item")).distinct()
    items = items.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    contaminated = F.lit(one_in) * F.col("n_hit") >= F.col("n")
    # Written, so that later joins have a plain exchange on either side, which adaptive execution can split.
    return saved(counts.join(items, ["k1", "k2"]).select("k1", "k2", "n_hit", "items", contaminated.alias("contaminated")))


def decontamination(docs: DataFrame, benchmark: DataFrame, k: int = 6, span: int = 13, one_in: int = 20) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit inside any occurrence of a window of `span` words of an item; an item of fewer words,
    but not none, is one window. A document is contaminated when some word and at least one word in
    `one_in` is hit. Null and empty texts have no words and are clean; items of null text or id are none;
    repeated rows each get a row, with equal results; other columns are ignored; empty tables are fine.
    """
    judged = _judged(docs, benchmark, k, span, one_in)
    n_words = F.size(words(F.col("text"))).cast("long").alias("n_words")
    out = docs.select("doc_id", *text_keys(F.col("text")), n_words).join(judged, ["k1", "k2"], "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, k: int = 6, span: int = 13, one_in: int = 20) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns; cases as in `decontamination`."""
    bad = _judged(docs, benchmark, k, span, one_in).filter("contaminated").select(F.struct("k1", "k2").alias("key"))
    kept = boxed(docs, key=F.struct(*text_keys(F.col("text"))))
    # 100 bytes for two longs in a hash table. Beyond the limit whole rows are shuffled.
    return kept.join(broadcast_if_small(bad, 100), "key", "left_anti").select("row.*")
