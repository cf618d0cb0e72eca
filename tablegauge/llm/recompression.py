"""Removal of repeated passages, found by recompression.

Every text is rewritten in rounds. A round names runs of two equal symbols and pairs of a symbol from
the left half of the alphabet and one from the right half; the name is a hash, so all of the corpus
uses the same names, and a coin per symbol and round gives the halves. Whether two symbols are merged
depends on three neighbours to either side, so equal passages get equal symbols but for a margin. The
number of rounds is the largest for which every window holds a symbol that is not in its margin.

A window's anchor is the symbol of the least name inside it, with the words of its margins, which the
window holds too. So equal windows have equal anchors, and neighbouring windows mostly share one: a
stretch. Spark counts anchors over the corpus:

* an anchor that occurs once reveals nothing, and its windows are unique;
* stretches of equal words repeat as a whole, with all of their windows;
* of the stretches whose words occur once, but whose anchor occurs again, the windows are compared one by
  one with each other and with one stretch of each repeated content: by their anchor and the hash of their
  words, two independent numbers of 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tablegauge.llm.common import saved

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def rounds_for(window: int) -> tuple[int, int]:
    """Rounds, and the margin in words that a symbol needs to either side."""
    rounds = 0
    while window - 6 * (2 ** (rounds + 1) - 1) >= 2 * 2 ** (rounds + 1) - 1:
        rounds += 1
    return rounds, 3 * (2**rounds - 1)


def compress_round(names: np.ndarray, starts: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """One round of naming over the symbols of a text: new names and first words."""
    if len(names) < 2:
        return names, starts
    same = names[:-1] == names[1:]
    off = np.zeros(1, dtype=bool)
    run = same & ~np.concatenate([off, same[:-1]]) & ~np.concatenate([same[1:], off])
    in_run = np.concatenate([run, off]) | np.concatenate([off, run])
    left = (_mix(names + _U(number * 2 + 1)) & _U(1)).astype(bool)
    pair = left[:-1] & ~left[1:] & ~in_run[:-1] & ~in_run[1:]
    merge = run | pair
    first = np.concatenate([merge, off])
    out = names.copy()
    at = np.flatnonzero(first)
    out[at] = _mix(_mix(names[at] * _U(_BASE)) + names[at + 1])
    keep = ~np.concatenate([off, merge])
    return out[keep], starts[keep]


class Parser:
    """Anchors and stretches of texts."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.rounds, self.margin = rounds_for(window)
        self.powers = self.inverse = np.ones(1, dtype=_U)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, 2 * len(self.powers))
            step = np.full(n, _BASE, dtype=_U), np.full(n, _INVERSE, dtype=_U)
            for s in step:
                s[0] = 1
            self.powers, self.inverse = (np.multiply.accumulate(s) for s in step)

    def parse(self, words: list[bytes]) -> None:
        """Sets `anchors` of all windows, `lo` and `hi` (first and last window) of the stretches."""
        n_windows = len(words) - self.window + 1
        if n_windows < 1:
            self.anchors = np.empty(0, dtype=_U)
            self.lo = self.hi = np.empty(0, dtype=np.int64)
            return
        h = _mix(np.fromiter(map(xxh64_intdigest, words), dtype=_U, count=len(words)))
        names, starts = h, np.arange(len(words))
        for number in range(self.rounds):
            names, starts = compress_round(names, starts, number)
        ends = np.append(starts[1:], len(words))
        p = np.arange(n_windows)
        first = np.searchsorted(starts, p + self.margin)
        last = np.searchsorted(ends, p + self.window - self.margin, side="right")  # exclusive
        # The leftmost least name in names[first:last], by ranks, from tables of the least of 2**k neighbours.
        least = _mix(names)
        order = np.argsort(least, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        level = np.frexp((last - first).astype(float))[1] - 1
        best = np.empty(n_windows, dtype=np.int64)
        table = 0
        for k in range(int(level.max()) + 1):
            while table < k:
                rank = np.minimum(rank[: -(1 << table)], rank[1 << table :])
                table += 1
            here = level == k
            best[here] = np.minimum(rank[first[here]], rank[last[here] - (1 << k)])
        chosen = order[best]
        # By symbol, not by name: equal windows then never share a stretch.
        cut = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
        self.lo = np.concatenate([[0], cut])
        self.hi = np.concatenate([cut - 1, [n_windows - 1]])
        self._grow(len(words) + 1)
        self.sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(h * self.powers[: len(h)], dtype=_U)])
        self.anchors = self.digests(starts[chosen] - self.margin, ends[chosen] + self.margin)

    def digests(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of the words from `start` up to `stop`."""
        return _mix((self.sums[stop] - self.sums[start]) * self.inverse[start] + _mix((stop - start).astype(_U)))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text; both name a row, but for repeated rows), raw (the text)."""
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("raw"))


def _of_rows(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """`texts` with what was `found` for each row; a null id equals a null id."""
    other = found.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    same = texts["doc_id"].eqNullSafe(other["_id"]) & (texts["mark"] == other["_mark"])
    return texts.join(other, same, how).drop("_id", "_mark")


def _stretches(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, mark, stretch (number in the text), anchor, digest (of the stretch's words)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(window)
        for batch in batches:
            row, number, anchor, digest = [], [], [], []
            for i, raw in enumerate(batch.column("raw")):
                parser.parse((raw.as_py() or b"").split())
                if len(parser.lo):
                    row.append(np.full(len(parser.lo), i))
                    number.append(np.arange(len(parser.lo)))
                    anchor.append(parser.anchors[parser.lo])
                    digest.append(parser.digests(parser.lo, parser.hi + window))
            if row:
                row = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(row) for c in ("doc_id", "mark")]
                    + [pa.array(np.concatenate(number).astype(np.int32))]
                    + [pa.array(np.concatenate(x).astype(np.int64)) for x in (anchor, digest)],
                    names=["doc_id", "mark", "stretch", "anchor", "digest"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs).mapInArrow(emit, f"doc_id {kind}, mark long, stretch int, anchor long, digest long")


def repeated_passages_removed(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    A word goes when it is in a window of `window` words whose words also start anywhere else in the corpus,
    the same text included; windows are judged on the input. So of a passage that repeats no copy stays, and
    repeated rows of `window` words and more lose all of them. Null and empty texts, and those shorter than
    a window, lose nothing; the kept text of a null text is empty. A null doc_id is kept as null; other
    columns are ignored; an empty table gives no rows.
    """
    # Texts are parsed once; the numbers of a stretch take less room than its words.
    stretches = saved(_stretches(docs, window))
    occurring = stretches.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi")
    )
    # Written, so that the join has a plain exchange on either side, which adaptive execution can split.
    repeated = saved(occurring.filter("n > 1").select("anchor", (F.col("lo") < F.col("hi")).alias("differ")))
    found = saved(stretches.join(repeated, "anchor"))
    # Of equal stretches under an anchor that has others too, one stands for all.
    one = F.min(F.struct("mark", "doc_id", "stretch")).alias("one")
    contents = saved(found.filter("differ").groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"), one))

    # The exchange of the texts below serves both joins.
    texts, kind = _texts(docs), docs.schema["doc_id"].dataType.simpleString()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(window)
        for batch in batches:
            row, place, anchor, digest = [], [], [], []
            for i, (raw, numbers) in enumerate(zip(batch.column("raw"), batch.column("open"))):
                parser.parse((raw.as_py() or b"").split())
                numbers = np.array(sorted(numbers.as_py()))
                at = np.concatenate([np.arange(a, b + 1) for a, b in zip(parser.lo[numbers], parser.hi[numbers])])
                row.append(np.full(len(at), i))
                place.append(at)
                anchor.append(parser.anchors[at])
                digest.append(parser.digests(at, at + window))
            if row:
                row = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), batch.column("mark").take(row), pa.array(np.concatenate(place).astype(np.int32))]
                    + [pa.array(np.concatenate(x).astype(np.int64)) for x in (anchor, digest)],
                    names=["doc_id", "mark", "place", "anchor", "digest"],
                )

    opened = contents.select("one.*").groupBy("doc_id", "mark").agg(F.collect_list("stretch").alias("open"))
    listed = _of_rows(texts, opened, "inner")
    # Windows of one stretch are never equal, and of repeated rows one counts.
    one_by_one = listed.mapInArrow(windows, f"doc_id {kind}, mark long, place int, anchor long, digest long")
    one_by_one = saved(one_by_one.distinct())
    # Counted before they are joined, so that a window that is everywhere gathers in no task.
    times = one_by_one.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("times"))
    often = saved(times.filter("times > 1").select("anchor", "digest"))
    again = one_by_one.join(often, ["anchor", "digest"]).select("doc_id", "mark", (2 * F.col("place") + 1).alias("code"))
    twice = saved(contents.filter("n > 1").select("anchor", "digest"))
    alike = found.filter("differ").join(twice, ["anchor", "digest"]).select("doc_id", "mark", "stretch")
    whole = alike.union(found.filter("NOT differ").select("doc_id", "mark", "stretch")).distinct()
    whole = whole.select("doc_id", "mark", (2 * F.col("stretch")).alias("code"))
    codes = whole.union(again).groupBy("doc_id", "mark").agg(F.collect_list("code").alias("codes"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(window)
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for raw, code in zip(batch.column("raw"), batch.column("codes")):
                words = (raw.as_py() or b"").split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if code.is_valid:
                    code = np.array(code.as_py())
                    parser.parse(words)
                    numbers, places = code[code % 2 == 0] // 2, code[code % 2 == 1] // 2
                    np.add.at(gone, np.concatenate([parser.lo[numbers], places]), 1)
                    np.add.at(gone, np.concatenate([parser.hi[numbers], places]) + window, -1)
                covered = np.cumsum(gone)[:-1] > 0
                n_words.append(len(words))
                n_removed.append(int(covered.sum()))
                kept.append(b" ".join(words[j] for j in np.flatnonzero(~covered)) if n_removed[-1] else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = _of_rows(texts, codes, "left").select("doc_id", "raw", "codes")
    out = joined.mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.decode("kept", "UTF-8").alias("kept_text"))
