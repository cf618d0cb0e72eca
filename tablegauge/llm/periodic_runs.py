"""Periodic runs of words, found by recompression.

The words of a text are rewritten by a run-length grammar: block compression names every stretch a a ... a
by its symbol and length, pair compression then names neighbours of which the first is in the left and the
second in the right half of the alphabet, and so on in turn. Where a symbol begins depends on its neighbours
alone, so equal passages are cut alike but for their edges, and the words that two places have in common
(LCE) are counted by climbing from words to symbols of ever higher levels and down again, a few steps each.

A run of period q and `length` words is a stretch of length - q places whose word returns q words later. So
one of every max(min_words, 3 q) - q places (with an exponent of 3) lies in it: these places are the
candidates of q, about n ln n / 2 for all periods of a text, and most fail on the words next to them. LCE queries to
either side then give the exact run. Levels are made when a query climbs to them. No suffix arrays are made.

Texts are independent, so the work is one map over the table. Short texts share a grammar, about 32,768 words
at a time, with a word of its own between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64
#: Words whose runs are looked for together.
BATCH_WORDS = 1 << 15
#: Candidates that are compared at a time.
BLOCK = 1 << 20

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Grammar:
    """Run-length grammar over symbols of which the first and the last occur nowhere else.

    A level is (bounds, names): symbol s of the level covers the words from bounds[s] up to bounds[s + 1].
    Level 0 are the words; odd levels come from block compression, even ones from pair compression.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.levels = [(np.arange(len(symbols) + 1), symbols)]
        self.fresh = int(symbols.max()) + 1
        self.stuck = 0

    def level(self, number: int) -> tuple[np.ndarray, np.ndarray] | None:
        """A level, made if it is asked for first; None where two rounds have changed nothing."""
        while number >= len(self.levels) and self.stuck < 4:
            bounds, names = self.levels[-1]
            merged = self._blocks(names) if len(self.levels) % 2 else self._pairs(names)
            if merged is None:
                self.stuck += 1
                self.levels.append((bounds, names))
            else:
                self.stuck = 0
                starts, new = merged
                self.levels.append((bounds[np.append(starts, len(names))], new))
        return self.levels[number] if number < len(self.levels) else None

    def _named(self, names: np.ndarray, at: np.ndarray, code: np.ndarray) -> None:
        """Gives equal codes equal new symbols, in place."""
        distinct, which = np.unique(code, return_inverse=True)
        names[at] = self.fresh + which
        self.fresh += len(distinct)

    def _blocks(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        if len(starts) == len(names):
            return None
        lengths = np.diff(np.append(starts, len(names)))
        out = names[starts]
        long = np.flatnonzero(lengths > 1)
        self._named(out, long, out[long] * (len(names) + 1) + lengths[long])
        return starts, out

    def _pairs(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        left = (_mix(names.astype(_U) + _U(len(self.levels) << 40)) & _U(1)).astype(bool)
        ways = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        first = max(ways, key=np.count_nonzero)
        at = np.flatnonzero(first)
        if not len(at):
            return None
        out = names.copy()
        self._named(out, at, names[at] * self.fresh + names[at + 1])
        starts = np.flatnonzero(~np.concatenate([[False], first]))
        return starts, out[starts]

    def common(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many words are the same from gaps i and j on (gap x is before word x): step 1 to the right, -1 to the left."""
        i, j, start = i.copy(), j.copy(), i
        side = 0 if step > 0 else -1

        def equal(level: tuple, some: np.ndarray) -> np.ndarray:
            bounds, names = level
            return names[np.searchsorted(bounds, i[some]) + side] == names[np.searchsorted(bounds, j[some]) + side]

        def advance(level: tuple, above: tuple | None, some: np.ndarray, block: bool) -> None:
            """Over one symbol, or, below a block level, over as much of the block as both places have left."""
            bounds = above[0] if block else level[0]
            if step > 0:
                n = np.minimum(*(bounds[np.searchsorted(bounds, x[some], side="right")] - x[some] for x in (i, j)))
            else:
                n = np.minimum(*(x[some] - bounds[np.searchsorted(bounds, x[some]) - 1] for x in (i, j)))
            i[some] += step * n
            j[some] += step * n

        stopped = np.zeros(len(i), dtype=np.int64)
        climbing, number = np.arange(len(i)), 0
        while len(climbing):
            level, above = self.level(number), self.level(number + 1)
            risen = []
            while len(climbing):
                if above is not None:
                    both = np.ones(len(climbing), dtype=bool)
                    for x in (i, j):
                        both &= above[0][np.searchsorted(above[0], x[climbing])] == x[climbing]
                    risen.append(climbing[both])
                    climbing = climbing[~both]
                stopped[climbing] = number
                climbing = climbing[equal(level, climbing)]
                advance(level, above, climbing, above is not None and number % 2 == 0)
            climbing = np.concatenate(risen) if risen else climbing
            number += 1
        for number in range(int(stopped.max(initial=0)) - 1, -1, -1):
            level, above = self.levels[number], self.levels[number + 1]
            falling = np.flatnonzero(stopped > number)
            while len(falling := falling[equal(level, falling)]):
                advance(level, above, falling, number % 2 == 0)
        return np.abs(i - start)


def _grid(n: int, low: int, high: int, min_words: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods, for periods from `low` up to `high`: one place of every stretch that a run must have."""
    q = np.arange(low, high)
    gap = np.maximum(min_words, exponent * q) - q
    times = np.maximum(0, -(-(n - q) // gap))
    q, gap = np.repeat(q, times), np.repeat(gap, times)
    place = (np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)) * gap
    return place, q


def runs_of(texts: list[np.ndarray], min_words: int, exponent: int) -> list[Runs]:
    """start, length, period (by start, then period) of the runs of each text, given as word numbers from 0."""
    sizes = np.array([len(t) for t in texts])
    n = int(sizes.sum()) + len(texts) + 1
    fresh = 1 + max((int(t.max()) for t in texts if len(t)), default=0)
    symbols = np.empty(n, dtype=np.int64)
    ends = np.cumsum(sizes + 1)  # place of the word of its own after each text
    firsts = ends - sizes
    limit = np.zeros(n, dtype=np.int64)
    symbols[0] = fresh
    for k, text in enumerate(texts):
        symbols[firsts[k] : ends[k]] = text
        symbols[ends[k]] = fresh + 1 + k
        if len(text) >= min_words:
            limit[firsts[k] : ends[k]] = len(text) // exponent
    grammar, top = Grammar(symbols), int(limit.max())
    found = [np.empty((3, 0), dtype=np.int64)]
    inside, until = np.ones(n, dtype=np.int64), np.zeros(n, dtype=np.int64)  # period and end of a run known to be at a place
    low = 1
    while low <= top:
        # Fewer periods at a time while these are small: about BLOCK candidates.
        high = min(top + 1, low + 1 + BLOCK * max(min_words - low, (exponent - 1) * low) // n, 2 * low)
        place, q = _grid(n, low, high, min_words, exponent)
        fits = (q <= limit[place]) & (symbols[place] == symbols[np.minimum(place + q, n - 1)])
        place, q = place[fits], q[fits]
        # Stretches are longer than one word, to one side at least.
        fits = (symbols[place + 1] == symbols[np.minimum(place + q + 1, n - 1)]) | (symbols[place - 1] == symbols[place + q - 1])
        fits &= (place + q >= until[place]) | (q % inside[place] != 0)
        place, q = place[fits], q[fits]
        if len(place):
            back = grammar.common(place, place + q, -1)
            start, length = place - back, back + q + grammar.common(place, place + q, 1)
            long = length >= np.maximum(min_words, exponent * q)
            new = np.unique(np.stack([start[long], length[long], q[long]]), axis=1)
            found.append(new)
            for s, size, period in new.T.tolist():
                if s + size > until[s]:
                    inside[s : s + size], until[s : s + size] = period, s + size
        low = high
    start, length, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    # A stretch is found under multiples of its period too; the least one is its own.
    own = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])[: len(start)]
    start, length, q = start[own], length[own], q[own]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    cut = np.searchsorted(start, np.stack([firsts, ends]))
    return [(start[a:b] - f, length[a:b], q[a:b]) for a, b, f in zip(*cut, firsts)]


def periodic_runs(docs: DataFrame, min_words: int = 24, exponent: int = 3) -> DataFrame:
    """One row per row of `docs`: doc_id, runs (array of start, length, period), kept_text.

    Words are what white space of ASCII parts, numbered from 0. A run is a stretch of consecutive words with
    least period q and at least max(min_words, exponent * q) words that no neighbouring word extends keeping
    q (`exponent` is 3 or more); runs are in order of start, then period. `kept_text` are the words, joined by
    one space, without those that a run contains after its first q words. Null and empty texts, and texts of
    fewer than min_words words, have no runs; the kept text of a null text is empty. A null doc_id is kept as
    null, repeated rows give repeated rows, other columns are ignored, an empty table gives no rows. A text of
    a million words takes some seconds and about 200 bytes a word in its task.
    """
    if exponent < 3 or min_words < 3:
        raise ValueError("runs need an exponent of 3 and 3 words at least")

    def judge(words: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
        known: dict[bytes, int] = {}
        texts = [np.fromiter((known.setdefault(w, len(known)) for w in ws), np.int64, len(ws)) for ws in words]
        runs, kept = [], []
        for ws, (start, length, period) in zip(words, runs_of(texts, min_words, exponent)):
            rows = zip(start.tolist(), length.tolist(), period.tolist())
            runs.append([{"start": s, "length": size, "period": q} for s, size, q in rows])
            if runs[-1]:
                gone = np.zeros(len(ws) + 1, dtype=np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, start + length, -1)
                ws = [ws[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
            kept.append(b" ".join(ws))
        return runs, kept

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            waiting, size, at = [], 0, 0
            for i, text in enumerate(batch.column("raw")):
                waiting.append((text.as_py() or b"").split())
                size += len(waiting[-1])
                if size >= BATCH_WORDS or len(waiting) >= 1024 or i == batch.num_rows - 1:
                    runs, kept = judge(waiting)
                    ids = batch.column("doc_id").slice(at, len(waiting))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(runs, kind), pa.array(kept, pa.binary())], ["doc_id", "runs", "kept"])
                    waiting, size, at = [], 0, i + 1

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("raw"))
    out = rows.mapInArrow(search, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, kept binary")
    return out.select("doc_id", "runs", F.decode("kept", "UTF-8").alias("kept_text"))
