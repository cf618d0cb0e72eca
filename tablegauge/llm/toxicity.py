"""Toxicity scores by FTRL-proximal logistic regression over hashed words.

Features are the distinct hashed words, word stems (prefixes), word pairs and pairs with one word skipped
of a text. Follow-the-regularised-leader with a learning rate per coordinate and an L1 penalty leaves
most weights at zero; the others are sent to the tasks, and every text is scored in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from tablegauge.llm.common import boxed, saved

_U = np.uint32
#: Words whose hashes a worker keeps, some 220 bytes each.
KNOWN_WORDS = 120_000


@dataclass(frozen=True)
class Ftrl:
    """Parameters of features and training. `max_rows` bounds the documents of each label to learn from."""

    bits: int = 20
    stems: tuple[int, ...] = (3, 4, 5, 6)
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    passes: int = 2
    max_rows: int = 6000


class Features:
    """Hashed features of texts; the hashes of frequent words are kept."""

    def __init__(self, parameters: Ftrl) -> None:
        self.parameters, self.known = parameters, {}

    def _word(self, word: str) -> bytes:
        # A stem is a prefix that leaves something off; it hashes unlike a word.
        parts = [word, *(f"{word[:n]}*" for n in self.parameters.stems if len(word) > n)]
        return b"".join(xxh32_intdigest(x.encode("utf-8", "surrogatepass")).to_bytes(4, "little") for x in parts)

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct feature numbers."""
        words = [w.strip(".,;:!?\"'()|*#") for w in (text or "").lower().split()]
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        place = {word: i for i, word in enumerate(set(words))}
        for word in place:
            if word not in known:
                known[word] = self._word(word)
        parts = [known[word] for word in place]
        single = np.frombuffer(b"".join(parts), dtype="<u4")
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))) // 4
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(parts)]
        h = single[starts[np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=len(words))]]
        out = [single]
        for gap, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77)):  # pairs, and pairs with one word skipped
            if len(h) > gap:
                x = h[:-gap] * _U(factor) ^ (h[gap:] + _U(gap))
                out.append((x ^ (x >> _U(15))) * _U(0xC2B2AE3D))
        x = np.concatenate(out)
        return np.unique((x ^ (x >> _U(16))) & _U((1 << self.parameters.bits) - 1))


class Model:
    """FTRL-proximal state: accumulated gradients z and their squares n of each coordinate."""

    def __init__(self, parameters: Ftrl) -> None:
        self.p = parameters
        self.z = np.zeros(1 << parameters.bits)
        self.n = np.zeros(1 << parameters.bits)
        self.z_bias = self.n_bias = 0.0

    def _weights(self, z, n):
        p = self.p
        shrunk = np.sign(z) * np.maximum(np.abs(z) - p.l1, 0)
        return -shrunk / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)

    def bias(self) -> float:
        return -self.z_bias / ((self.p.beta + self.n_bias**0.5) / self.p.alpha + self.p.l2)

    def learn(self, features: np.ndarray, label: int) -> None:
        alpha = self.p.alpha
        z, n = self.z[features], self.n[features]
        w = self._weights(z, n)
        g = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias(), -35, 35))) - label
        self.z[features] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / alpha * w
        self.n[features] = n + g * g
        self.z_bias += g - ((self.n_bias + g * g) ** 0.5 - self.n_bias**0.5) / alpha * self.bias()
        self.n_bias += g * g

    def sparse(self) -> tuple[np.ndarray, np.ndarray, float]:
        w = self._weights(self.z, self.n)
        at = np.flatnonzero(w)
        return at.astype(np.int32), w[at].astype(np.float32), float(self.bias())


def in_holdout(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; such rows are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, parameters: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-zero weights: feature numbers, weights, bias.

    Learns from at most `max_rows` documents of either label outside the holdout, the first by a hash of the
    id. Ids that are null, have a label of null only, both labels, or no document are left out; of several
    documents of an id the least text counts. The bias is corrected for the label that the bound thins out more,
    so that scores follow the odds of all these documents. They are streamed through one task, once for each
    pass and in a fixed order, so its memory is the model and a batch, and the result is the same for any
    partitions and batches. Without documents, or with one class only, the weights still are defined (the bias
    follows the only class).
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    usable = usable.filter(~in_holdout(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    usable = usable.filter("toxic = most").drop("most").join(docs.select("doc_id"), "doc_id", "left_semi")
    # Ids and labels, not texts; written once, as it is used three times.
    usable = saved(usable)
    rows = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # log(true odds / odds of the sample): each label's share of documents that are learned from.
    share = [min(rows[k], parameters.max_rows) / rows[k] if rows.get(k) else 1.0 for k in (0, 1)]
    correction = float(np.log(share[0] / share[1]))
    chosen = [usable.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(parameters.max_rows) for k in (0, 1)]
    # At most 2 * max_rows ids and labels: a bounded side. Features are made where the texts are read.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")

    @F.arrow_udf("array<int>")
    def features_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(parameters)
        for texts in batches:
            yield pa.array([features.of(t.as_py()) for t in texts], pa.list_(pa.int32()))

    sample = sample.select("doc_id", "toxic", F.struct("text", features_of("text").alias("features")).alias("of"))
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("of").alias("of"))
    sample = sample.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(parameters.passes))))
    sample = sample.select("doc_id", "toxic", "turn", "of.features")
    sample = sample.repartition(1).sortWithinPartitions("turn", F.xxhash64("doc_id", F.lit(1)), "doc_id")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(parameters)
        for batch in batches:
            for found, label in zip(batch.column("features"), batch.column("toxic")):
                model.learn(found.values.to_numpy(), label.as_py())
        at, w, bias = model.sparse()
        yield pa.RecordBatch.from_pydict({"at": pa.array([at.tobytes()]), "w": pa.array([w.tobytes()]), "bias": pa.array([bias])})

    row = sample.select("features", "toxic").mapInArrow(fit, "at binary, w binary, bias double").first()
    if row is None:
        return np.empty(0, np.int32), np.empty(0, np.float32), 0.0
    return np.frombuffer(row.at, np.int32), np.frombuffer(row.w, np.float32), row.bias + correction


def scorer(docs: DataFrame, labels: DataFrame, parameters: Ftrl = Ftrl()) -> Callable[[Column], Column]:
    """The score of a text column: 0 to 1, higher for likelier toxic, learned from `labels`.

    Null and empty texts get the score of no features, equal texts equal scores. Without usable labels every
    score is 0.5. Texts are scored whole, whatever their length.
    """
    # 8 bytes for each non-zero weight, at most 2**bits of them; Spark sends and drops them with the plan.
    at, w, bias = train(docs, labels, parameters)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = np.zeros(1 << parameters.bits, dtype=np.float32)
        dense[at] = w
        features = Features(parameters)
        for texts in batches:
            # Element by element: a batch is never held as Python text.
            sums = np.fromiter((dense[features.of(t.as_py())].sum() for t in texts), float, len(texts))
            yield pa.array(1 / (1 + np.exp(-np.clip(sums + bias, -35, 35))))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, parameters: Ftrl = Ftrl()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`; cases as in `train` and `scorer`.

    Repeated rows get equal scores, other columns are ignored, an empty table gives no rows.
    """
    score = scorer(docs, labels, parameters)
    out = docs.select("doc_id", in_holdout(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def not_toxic(docs: DataFrame, labels: DataFrame, parameters: Ftrl = Ftrl()) -> DataFrame:
    """The rows of `docs` that score below 0.5, with all their columns; cases as in `toxicity`."""
    score = scorer(docs, labels, parameters)
    return boxed(docs, score=score(F.col("text"))).filter("score < 0.5").select("row.*")
