"""Best-fit packing of documents into sequences under several capacities at once.

A piece of a document demands tokens, one document place and attention cost (its length squared).
A sequence has a capacity for each. Pieces are placed in decreasing order of weighted demand; of
the open sequences that have room in every dimension, the one is taken that fits best by

* `norm`: the least weighted norm of what would be left, or
* `dot`: the largest weighted dot product of the demand and what is left.

Pieces are dealt over groups by a hash, each packed by one task; a group leaves about one sequence
underfull, so the loss does not grow with the data.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import saved
from tablegauge.llm.tokens import END_ID, document_ids, encoder, piece_bounds


@dataclass(frozen=True)
class Capacities:
    """Of one sequence. `attention` bounds the sum of squared piece lengths."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    #: Of tokens, documents and attention in the choice of a sequence.
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)

    @property
    def piece(self) -> int:
        """The longest piece that an empty sequence holds."""
        return max(1, min(self.tokens, math.isqrt(self.attention)))


def cut_documents(docs: DataFrame, ranks_path: str, piece_tokens: int, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every document; longer ones are cut."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks_path)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = document_ids(encoding, text.as_py(), end_id)
                raw = memoryview(ids).cast("B")
                for k, (at, n) in enumerate(piece_bounds(len(ids), piece_tokens)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: np.ndarray, capacities: Capacities, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, by vector best fit in decreasing order."""
    most = np.array([capacities.tokens, capacities.documents, capacities.attention], dtype=float)
    weights = np.array(capacities.weights, dtype=float)
    lengths = lengths.astype(np.int64)
    demand = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1) / most
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    shortest = int(lengths.min()) if len(lengths) else 0
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    left = np.empty((64, 3))  # of the open sequences, as shares of the capacities
    name, filled = np.empty(64, dtype=np.int64), np.empty(64, dtype=np.int64)
    n_open = n_all = 0
    slack = 1e-9
    for i in order:
        need = demand[i]
        rest = left[:n_open] - need
        fits = rest.min(axis=1) >= -slack
        if fits.any():
            if rule == "norm":
                score = (rest * rest) @ weights
            else:
                score = -(left[:n_open] @ (weights * need))
            score[~fits] = np.inf
            at = int(score.argmin())
        else:
            if n_open == len(name):
                left, name, filled = (np.concatenate([x, np.empty_like(x)]) for x in (left, name, filled))
            at = n_open
            left[at], name[at], filled[at] = 1.0, n_all, 0
            n_open, n_all = n_open + 1, n_all + 1
        sequence[i], offset[i] = name[at], filled[at]
        left[at] -= need
        filled[at] += lengths[i]
        if capacities.tokens - filled[at] < shortest or left[at].min() <= slack:  # full: close it
            n_open -= 1
            left[at], name[at], filled[at] = left[n_open], name[n_open], filled[n_open]
    return sequence, offset


def pack(
    docs: DataFrame,
    ranks_path: str,
    capacities: Capacities = Capacities(),
    rule: str = "norm",
    group_pieces: int = 8192,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with the sequence and the offset where each is placed.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its
    ids and `end_id`; only those longer than a sequence are cut, the first piece may be shorter. A null
    text is an empty one. Each input row is packed, repeated rows too; other columns are ignored; an
    empty table gives no rows. A null doc_id is kept as null.
    """
    pieces = saved(cut_documents(docs, ranks_path, capacities.piece, end_id).withColumn("row", F.monotonically_increasing_id()))
    whole = F.col("length") >= capacities.tokens
    groups = max(1, math.ceil(pieces.filter(~whole).count() / group_pieces))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        # A fixed order makes a rerun of the task give the same sequences.
        group = group.sort_values("row", ignore_index=True)
        sequence, offset = best_fit(group["length"].to_numpy(), capacities, rule)
        first = int(group["group"].iloc[0]) << 32
        return group.drop(columns=["row", "group"]).assign(sequence_id=2 * (first + sequence) + 1, offset=offset)

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    packed = (
        pieces.filter(~whole)
        .withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(
            place,
            f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )
    alone = pieces.filter(whole).select(
        *columns, (2 * F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return alone.unionByName(packed)
