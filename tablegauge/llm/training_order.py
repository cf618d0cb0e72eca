"""Token ids in training order: every sequence gets a slot of a keyed permutation.

1. The ids of documents, one after the other, are cut into sequences of `length` ids, which are written
   once, compressed, with their place (part, row) and an index of their documents. Only the last sequence
   of a part is padded. Ids are counted, so that a sequence can move with its frequent ids in a byte.
2. Counts per part give each sequence a number below N. A Feistel network with a secret key permutes
   the numbers; results of N or more are permuted again (cycle walking) until they are below N.
3. Sequences move once, to the range of whole shards they belong to, are sorted there and written as
   files, one per shard. A slot's record has a fixed length, so a reader seeks to any slot and resumes
   where it stopped.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import saved, shared_dir
from tablegauge.llm.tokens import END_ID, document_ids, encoder

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def permuted(numbers: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The keyed permutation of 0..n-1 at `numbers`."""
    bits = max(2, (n - 1).bit_length())
    low, high = bits // 2, bits - bits // 2
    keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(key % 2**64))

    def once(x: np.ndarray) -> np.ndarray:
        left, right, a, b = x >> _U(low), x & _U((1 << low) - 1), high, low
        for k in keys:  # an even number of rounds puts the halves back in their places
            left, right, a, b = right, left ^ (_mix(right ^ k) & _U((1 << a) - 1)), b, a
        return (left << _U(low)) | right

    with np.errstate(over="ignore"):
        out = once(numbers.astype(np.uint64))
        while (walk := out >= _U(n)).any():
            out[walk] = once(out[walk])
    return out.astype(np.int64)


def id_bytes(ranks_path: str, *more: int) -> int:
    """Bytes of an id in a record: 2 if the vocabulary and the ids in `more` fit, else 4."""
    return 2 if max(encoder(ranks_path).max_token_value, *more) < 1 << 16 else 4


class _Squeezer:
    """Sequences of ids as bytes for the way: frequent ids take one byte, others two, all of them deflated.

    `ids` are those counted, the most frequent first. Ids that are not among them, or from about place 65,000 on,
    go whole, in five bytes.
    """

    def __init__(self, ids: np.ndarray, width: int) -> None:
        # A first byte below `near` is a place in `ids`; the further ones are blocks of 256 places, 255 an id as it is.
        self.near, self.dtype = min(255, max(32, (255 * 256 - len(ids)) // 255)), np.dtype(f"<u{width}")
        ids = ids[: self.near + 256 * (255 - self.near)]
        place = np.arange(len(ids))
        codes = np.where(place < self.near, place << 8, (self.near << 8) + place - self.near).astype(np.uint16)
        self.codes = np.full(int(ids.max(initial=-1)) + 2, 255 << 8, dtype=np.uint16)  # the last one is for all ids beyond
        self.codes[ids] = codes
        self.ids = np.zeros(1 << 16, dtype=self.dtype)
        self.ids[codes] = ids

    def squeezed(self, sequence: bytes) -> bytes:
        ids = np.frombuffer(sequence, self.dtype)
        codes = self.codes.take(ids, mode="clip")
        first = (codes >> 8).astype(np.uint8)
        low = codes.astype(np.uint8)[(first >= self.near) & (first < 255)]
        parts = (np.array([len(ids)], "<u4"), first, low, ids[first == 255].astype("<u4"))
        return zlib.compress(b"".join(x.tobytes() for x in parts), 1)

    def restored(self, squeezed: bytes) -> bytes:
        data = zlib.decompress(squeezed)
        n = int.from_bytes(data[:4], "little")
        first = np.frombuffer(data, np.uint8, n, 4)
        codes = first.astype(np.uint16) << 8
        two = (first >= self.near) & (first < 255)
        low = np.frombuffer(data, np.uint8, np.count_nonzero(two), 4 + n)
        codes[two] |= low
        ids = self.ids[codes]
        ids[first == 255] = np.frombuffer(data, "<u4", offset=4 + n + len(low))
        return ids.tobytes()


#: Ids up to here are counted, by tables of that size in the tasks; a vocabulary is smaller.
_MOST_COUNTED = 1 << 20


def _frequent(sequences: DataFrame, width: int) -> np.ndarray:
    """The ids that occur, the most frequent first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}")
            n = np.bincount(ids[ids < _MOST_COUNTED], minlength=len(total))
            n[: len(total)] += total
            total = n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counts = sequences.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id of the vocabulary that occurs, however many sequences there are.
    rows = counts.toPandas().sort_values(["n", "id"], ascending=[False, True])
    return rows["id"].to_numpy(dtype=np.int64)


def _sequences(docs: DataFrame, ranks_path: str, length: int, end_id: int, width: int) -> DataFrame:
    """part, row, ids (bytes), and doc_ids, pieces, offsets of the documents in each sequence."""
    lists = ("doc_ids", "pieces", "offsets")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, part, n = encoder(ranks_path), TaskContext.get().partitionId(), 0
        ids, filled, index, done = [], 0, ([], [], []), []
        types: list[pa.DataType] = []

        def full() -> None:
            nonlocal ids, filled, index
            done.append((np.concatenate(ids).tobytes(), *index))
            ids, filled, index = [], 0, ([], [], [])

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal n
            if done:
                whole, *indexes = zip(*done)
                arrays = [pa.array([part] * len(done), pa.int32()), pa.array(range(n, n + len(done)), pa.int64()), pa.array(whole, pa.binary())]
                arrays += [pa.array(x, pa.list_(t)) for x, t in zip(indexes, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "row", "ids", *lists])
                n += len(done)
                done.clear()

        for batch in batches:
            types = [batch.schema.field("doc_id").type, pa.int32(), pa.int32()]
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                whole = document_ids(encoding, text.as_py(), end_id).astype(f"<u{width}")
                at = piece = 0
                while at < len(whole):
                    take = min(length - filled, len(whole) - at)
                    for values, value in zip(index, (doc_id.as_py(), piece, filled)):
                        values.append(value)
                    ids.append(whole[at : at + take])
                    at, piece, filled = at + take, piece + 1, filled + take
                    if filled == length:
                        full()
                if len(done) >= 1024:
                    yield from rows()
            yield from rows()
        if filled:
            full()
            yield from rows()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"part int, row long, ids binary, doc_ids array<{kind}>, pieces array<int>, offsets array<int>")


def training_order(
    docs: DataFrame,
    ranks_path: str,
    key: int,
    length: int = 1024,
    shard_slots: int = 4096,
    pad_id: int = 0,
    end_id: int = END_ID,
    path: str | None = None,
) -> DataFrame:
    """All sequences in training order, written as shards (see `read_slots`), one row each, read from them.

    The shards are `path/<shard>.bin`; `path` is a folder or URI that all executors reach, by default a new one in
    the shared folder. They are written when this is called; rows of a shard are sorted by slot.

    Columns: slot (0..N-1, each once), shard and place (slot // shard_slots and the rest); doc_ids, pieces and
    offsets of the documents in the sequence (a document goes on in further sequences as piece 1, 2 ...);
    n_ids, ids_crc32 (of the ids without padding) and record (`length` ids of `id_bytes` bytes, little-endian,
    padded with `pad_id`). A null text is an empty document, whose only id is `end_id`. Texts may be of any
    length. Repeated rows are separate documents; other columns are ignored; an empty table gives no rows.
    """
    width = id_bytes(ranks_path, end_id, pad_id)
    sequences = saved(_sequences(docs, ranks_path, length, end_id, width))
    counts = sequences.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per written part; the driver sees their sum only.
    bases = saved(counts.select("part", "n", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")))
    n = bases.agg(F.sum("n")).first()[0] or 0

    squeezer = _Squeezer(_frequent(sequences, width), width)

    @F.pandas_udf("binary")
    def squeezed(ids: pd.Series) -> pd.Series:
        return ids.map(squeezer.squeezed)

    @F.pandas_udf("long")
    def slot_of(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, key))

    # About 32 MB of ids in a partition, in whole shards.
    shards = -(-max(n, 1) // shard_slots)
    partitions = max(1, min(shards, -(-n * width * length // (32 << 20))))
    numbered = sequences.join(bases.select("part", "base"), "part").withColumn("slot", slot_of(F.col("base") + F.col("row")))
    placed = (
        numbered.withColumn("shard", F.expr(f"slot div {shard_slots}"))
        .select("slot", "shard", squeezed("ids").alias("ids"), "doc_ids", "pieces", "offsets")
        # Slots are known to be 0 .. n-1, so ranges need no sample; a shard is in one partition as a whole.
        .repartitionById(partitions, F.expr(f"cast(shard * {partitions} div {shards} as int)"))
        .sortWithinPartitions("slot")
    )
    path = path or f"{shared_dir(docs.sparkSession)}/{uuid.uuid4().hex}-shards"
    kind = docs.schema["doc_id"].dataType.simpleString()
    pad = np.full(length, pad_id, dtype=f"<u{width}").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(path)
        listed: dict[str, list] = {"n_ids": [], "doc_ids": [], "pieces": [], "offsets": []}

        def index(shard: int | None) -> Iterator[pa.RecordBatch]:
            if shard is not None:
                lists = [pa.array([v], pa.list_(t)) for v, t in zip(listed.values(), types)]
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *lists], names=["shard", *listed])
                for values in listed.values():
                    values.clear()

        for batch in batches:
            types = [pa.int64(), *(batch.schema.field(c).type for c in ("doc_ids", "pieces", "offsets"))]
            for shard, moved, *documents in zip(*(batch.column(c) for c in ("shard", "ids", "doc_ids", "pieces", "offsets"))):
                if shard.as_py() != shards.shard:
                    yield from index(shards.close())
                ids = squeezer.restored(moved.as_py())
                shards.write(shard.as_py(), ids + pad[len(ids) :])
                for values, value in zip(listed.values(), (len(ids) // width, *(x.as_py() for x in documents))):
                    values.append(value)
        yield from index(shards.close())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = _filesystem(path)
        stride = width * length
        for batch in batches:
            n_ids, *documents = (batch.column(c) for c in ("n_ids", "doc_ids", "pieces", "offsets"))
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                numbers = n_ids[i].as_py()
                with target.open_input_file(f"{root}/{shard}.bin") as data:
                    if data.size() != len(numbers) * stride:
                        raise ValueError(f"shard {shard} is not whole")
                    for at in range(0, len(numbers), 512):
                        m = min(512, len(numbers) - at)
                        raw = data.read(m * stride)
                        records = [raw[k * stride : (k + 1) * stride] for k in range(m)]
                        place = np.arange(at, at + m)
                        crc = [zlib.crc32(x[: width * k]) for x, k in zip(records, numbers[at : at + m])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(shard * shard_slots + place), pa.array([shard] * m, pa.int64()), pa.array(place),
                                *(x[i].values.slice(at, m) for x in documents),
                                n_ids[i].values.slice(at, m), pa.array(crc, pa.int64()), pa.array(records, pa.binary()),
                            ],
                            names=["slot", "shard", "place", "doc_ids", "pieces", "offsets", "n_ids", "ids_crc32", "record"],
                        )

    documents = f"doc_ids array<{kind}>, pieces array<int>, offsets array<int>"
    arrays = documents.replace("array<", "array<array<").replace(">", ">>")
    written = saved(placed.mapInArrow(write, f"shard long, n_ids array<long>, {arrays}"))
    return written.mapInArrow(read, f"slot long, shard long, place long, {documents}, n_ids long, ids_crc32 long, record binary")


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it. `file:/x`, `file:///x` and a path without a scheme are local."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Shards:
    """Writes shards one after the other, each under a name of this attempt that is then renamed."""

    def __init__(self, path: str) -> None:
        self.target, self.root = _filesystem(path)
        self.target.create_dir(self.root, recursive=True)
        self.attempt, self.shard, self.out = TaskContext.get().taskAttemptId(), None, None

    def write(self, shard: int, record: bytes) -> None:
        if self.out is None:
            self.shard, self.out = shard, self.target.open_output_stream(f"{self.root}/.{shard}-{self.attempt}")
        self.out.write(record)

    def close(self) -> int | None:
        """The shard that is whole now, if one was open."""
        shard = self.shard
        if self.out is not None:
            self.out.close()
            self.target.move(f"{self.root}/.{shard}-{self.attempt}", f"{self.root}/{shard}.bin")
        self.shard = self.out = None
        return shard


def write_shards(ordered: DataFrame, path: str, length: int = 1024, shard_slots: int = 4096) -> DataFrame:
    """Write the records of rows in training order once more, to another folder; returns shard and n_slots of each.

    A shard is written by one task, under a name of its own attempt that is then renamed, so a task that is
    run again replaces the file whole. `path` is a folder or URI that all executors reach.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, n, done = _Shards(path), 0, []
        for batch in batches:
            for this, record in zip(batch.column("shard").to_pylist(), batch.column("record").to_pylist()):
                if this != shards.shard:
                    done.append((shards.close(), n))
                    n = 0
                shards.write(this, record)
                n += 1
        done = [x for x in [*done, (shards.close(), n)] if x[0] is not None]
        if done:
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([s for s, _ in done], pa.int64()), "n_slots": pa.array([k for _, k in done], pa.int64())}
            )

    whole = ordered.select("shard", "slot", "record").repartition("shard").sortWithinPartitions("shard", "slot")
    return saved(whole.mapInArrow(write, "shard long, n_slots long"))


def read_slots(path: str, start: int, length: int = 1024, shard_slots: int = 4096, width: int = 2) -> Iterator[np.ndarray]:
    """Records from slot `start` on, shard by shard, to the end: what a trainer that resumes reads."""
    target, root = _filesystem(path)
    stride = width * length
    shard, place = divmod(start, shard_slots)
    while target.get_file_info(f"{root}/{shard}.bin").type == fs.FileType.File:
        with target.open_input_file(f"{root}/{shard}.bin") as data:
            data.seek(place * stride)
            while record := data.read(stride):
                yield np.frombuffer(record, dtype=f"<u{width}")
        shard, place = shard + 1, 0
