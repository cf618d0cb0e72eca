"""Trie of the prefixes that conversations share, by union-find over sorted neighbours.

1. A conversation is the sequence of the names (digests) of its turns. Equal sequences become one row, with
   the ids of its conversations; these are hashed in blocks of ids, so a sequence that is very common moves as
   a few rows and is read as a stream.
2. Sequences are range-partitioned and sorted, so those that share a prefix are neighbours. The turns that two
   neighbours have in common (LCP) are the edges of a partition. They are joined in descending depth: up to
   the depth of an edge both components rise alone, a node a turn; there they merge, which makes the
   branching node. All counts are sums over merged components.
3. Nodes on the path of a partition's first or last sequence, down to the depth that this sequence shares with
   its neighbour beyond the boundary, are parts of nodes. Their counts are made so that parts add up: the
   leftmost partition owns the node, and only the owner counts it as a child and takes its one copy off the
   tokens that are saved. What lies below is contracted into these counts, so a partition adds no more
   than two paths, which are merged by the digest of their prefix; the rest of a partition is final.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import broadcast_if_small, saved

#: Ids of a sequence that are put in one row.
IDS_PER_ROW = 1024
#: Turns that a partition of sequences holds on average, at most.
TURNS_PER_PARTITION = 250_000
#: Bytes of the name of a turn.
NAME = 16

_EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of turn, name, words) in order of turn, null first; turns of equal number by name.

    A name is a digest of role and text, null taken as empty; words are what white space of ASCII parts in the
    text. Rows without a conv_id belong to no conversation; repeated rows are turns of their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = F.struct("turn", name.alias("name"), words.alias("words"))
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", turn.alias("of"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("of")).alias("turns"))


def rebuilt(own: DataFrame, block: int, most: int) -> DataFrame:
    """`sequences` in which conversation c begins with turns of conversation c - c % block.

    With h = crc32(c in decimal) % most, these are the first h turns of that conversation (all if it has fewer,
    none if it is not there), then come c's own turns after its first h.
    """
    heads = own.filter(F.col("conv_id") % block == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    base = F.col("conv_id") - F.col("conv_id") % block
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.size("turns"))
    joined = own.withColumn("base", base).join(heads, "base", "left")
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def _distinct(seqs: DataFrame) -> DataFrame:
    """part, key, words, n, least, ends of the distinct sequences, sorted in range partitions; written."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["name"]), ""))
    rows = seqs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
    block = F.floor(F.col("conv_id") / IDS_PER_ROW).alias("block")
    ids = F.sort_array(F.collect_list("conv_id")).alias("ids")
    blocks = saved(rows.groupBy("key", block).agg(ids, F.first("words").alias("words")))
    turns = blocks.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS_PER_PARTITION))

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for the blocks of a key, which come one after the other; the ids go through a running hash."""
        schema = pa.schema([("part", pa.int32()), ("key", pa.binary()), ("words", pa.list_(pa.int32()))])
        for field in (("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())):
            schema = schema.append(pa.field(*field))
        one, digest, done = None, None, []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("part", "key", "words", "ids"))):
                key, ids = row[1].as_py(), row[3].values.to_numpy()
                if one is None or key != one["key"]:
                    if one is not None:
                        done.append(one | {"ends": digest.hexdigest()})
                    one = {"part": row[0].as_py(), "key": key, "words": row[2].as_py(), "n": 0, "least": int(ids[0])}
                    digest = hashlib.sha256()
                digest.update((b"," if one["n"] else b"") + ",".join(map(str, ids.tolist())).encode())
                one["n"] += len(ids)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if one is not None:
            yield pa.RecordBatch.from_pylist([one | {"ends": digest.hexdigest()}], schema)

    ranged = blocks.repartitionByRange(parts, "key").sortWithinPartitions("key", "block")
    ranged = ranged.select(F.spark_partition_id().alias("part"), "key", "words", "ids")
    return saved(ranged.mapInArrow(collapse, "part int, key binary, words array<int>, n long, least long, ends string"))


def _shared_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // NAME
    x, y = np.frombuffer(a[:n], "V16"), np.frombuffer(b[:n], "V16")
    return int(np.argmax(x != y))


class Forest:
    """The nodes of a partition: its sorted distinct sequences, joined by union-find in descending depth."""

    COLUMNS = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, node_key binary, parent_key binary"

    def __init__(self, keys: list[bytes], words: list[np.ndarray], n: list[int], least: list[int], ends: list[str], left: int, right: int) -> None:
        m = len(keys)
        self.keys, self.words, self.left, self.right = keys, words, left, right
        # An open node for each component: its depth, members, and what is known of its subtree.
        self.depth = [len(key) // NAME for key in keys]
        self.n, self.least, self.ends = list(n), list(least), list(ends)
        self.first, self.last = list(range(m)), list(range(m))
        self.children, self.leaves, self.tokens = [0] * m, [0] * m, [0] * m
        self.below: list[list[int]] = [[] for _ in range(m)]  # closed nodes that wait for their parent
        self.root = list(range(m))
        self.nodes: list[list] = []
        shared = np.array([_shared_turns(a, b) for a, b in zip(keys, keys[1:])], dtype=np.int64)
        for edge in np.argsort(-shared, kind="stable").tolist():
            a, b, depth = self._find(edge), self._find(edge + 1), int(shared[edge])
            self._rise(a, depth)
            self._rise(b, depth)
            self._merge(a, b)
        if m:
            top = self._find(0)
            self._rise(top, 0)
            self._close(top)

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def _merge(self, a: int, b: int) -> None:
        """Two open nodes of the same depth and prefix become one, kept under the one with more below it."""
        if len(self.below[a]) < len(self.below[b]):
            a, b = b, a
        self.root[b] = a
        for counts in (self.n, self.children, self.leaves, self.tokens):
            counts[a] += counts[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.first[a], self.last[a] = min(self.first[a], self.first[b]), max(self.last[a], self.last[b])
        self.ends[a] = self.ends[a] or self.ends[b]
        self.below[a] += self.below[b]
        self.below[b] = []

    def _close(self, a: int) -> tuple[int, bool]:
        """Writes the open node of a component; its number, and whether this partition owns it."""
        depth, first, last = self.depth[a], self.first[a], self.last[a]
        owned = first > 0 or depth > self.left
        beyond = last == len(self.keys) - 1 and depth <= self.right
        if not self.below[a] and not beyond:
            self.leaves[a] = 1
        words = int(self.words[first][depth - 1]) if depth else 0
        self.tokens[a] += (self.n[a] - owned) * words
        key = hashlib.md5(self.keys[first][: depth * NAME]).digest() if beyond or not owned else None
        number = len(self.nodes)
        for child in self.below[a]:
            # A part of a node does not know the least id of the whole; its children find that by key.
            self.nodes[child][2], self.nodes[child][9] = (None, key) if key else (self.least[a], None)
        self.nodes.append([self.least[a], depth, None, self.n[a], self.children[a], self.leaves[a], self.tokens[a], self.ends[a], key, None])
        return number, owned

    def _rise(self, a: int, depth: int) -> None:
        """Closes nodes until the open node is at `depth`."""
        while self.depth[a] > depth:
            number, owned = self._close(a)
            self.depth[a] -= 1
            self.children[a], self.below[a], self.ends[a] = int(owned), [number], None


def _nodes(ranged: DataFrame) -> DataFrame:
    """Nodes of all partitions; those with a node_key are parts of nodes. Written."""
    bounds = ranged.groupBy("part").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("part").collect()
    across = [_shared_turns(a["hi"], b["lo"]) for a, b in zip(bounds, bounds[1:])]
    left = {b["part"]: depth for b, depth in zip(bounds, [-1, *across])}
    right = {b["part"]: depth for b, depth in zip(bounds, [*across, -1])}
    fields = [f.split(" ") for f in Forest.COLUMNS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest() -> Iterator[pa.RecordBatch]:
            nodes = Forest(*rows, left[part], right[part]).nodes
            for at in range(0, len(nodes), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*nodes[at : at + 10_000]), schema)], schema=schema)

        part, rows = None, None
        for batch in batches:
            numbers = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and part != numbers[a]:
                    if rows:
                        yield from forest()
                    part, rows = int(numbers[a]), [[], [], [], [], []]
                piece = batch.slice(a, b - a)
                if a < b:
                    rows[0] += piece.column("key").to_pylist()
                    rows[1] += [w.values.to_numpy() for w in piece.column("words")]
                    for k, c in ((2, "n"), (3, "least"), (4, "ends")):
                        rows[k] += piece.column(c).to_pylist()
        if rows:
            yield from forest()

    together = ranged.repartition(max(1, len(bounds)), "part").sortWithinPartitions("part", "key")
    return saved(together.mapInArrow(grow, Forest.COLUMNS))


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per node of the trie of `seqs` (conv_id, turns as `sequences` gives them; a conv_id occurs once).

    A node is a distinct sequence of first turns, its members the conversations that begin with it; the root
    has none. conv_id is the least member, parent_conv_id that of the node one turn shorter (root: null),
    n_convs counts members, n_children the nodes one turn longer, n_leaves the childless nodes in the subtree
    (itself included). saved_tokens sums, over the subtree, the members but one times the words of the node's
    last turn. ends_sha256 hashes the ids of the members that end at the node, ascending, joined by commas.

    Conversations without turns are members of the root. A conversation is one row of 16 bytes a turn, so it has
    to fit into a row; conversations of the same turns may be any number. An empty table gives no rows.
    """
    nodes = _nodes(_distinct(seqs))
    counts = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = nodes.filter("node_key IS NOT NULL").groupBy("node_key", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in counts],
        F.max("ends").alias("ends"),
        F.max("parent_key").alias("parent_key"),
    )
    merged = saved(merged)
    names = merged.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent"))
    plain = ["conv_id", "depth", "parent_conv_id", *counts, "ends"]
    whole = nodes.filter("node_key IS NULL")
    under = whole.filter("parent_key IS NOT NULL").select(*plain, "parent_key")
    under = under.unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*plain, "parent_key"))
    # 100 bytes for a row in a hash table: two paths a partition.
    under = under.join(broadcast_if_small(names, 100), "parent_key", "left").withColumn("parent_conv_id", F.col("parent"))
    out = whole.filter("parent_key IS NULL").select(*plain).unionByName(under.select(*plain))
    return out.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        *counts,
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )
