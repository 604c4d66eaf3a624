"""Prefix trie of rebuilt conversations over range-partitioned shards.

A conversation c is rebuilt as the first h turns of conversation c - c % 100 and its
own turns after its first h, with h = crc32(decimal c) % 6. A turn is known by the
first 128 bits of the SHA-256 of its role and text, a conversation by the digests of
its turns one after the other, its path. Sorted by (path, conv_id), the members of
every trie node stand together.

*Splitters* from a sample weighted by turns cut this order into shards. A node with
members in two shards is a prefix of a splitter's path, since the splitter lies between
them; the trie of all splitter paths, the *skeleton*, therefore holds every such
node and is broadcast. Each shard is sorted and walked once with a stack; it finishes
all nodes outside the skeleton and emits partial aggregates for the two splitter
paths at its ends. Those are summed by skeleton node. What is not known inside a
shard, whether a skeleton node without children in any shard is a leaf, is added for
each ancestor afterwards, and children of skeleton nodes learn their parent's smallest
member by a join with the skeleton.

The digest of the ids that end at a skeleton node is computed from pieces of id text in
shard order, streamed through one SHA-256; nothing is held beyond one piece.

Sizes: there are as many shards as the session has shuffle partitions, but each holds
``LEAST_TURNS`` to ``SHARD_TURNS`` turns (a longer conversation is one row of 20 bytes a
turn). Splitter paths are kept to as many turns
as give ``SKELETON_BYTES`` for all of them together, so the broadcast is bounded; a
group of copies is split by conv_id. Texts do not leave the first stage.

Defined results: rows without conv_id take no part; NULL role or text counts as
empty. Turns are ordered by turn, NULL first; ties, repeated rows included, are all kept
and ordered by digest. % keeps the sign of conv_id. A conversation without any turn is a
member of the root. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import materialize

FAMILY, HEAD = 100, 6  # conversations that share a first one; h is below HEAD
SHARD_TURNS, LEAST_TURNS = 400_000, 4_000  # turns of a shard at most and at least
SAMPLES = 16  # sampled conversations for each shard
SKELETON_BYTES = 16 << 20
CHUNK = 4096  # ids in one row of id text
WIDTH = 16  # bytes of a turn's digest


# ---- paths --------------------------------------------------------------------------------------

def head_length(conv_id: Column) -> Column:
    """h of a conversation."""
    return (F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % HEAD).cast("int")


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path (binary digests) and lens (code points of each turn's text)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    key = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.substring(F.sha2(key, 256), 1, 2 * WIDTH).alias("h"),
        F.char_length(text).alias("n"))
    # sort_array puts NULL turns first
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "h", "n"))).alias("own"))
    first = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_first"), F.slice("own", 1, HEAD - 1).alias("first"))
    h = head_length(F.col("conv_id"))
    both = own.join(first, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_first"), "left")
    none = F.slice("own", 1, 0)
    rebuilt = both.select("conv_id", F.concat(F.slice(F.coalesce("first", none), F.lit(1), h),
                                              F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))).alias("t"))
    return rebuilt.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["h"]), "")).alias("path"),
                          F.transform("t", lambda x: x["n"]).alias("lens"))


# ---- skeleton -----------------------------------------------------------------------------------

@dataclass
class Skeleton:
    """Trie of the splitter paths. Node 0 is the root; ``ends`` are the nodes of whole
    (uncut) splitter paths, the only nodes of the skeleton that may be leaves."""

    splitters: list[tuple[bytes, int]]
    node: dict[bytes, int] = field(default_factory=lambda: {b"": 0})
    parent: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])  # code points of the last text
    below: list[int] = field(default_factory=list)  # sum of the sizes of a node's subtree
    kids: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def build_skeleton(sample: list[tuple[bytes, int, list[int]]], shards: int, turns: int) -> Skeleton:
    """Skeleton of up to ``shards`` - 1 splitters, evenly spaced in a sample of (path, conv_id,
    lens), whose paths are kept to ``turns`` turns."""
    sample = sorted(sample)
    picks = [sample[k * len(sample) // shards] for k in range(1, shards)] if sample else []
    cut = WIDTH * turns
    # a cut path stands before everything that goes on from it
    keys = {(p[:cut], c if len(p) <= cut else -(1 << 63)): lens for p, c, lens in picks}
    sk = Skeleton(sorted(keys))
    ends = set()
    for (path, c), lens in sorted(keys.items()):
        at = 0
        for d in range(1, len(path) // WIDTH + 1):
            prefix = path[:WIDTH * d]
            if prefix not in sk.node:
                sk.node[prefix] = len(sk.parent)
                sk.parent.append(at)
                sk.size.append(lens[d - 1])
            at = sk.node[prefix]
        if c != -(1 << 63):
            ends.add(at)
    sk.below, sk.kids = list(sk.size), [0] * len(sk.parent)
    for k in range(len(sk.parent) - 1, 0, -1):  # children have larger numbers
        sk.below[sk.parent[k]] += sk.below[k]
        sk.kids[sk.parent[k]] += 1
    sk.ends = sorted(k for k in ends | {0} if not sk.kids[k])
    return sk


def make_skeleton(paths: DataFrame, shard_turns: int = SHARD_TURNS, least_turns: int = LEAST_TURNS,
                  max_bytes: int = SKELETON_BYTES) -> tuple[Skeleton, int]:
    """Skeleton of ``paths`` and the number of its shards."""
    weight = F.size("lens") + 1
    total = paths.agg(F.sum(weight)).first()[0] or 0
    session = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-total // shard_turns), min(session, total // least_turns))
    if shards == 1:
        return build_skeleton([], 1, 1), 1
    turns = max(1, max_bytes // (WIDTH * shards))
    share = shards * SAMPLES / total
    draw = (F.xxhash64("conv_id").bitwiseAND(F.lit((1 << 52) - 1))) / float(1 << 52)
    # one turn more than is kept shows that a path was cut
    rows = paths.where(draw < weight * F.lit(share)).select(
        F.substring("path", 1, WIDTH * (turns + 1)).alias("path"), "conv_id", F.slice("lens", 1, turns + 1).alias("lens"))
    sample = list(zip(*(c.to_pylist() for c in rows.toArrow().columns)))
    return build_skeleton(sample, shards, turns), shards


# ---- walking a shard ----------------------------------------------------------------------------

_FOUND = ("skeleton int, above int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
          "n_leaves bigint, saved_tokens bigint, ends_sha256 string, shard int, chunk bigint, ids binary")
NO_ENDS = hashlib.sha256().hexdigest()
_NONE = (1 << 63) - 1  # no member yet
_FIELDS = [f.split()[0] for f in _FOUND.split(", ")]
_TYPES = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]
          for f in _FOUND.split(", ")]


class _Shard:
    """Nodes of one shard, whose conversations come in ascending (path, conv_id).

    Arrays hold one value a node, in order of first appearance; ``up`` is the
    node's parent among them, ``bone`` its number in the skeleton or -1."""

    def __init__(self, sk: Skeleton, shard: int):
        self.sk, self.shard = sk, shard
        self.least, self.up, self.n, self.kids, self.leaves, self.saved, self.depth, self.bone = (
            array("q") for _ in range(8))
        self.digest: dict[int, hashlib._Hash] = {}  # of ids that end at open nodes
        self.ends: dict[int, str] = {}  # and at closed ones
        self.text: list[bytes] = []  # ids that end at the skeleton node ``text_of``
        self.text_of = -1
        self.chunks: list[tuple[int, int, bytes]] = []
        self.open: list[int] = []  # nodes of the path at hand, root first
        self.sizes: list[int] = []
        self.path = b""
        self._enter(-1, 0, 0)

    def _enter(self, up: int, bone: int, size: int) -> None:
        self.depth.append(len(self.open))
        self.open.append(len(self.up))
        self.sizes.append(size)
        self.up.append(up)
        self.bone.append(bone)
        self.least.append(_NONE)
        for x in (self.n, self.kids, self.leaves, self.saved):
            x.append(0)

    def _leave(self) -> None:
        """Finish the deepest open node; its sums go to its parent."""
        k, size = self.open.pop(), self.sizes.pop()
        own = self.bone[k] < 0
        # of a skeleton node only the members' part: what the node itself takes off is known to the skeleton
        self.saved[k] += (self.n[k] - own) * size
        if own and not self.kids[k]:
            self.leaves[k] = 1
        if k in self.digest:
            self.ends[k] = self.digest.pop(k).hexdigest()
        if self.open:
            p = self.open[-1]
            self.n[p] += self.n[k]
            self.leaves[p] += self.leaves[k]
            self.saved[p] += self.saved[k]
            self.kids[p] += own
            self.least[p] = min(self.least[p], self.least[k])

    def add(self, path: bytes, conv_id: int, lens: list[int]) -> None:
        if path != self.path:
            same, most = 0, min(len(path), len(self.path))
            if path[:most] == self.path[:most]:
                same = most // WIDTH
            else:
                while path[same * WIDTH:same * WIDTH + WIDTH] == self.path[same * WIDTH:same * WIDTH + WIDTH]:
                    same += 1
            while len(self.open) > same + 1:
                self._leave()
            bone = self.bone[self.open[-1]]
            for d in range(same, len(path) // WIDTH):
                bone = self.sk.node.get(path[:WIDTH * d + WIDTH], -1) if bone >= 0 else -1
                self._enter(self.open[-1], bone, lens[d])
            self.path = path
        k = self.open[-1]
        self.n[k] += 1
        self.least[k] = min(self.least[k], conv_id)
        text = str(conv_id).encode()
        if self.bone[k] >= 0:
            if k != self.text_of or len(self.text) >= CHUNK:
                self._write_text()
                self.text_of = k
            self.text.append(text)
        elif k in self.digest:
            self.digest[k].update(b"," + text)
        else:
            self.digest[k] = hashlib.sha256(text)

    def _write_text(self) -> None:
        if self.text:
            self.chunks.append((self.bone[self.text_of], len(self.chunks), b",".join(self.text)))
            self.text = []

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Rows of _FOUND: whole nodes, partial skeleton nodes and id text of skeleton nodes."""
        while self.open:
            self._leave()
        self._write_text()

        def node(k: int) -> tuple:
            up, own = self.up[k], self.bone[k] < 0
            above = self.bone[up] if up >= 0 else -1
            return (None if own else self.bone[k], None if above < 0 else above, self.least[k], self.depth[k],
                    None if up < 0 or above >= 0 else self.least[up], self.n[k], self.kids[k], self.leaves[k], self.saved[k],
                    self.ends.get(k, NO_ENDS) if own else None, None, None, None)

        for at in range(0, len(self.up), 10_000):
            yield _batch([node(k) for k in range(at, min(at + 10_000, len(self.up)))])
        for at in range(0, len(self.chunks), 100):
            yield _batch([(bone, *[None] * 9, self.shard, k, ids) for bone, k, ids in self.chunks[at:at + 100]])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_FIELDS)


def _walk(batches: Iterator[pa.RecordBatch], sk: Skeleton) -> Iterator[pa.RecordBatch]:
    held: _Shard | None = None
    for b in batches:
        shards, ids = b.column("shard").to_pylist(), b.column("conv_id").to_pylist()
        for shard, path, conv_id, lens in zip(shards, b.column("path"), ids, b.column("lens").to_pylist()):
            if held is None or held.shard != shard:
                if held:
                    yield from held.finish()
                held = _Shard(sk, shard)
            held.add(path.as_buffer().to_pybytes(), conv_id, lens)
    if held:
        yield from held.finish()


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the id text of each skeleton node; rows come sorted by (node, shard, chunk)."""
    at, digest = None, None
    out: list[tuple[int, str]] = []
    for b in batches:
        for node, ids in zip(b.column("skeleton").to_pylist(), b.column("ids")):
            if node != at:
                if at is not None:
                    out.append((at, digest.hexdigest()))
                at, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_buffer())
    if at is not None:
        out.append((at, digest.hexdigest()))
    if out:
        yield pa.record_batch([pa.array([n for n, _ in out], pa.int32()), pa.array([h for _, h in out])],
                              names=["skeleton", "ends_sha256"])


# ---- the trie -----------------------------------------------------------------------------------

def _shards_of(paths: DataFrame, sk) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist())
            shard = pa.array([sk.value.shard(p, c) for p, c in keys], pa.int32())
            yield pa.record_batch([*b.columns, shard], names=["conv_id", "path", "lens", "shard"])

    return paths.select("conv_id", "path", "lens").mapInArrow(run, "conv_id bigint, path binary, lens array<int>, shard int")


_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, least_turns: int = LEAST_TURNS,
                skeleton_bytes: int = SKELETON_BYTES) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256."""
    spark = conversations.sparkSession
    paths = materialize(rebuilt_paths(conversations), "trie-paths")
    skeleton, shards = make_skeleton(paths, shard_turns, least_turns, skeleton_bytes)
    shared = spark.sparkContext.broadcast(skeleton)
    dealt = _shards_of(paths, shared).repartitionById(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = materialize(dealt.mapInArrow(lambda it: _walk(it, shared.value), _FOUND), "trie-nodes")

    # skeleton nodes: sums of the partial aggregates, then what only the whole shows
    sk = spark.createDataFrame(
        pa.table({"skeleton": pa.array(range(len(skeleton.parent)), pa.int32()), "above": pa.array(skeleton.parent, pa.int32()),
                  "below": pa.array(skeleton.below, pa.int64()), "kids": pa.array(skeleton.kids, pa.int64()),
                  "end": pa.array(_flags(skeleton), pa.bool_())}))
    sums = found.where(F.col("skeleton").isNotNull() & F.col("ids").isNull()).groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("own_kids"), F.sum("n_leaves").alias("own_leaves"), F.sum("saved_tokens").alias("own_saved"))
    bones = sums.join(sk, "skeleton")
    leaf = bones.where(F.col("end") & (F.col("own_kids") == 0)).select("skeleton")
    lines = _ancestors(leaf, shared).groupBy("skeleton").agg(F.count(F.lit(1)).alias("more"))
    chunks = found.where(F.col("ids").isNotNull()).select("skeleton", "shard", "chunk", "ids")
    hashes = chunks.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "chunk").mapInArrow(
        _hash_chunks, "skeleton int, ends_sha256 string")
    bones = bones.join(lines, "skeleton", "left").join(hashes, "skeleton", "left")
    bones = materialize(bones.select(
        "skeleton", "above", "conv_id", "depth", "n_convs", (F.col("own_kids") + F.col("kids")).alias("n_children"),
        (F.col("own_leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"),
        (F.col("own_saved") - F.col("below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "trie-skeleton")
    # bounded by SKELETON_BYTES / WIDTH rows
    least = F.broadcast(bones.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("_least")))
    whole = found.where(F.col("skeleton").isNull()).join(least, "above", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_least"))
    top = bones.join(least, "above", "left").withColumn("parent_conv_id", F.col("_least"))
    return whole.select(_COLUMNS).unionByName(top.select(_COLUMNS))


def _flags(sk: Skeleton) -> list[bool]:
    ends = set(sk.ends)
    return [k in ends for k in range(len(sk.parent))]


def _ancestors(nodes: DataFrame, sk) -> DataFrame:
    """A row for each node and each node above it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent = sk.value.parent
        for b in batches:
            out = []
            for k in b.column("skeleton").to_pylist():
                while k >= 0:
                    out.append(k)
                    k = parent[k]
            yield pa.record_batch([pa.array(out, pa.int32())], names=["skeleton"])

    return nodes.mapInArrow(run, "skeleton int")
