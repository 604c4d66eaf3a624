"""SimHash near-duplicate detection with BK-trees.

Each document gets a 64-bit SimHash fingerprint of its word shingles. Equal
fingerprints are merged first. Two fingerprints within 3 bits agree on at least
two of five bit blocks, so every distinct fingerprint goes to ten shards, one per
pair of blocks, keyed by the bits of those blocks. A shard holds a BK-tree
(children keyed by the Hamming distance to their parent); a lookup follows only
edges whose key is within the radius of the distance at hand. Links inside a
shard are reduced to a spanning forest on the spot, and the forests of all shards
are merged by distributed connected components.

Whole trees grow with the corpus, so they are not broadcast: members and queries
of a shard meet by its key. A shard above ``MAX_TREE`` members is dealt into
several trees and its queries are sent to each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import materialize, release_memory, trimmed

SHINGLE = 3
RADIUS = 3
BLOCKS = (13, 13, 13, 13, 12)  # bits; radius 3 leaves at least two of five blocks equal
MAX_TREE = 65_536  # members of one tree
BUFFER_ROWS = 262_144  # rows handled at once by a task
FRONTIER = 1 << 20  # (query, node) pairs expanded at once
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of each space-joined word shingle, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    return np.fromiter((digest(joined[s:e], 42) for s, e in spans), np.uint64, len(words) - shingle + 1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in more than half of the hashes; no hash: 0."""
    if not len(hashes):
        return 0
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint as BIGINT (the 64 bits read as signed). NULL and empty texts give 0."""
    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = np.fromiter((fingerprint_of(shingle_hashes(t, shingle)) for t in s), np.uint64, len(s))
            yield pd.Series(out.view(np.int64))
        release_memory()

    return of(text)


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---- BK-trees over one buffer of shards -------------------------------------------------

def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class BKForest:
    """BK-trees of several shards, kept as sorted (node * 65 + distance) edges.

    Members are inserted in index order, so a node's descendants have larger
    indices than the node. All trees grow by one level at a time.
    """

    def __init__(self, fps: np.ndarray, shard: np.ndarray, members: np.ndarray):
        self.fps = fps
        rest, slot = members, shard[members]  # rows and the free place each of them falls into
        first = np.unique(slot, return_index=True)
        self.root = np.full(int(shard.max()) + 1 if len(shard) else 0, -1, np.int64)
        self.root[first[0]] = rest[first[1]]
        keys, child = [], []
        node = self.root[slot]
        while True:
            keep = rest != node
            rest, node = rest[keep], node[keep]
            if not len(rest):
                break
            slot = node * 65 + _bits(fps[rest], fps[node])
            places, at, back = np.unique(slot, return_index=True, return_inverse=True)
            keys.append(places)
            child.append(rest[at])
            node = rest[at][back]
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.child = self.keys[order], (np.concatenate(child) if child else np.empty(0, np.int64))[order]

    def links(self, queries: np.ndarray, shard: np.ndarray, member: np.ndarray, radius: int):
        """Yield (query, node) index arrays within ``radius``. A query that is a
        member itself looks at members before it only, as the others look at it."""
        root = self.root[shard[queries]]
        ok = (root >= 0) & ~(member[queries] & (root >= queries))
        queries, root = queries[ok], root[ok]
        todo = [(queries[i:i + FRONTIER], root[i:i + FRONTIER]) for i in range(0, len(queries), FRONTIER)]
        while todo:
            q, node = todo.pop()
            d = _bits(self.fps[q], self.fps[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            total = int(n.sum())
            if not total:
                continue
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)
            q, node = np.repeat(q, n), self.child[at]
            ok = ~member[q] | (node < q)
            q, node = q[ok], node[ok]
            todo += [(q[i:i + FRONTIER], node[i:i + FRONTIER]) for i in range(0, len(q), FRONTIER)]


def _compress(parent: np.ndarray) -> None:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return
        parent[:] = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; the smaller index is the root."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        _compress(parent)


def spanning_links(fps: np.ndarray, shard: np.ndarray, member: np.ndarray, radius: int = RADIUS):
    """Spanning forest (fp, root fp) of the links between the rows of each shard.

    ``shard`` is ascending. Links between two rows of which neither is a member
    belong to another tree of their shard.
    """
    forest = BKForest(fps, shard, np.flatnonzero(member))
    parent = np.arange(len(fps))
    for q, node in forest.links(np.arange(len(fps)), shard, member, radius):
        _union(parent, q, node)
    linked = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[linked], fps[parent[linked]]


def _shard_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, tree, member, fp) arrive ordered by shard, tree, members
    first. Whole trees are handled together; of a tree that is still arriving
    only its members are held, its queries are answered and let go."""
    def solve(b):
        change = np.concatenate(([False], (b[0][1:] != b[0][:-1]) | (b[1][1:] != b[1][:-1])))
        a, c = spanning_links(b[3].view(np.uint64), np.cumsum(change), b[2], radius)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(c.view(np.int64))], names=["u", "v"])

    held = None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if len(held[0]) < BUFFER_ROWS:
            continue
        last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
        if not last.all() and last.sum() <= len(last) // 2:
            yield solve([x[~last] for x in held])
            held = [x[last] for x in held]
        elif not held[2][-1]:  # the last tree is complete, its queries still arrive
            yield solve(held)
            held = [x[last & held[2]] for x in held]
    if held is not None and len(held[0]):
        yield solve(held)


# ---- distributed part ---------------------------------------------------------------------

def shard_keys(fp: Column, blocks: tuple[int, ...] = BLOCKS) -> Column:
    """Array of ten BIGINT shard keys: the pair number above the bits of both blocks."""
    part, at = [], 0
    for width in blocks:
        part.append((F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)), width))
        at += width
    pairs = [(i, j) for i in range(len(blocks)) for j in range(i + 1, len(blocks))]
    return F.array(*[F.lit(n << 32) + F.shiftleft(part[i][0], part[j][1]) + part[j][0]
                     for n, (i, j) in enumerate(pairs)])


def link_fingerprints(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) fingerprint links whose connected components are those of all pairs
    within ``radius`` bits. ``fps`` has the distinct fingerprints (column fp)."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the block scheme covers radius 0 to {RADIUS}")
    rows = fps.select("fp", F.explode(shard_keys(F.col("fp"))).alias("shard"))
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    trees = F.ceil(F.col("n") / MAX_TREE).cast("int")
    dealt = (rows.join(sizes, "shard")
             .withColumn("own", F.pmod(F.xxhash64("fp"), trees).cast("int"))
             .select("shard", F.explode(F.sequence(F.lit(0), trees - 1)).alias("tree"), "own", "fp")
             .select("shard", "tree", (F.col("own") == F.col("tree")).alias("member"), "fp"))
    return (dealt.repartition("shard", "tree")
            .sortWithinPartitions("shard", "tree", F.col("member").desc(), "fp")
            .mapInArrow(lambda it: trimmed(_shard_links(it, radius)), "u bigint, v bigint"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (u, v) BIGINT links as a star: one row (u, v) per
    vertex u that is not the smallest (v) of its component.

    Alternating large-star and small-star steps, each a partial aggregation
    (smallest neighbour) and an equi-join. A round ends in a written table, so
    the lineage stays short and a lost executor costs one round at most.
    """
    star = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .distinct(), "links")
    state = None
    for _ in range(max_rounds):
        seen = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)).first()
        if seen == state or not seen[0]:
            return star
        state = seen
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                                             .alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        star = materialize(small, "star")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, tie (64-bit text hash), fp and component_id of every document.

    component_id is the smallest doc_id reachable over links of ``radius`` bits
    or fewer, the document included. NULL doc_ids never name a component unless
    all its documents lack one (then it is NULL). Documents without words share
    fingerprint 0, which links like any other. Repeated rows give repeated rows.
    """
    rows = materialize(docs.select("doc_id", F.xxhash64("text").alias("tie"),
                                   fingerprint(F.col("text"), shingle).alias("fp")), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct")
    star = components(link_fingerprints(fps, radius))
    member = star.union(star.select("v", "v").distinct()).toDF("fp", "root")
    smallest = (member.join(fps, "fp").groupBy("root").agg(F.min("first_doc").alias("component_id")))
    linked = member.join(smallest, "root").select("fp", "root", "component_id")
    classes = (fps.join(linked, "fp", "left")
               .select("fp", F.coalesce("root", "fp").alias("root"),
                       F.when(F.col("root").isNull(), F.col("first_doc")).otherwise(F.col("component_id"))
                       .alias("component_id")))
    return rows.join(classes, "fp").select("doc_id", "tie", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the smallest doc_id (NULL last), ties to
    the smallest text hash; of repeated rows one stays. Columns as in ``docs``."""
    rows = materialize(near_duplicates(docs, shingle, radius), "near")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tie")
    keep = rows.groupBy("root").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.tie").alias("_tie"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                         F.col("doc_id").alias("_id2"), F.xxhash64("text").alias("_tie2"))
    kept = packed.join(keep, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_tie") == F.col("_tie2")), "left_semi")
    one = kept.groupBy("_id2", "_tie2").agg(F.min_by("_doc", F.xxhash64("_doc")).alias("_doc"))
    return one.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
