"""Sharding with a hierarchical weighted hash tree.

A row descends from the root to a region, a rack and a shard. At each node the
children draw a hash of (row key, child path); child c scores ``-ln(u_c) / w_c``
and the smallest score wins, so a child is chosen with probability proportional
to its weight (the sum of the shard weights below it). A draw depends on the
key and the child alone. When weights change, a node's choice can only move
towards children whose weight rose (relative to the others), so rows move only
into or out of subtrees whose weights changed. A new shard in a region of its
own takes rows only into itself.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estuary.llm.common import id_text, materialize

#: (region, rack, shard, weight): 16 equal shards, 4 to a rack, 2 racks to a region.
TREE16 = tuple((s // 8, s // 4 % 2, s, 1.0) for s in range(16))
#: One more shard, in a region of its own.
TREE17 = (*TREE16, (2, 0, 16, 1.0))
SLOT_DIGITS = 3  # hex digits of the slot hash that name a range: 4096 ranges per shard


def draw(key: Column, path: str) -> Column:
    """Uniform (0, 1) double: 52 hash bits of the key and the child's path."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{path}"))), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(2 ** 52))


def _choose(key: Column, children: dict) -> Column:
    """Id of the child that wins the weighted draw; ties go to the smaller id."""
    scores = [F.struct((-F.ln(draw(key, path)) / F.lit(float(w))).alias("s"), F.lit(c).alias("c"))
              for c, (path, w) in sorted(children.items())]
    return (F.array_min(F.array(*scores)) if len(scores) > 1 else scores[0])["c"]


def assign(df: DataFrame, key: Column, tree=TREE16, name: str = "shard") -> DataFrame:
    """Add ``name``: the shard (INT) that the tree deals each row's key to.

    ``tree`` lists (region, rack, shard, weight); shards of weight 0 take no
    rows. The key is any string column; NULL counts as the empty string, and
    rows of equal keys go to the same shard. A column called ``name`` is replaced.
    """
    nodes: dict[tuple, dict] = defaultdict(dict)
    for region, rack, shard, w in tree:
        if w <= 0:
            continue
        for parent, child, path in (((), region, f"{region}"), ((region,), rack, f"{region}/{rack}"),
                                    ((region, rack), shard, f"{region}/{rack}/{shard}")):
            nodes[parent][child] = (path, nodes[parent].get(child, ("", 0.0))[1] + w)
    k = F.coalesce(key, F.lit(""))
    out = df.withColumn("_key", k).withColumn("_region", _choose(F.col("_key"), nodes[()]))
    rack = F.coalesce(*[F.when(F.col("_region") == p[0], _choose(F.col("_key"), c))
                        for p, c in sorted(nodes.items()) if len(p) == 1])
    out = out.withColumn("_rack", rack)
    leaf = F.coalesce(*[F.when((F.col("_region") == p[0]) & (F.col("_rack") == p[1]), _choose(F.col("_key"), c))
                        for p, c in sorted(nodes.items()) if len(p) == 2])
    return out.withColumn(name, leaf.cast("int")).drop("_key", "_region", "_rack")


def slots(df: DataFrame, shard: str, order: list[str], name: str = "slot") -> DataFrame:
    """Add ``name``: gapless position (BIGINT, from 0) of each row in its shard.

    Rows follow a hash of the ``order`` columns, then those columns; rows equal in
    all of them are interchangeable. Two levels: rows are numbered inside the
    4096 hash ranges of a shard, ranges are offset by their running counts, so no
    task holds a whole shard. ``df`` is read twice: pass a written table.
    """
    h = F.md5(F.concat_ws(":", F.lit("slot"), *[id_text(c) for c in order]))
    d = df.withColumn("_h", h).withColumn("_range", F.substring("_h", 1, SLOT_DIGITS))
    counts = d.groupBy(shard, "_range").agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy(shard, "_range").orderBy("_h", *order))
    return (d.join(offsets, [shard, "_range"]).withColumn(name, (F.col("_off") + rank - 1).cast("bigint"))
            .select(*[F.col(f"`{c}`") for c in df.columns if c != name], name))


def shard_documents(docs: DataFrame, tree=TREE16, grown=TREE17) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1; NULL text: 1), text_crc32
    (NULL text: that of the empty text), shard, slot and grown_shard of each
    document. NULL doc_ids share the key of the empty text; repeated doc_ids
    share a shard and get slots of their own."""
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
                       F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"))
    rows = assign(assign(rows, id_text("doc_id"), tree, "shard"), id_text("doc_id"), grown, "grown_shard")
    return slots(materialize(rows, "shards"), "shard", ["doc_id", "size", "text_crc32"])
