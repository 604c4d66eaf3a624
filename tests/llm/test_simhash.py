"""SimHash fingerprints, BK-trees and components against brute force."""
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from estuary.llm import simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_duplicates_match_brute_force(docs_of, odd_rows):
    out = simhash.near_duplicates(docs_of(odd_rows)).withColumn("h", simhash.fingerprint_hex(F.col("fp"))).collect()
    assert len(out) == len(odd_rows)
    fps = [plain_fingerprint(t) for _, t, _ in odd_rows]
    root = classes(fps)
    smallest = defaultdict(list)
    for (i, _, _), r in zip(odd_rows, root):
        smallest[r] += [] if i is None else [i]
    want = sorted((-1 if i is None else i, f"{f:016x}", min(smallest[r], default=None))
                  for (i, _, _), f, r in zip(odd_rows, fps, root))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.h, r.component_id) for r in out) == want


@pytest.mark.parametrize("max_tree", [8, 65_536])
def test_links_and_components_on_dense_fingerprints(spark, monkeypatch, max_tree):
    """Clusters in which many pairs are within the radius, in small and large trees."""
    monkeypatch.setattr(simhash, "MAX_TREE", max_tree)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(50)} | {0}
    for f in list(fps)[:5]:
        for _ in range(60):
            for _ in range(rng.randrange(1, 4)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    star = {r.u: r.v for r in simhash.components(simhash.link_fingerprints(df)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for s in signed:
        got[star.get(s, s)].add(s)
    for s, r in zip(signed, classes(fps)):
        want[r].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_forest_streams_in_pieces(monkeypatch):
    """A tree that arrives in many batches gives the same components."""
    rng = np.random.default_rng(0)
    fps = np.unique(rng.integers(0, 1 << 12, 900).astype(np.uint64))
    import pyarrow as pa

    n = len(fps)
    member = np.arange(n) < n // 2
    cols = [np.zeros(n, np.int64), np.zeros(n, np.int32), member, fps.view(np.int64)]
    batch = lambda a, b: pa.record_batch([pa.array(c[a:b]) for c in cols], names=["shard", "tree", "member", "fp"])

    def groups(buffer):
        monkeypatch.setattr(simhash, "BUFFER_ROWS", buffer)
        root = {int(f): int(f) for f in cols[3]}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for out in simhash._shard_links(iter([batch(i, i + 37) for i in range(0, n, 37)]), 2):
            for u, v in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
                a, b = find(u), find(v)
                root[max(a, b)] = min(a, b)
        return {f: find(f) for f in root}

    assert groups(50) == groups(1 << 20)


def test_one_document_of_each_group_stays(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    root = classes([plain_fingerprint(t) for _, t, _ in odd_rows])
    assert len(rows) == len(set(root))
    by_root = defaultdict(list)
    for (i, t, _), r in zip(odd_rows, root):
        by_root[r].append((i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted(map(min, by_root.values()))
    assert simhash.drop_near_duplicates(docs_of([])).collect() == []
    assert simhash.near_duplicates(docs_of([(None, None, "a")])).first().component_id is None
