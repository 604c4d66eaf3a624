"""Prefix trie of rebuilt conversations against a plain dictionary of prefixes."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from estuary.llm import trie

SCHEMA = ("conv_id bigint, turn bigint, role string, text string, path string, lens string, shard string, depth string, "
          "skeleton string")
EXTRA = ("extra",) * 5


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def digest(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def plain(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t, (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, p in built.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, set()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if built[c] == p)))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), leaves[p],
                 saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(members)
    return out


def some_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.05:
            continue  # absent, first conversations of a hundred too
        hot = rng.random() < 0.35
        for t in range(3 if hot else rng.randrange(0, 9)):
            text = f"same {t}" if hot else rng.choice(["a", "bé", "longer text"]) * (1 + t)
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    long = [(i % 7, f"turn {i}") for i in range(300)]
    for c, last in ((1003, "x"), (1004, "y"), (1005, "x")):
        rows += [(c, i, f"r{r}", t) for i, (r, t) in enumerate(long)] + [(c, 300, "user", last)]
    return rows


@pytest.mark.parametrize("shard_turns,skeleton_bytes", [(400_000, 1 << 24), (150, 1 << 24), (40, 4096), (7, 512)])
def test_trie_matches_all_prefixes(spark, shard_turns, skeleton_bytes):
    rows = some_rows(1)
    rows += [(None, 0, "user", "no id"), (7, None, "user", "before"), (9, 2, None, None), (9, 2, "user", ""),
             (11, 1, "user", "twice"), (11, 1, "user", "twice"), (-5, 0, "user", "below zero"), (-100, 0, "user", "base")]
    rows += [(c, 0, None, "😀 one turn") for c in range(600, 660)]  # h cuts the only turn of most
    out = trie.prefix_trie(table_of(spark, rows), shard_turns, 1, skeleton_bytes).collect()
    got = [tuple(r) for r in out]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows)


def test_copies_over_many_shards_and_a_leaf_in_the_skeleton(spark):
    """Equal conversations: every shard border lies inside one group of copies."""
    rows = [(c, t, "user", f"t{t}") for c in range(500) for t in range(7)]
    assert {tuple(r) for r in trie.prefix_trie(table_of(spark, rows), 60, 1).collect()} == plain(rows)


def test_empty_and_single(spark):
    assert trie.prefix_trie(table_of(spark, [])).collect() == []
    one = [(5, 0, "user", "hi")]
    assert {tuple(r) for r in trie.prefix_trie(table_of(spark, one)).collect()} == plain(one)


def test_skeleton_holds_every_node_that_two_shards_share(spark):
    paths = trie.materialize(trie.rebuilt_paths(table_of(spark, some_rows(2))), "t")
    sk, _ = trie.make_skeleton(paths, 60, 1, 2048)
    assert len(sk.node) * trie.WIDTH <= 2048 + 16
    seen = defaultdict(set)
    for r in paths.collect():
        shard = sk.shard(bytes(r.path), r.conv_id)
        for d in range(len(r.path) // trie.WIDTH + 1):
            seen[bytes(r.path[:d * trie.WIDTH])].add(shard)
    assert max(map(len, seen.values())) > 3
    assert all(p in sk.node for p, shards in seen.items() if len(shards) > 1)
