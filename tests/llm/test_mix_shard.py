"""Mixing and sharding against plain-Python versions."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from estuary.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def n_words(t):
    return len(WORD.findall(t or ""))


def poured(sizes, weights=(5.0, 2.0, 1.0), share=1.5, cap=2):
    """Targets by repeated sharing of the rest until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        rest = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        part = {s: cap * sizes[s] if s in full else rest * w[s] / sum(w[x] for x in names if x not in full) for s in names}
        over = {s for s in names if s not in full and part[s] > cap * sizes[s]}
        if not over:
            return part
        full |= over


def test_mix_matches_plain_python(docs_of, odd_rows):
    out = mixing.mix(mixing.document_sizes(docs_of(odd_rows))).collect()
    sizes = Counter()
    for _, t, s in odd_rows:
        sizes[s] += n_words(t)
    target = poured(sizes)
    by_source = defaultdict(list)
    for i, t, s in odd_rows:
        key = hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest()
        by_source[s].append((key, -1 if i is None else i, n_words(t), i))
    expect = Counter()
    for s, rows in by_source.items():
        epochs, rest = divmod(round(target[s]), sizes[s]) if sizes[s] else (0, 0)
        for _, _, n, i in sorted(rows, key=lambda r: r[:3]):
            expect[i, n, s, epochs * n + max(0, min(n, rest))] += 1
            rest -= n
    assert Counter((r.doc_id, r.size, r.source, r.taken) for r in out) == expect
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source]) and r.taken <= 2 * r.size
    for s in sizes:
        assert abs(sum(r.taken for r in out if r.source == s) - target[s]) <= 0.5


def test_apply_mix_repeats_and_cuts(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    taken = {}
    for r in mixing.mix(mixing.document_sizes(docs)).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    got = Counter()
    originals = defaultdict(set)
    for i, t, s in odd_rows:
        originals[i, s].add(t)
    for r in rows:
        got[r.source] += n_words(r.text)
        assert any(r.text == t or (t or "").startswith(r.text) for t in originals[r.doc_id, r.source])
    assert all(got[s] == n for s, n in taken.items())


def test_first_words(spark):
    text = " \n a  b\tc d "
    for n, want in ((1, " \n a"), (2, " \n a  b"), (3, " \n a  b\tc"), (4, text), (9, text)):
        row = spark.createDataFrame([(text, n)], "t string, n bigint").select(
            mixing.first_words(F.col("t"), F.col("n")).alias("x")).first()
        assert row.x == want


def test_mix_empty_and_wordless(docs_of):
    assert mixing.mix(mixing.document_sizes(docs_of([]))).collect() == []
    rows = mixing.mix(mixing.document_sizes(docs_of([(1, None, "a"), (2, "", None)]))).collect()
    assert [(r.taken, r.target) for r in rows] == [(0, 0.0)] * 2


def test_sharding(docs_of, odd_rows):
    rows = sharding.shard_documents(docs_of(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == sizes
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert sharding.shard_documents(docs_of([])).collect() == []


def test_tree_moves_only_between_changed_subtrees(spark):
    ids = spark.range(20_000).withColumn("k", F.col("id").cast("string"))
    tree = sharding.TREE16
    heavier = tuple((a, b, s, 3.0 if s == 5 else w) for a, b, s, w in tree)
    out = sharding.assign(sharding.assign(ids, F.col("k"), tree, "a"), F.col("k"), heavier, "b").collect()
    share = Counter(r.a for r in out)
    assert all(abs(n / 20_000 - 1 / 16) < 0.01 for n in share.values())
    grown = Counter(r.b for r in out)
    assert abs(grown[5] / 20_000 - 3 / 18) < 0.02
    region = lambda s: s // 8
    for r in out:  # shard 5 is in region 0: nothing moves out of it or inside region 1
        if region(r.a) == 0 and r.a != r.b:
            assert region(r.b) == 0 and r.b in (4, 5, 6, 7)
        if region(r.a) == 1:
            assert r.a == r.b or region(r.b) == 0
