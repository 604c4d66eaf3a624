"""Piece lattices and the token store: round trips, distributions, random access."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from estuary.llm import pieces, token_store

ALPHABET = ["a", "B", "é", "é", "İ", "Σ", "ς", " ", " ", "\n", "\t", "\x85", "\x1c", "'s", "'", "1", "²", "<|endoftext|>",
            "<|ENDOFTEXT|>", "<|", "中", "　", "!", "\u0301", "ß", "\u212a", "\x00", "ﬁ", "␞", "▁", "😀", "the", "  "]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 15))) for _ in range(n)]


# ---- pieces ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def sampler():
    return pieces.Sampler(public_tokenizers.path(pieces.MODEL))


def test_pieces_round_trip_any_text(sampler):
    texts = [*random_texts(3000), "z" * 20_000 + "ü" * 5_000, None, ""]
    ids, n = sampler.encode(texts, np.arange(len(texts), dtype=np.uint64))
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends):
        assert sampler.decode(ids[a:b].tolist()) == (t or "")


def test_segmentations_follow_the_lattice(sampler):
    v = sampler.vocabulary

    def every(unit):
        if not unit:
            yield (), 1.0
        for j in range(1, len(unit) + 1):
            k = v.ids.get(unit[:j])
            if k is not None:
                for rest, p in every(unit[j:]):
                    yield (k, *rest), p * math.exp(sampler.log_w[k])

    n = 30_000
    ids, per = sampler.encode(["theory"] * n, np.arange(n, dtype=np.uint64))
    ends = np.cumsum(per)
    seen = Counter(tuple(ids[e - k:e].tolist()) for e, k in zip(ends, per))
    exact = dict(every(" theory"))
    total = sum(exact.values())
    assert set(seen) <= set(exact)
    for s, p in exact.items():
        assert abs(seen[s] / n - p / total) < 4 * math.sqrt(p / total / n) + 1e-4


def test_pieces_do_not_depend_on_batches_or_the_table(sampler):
    texts = random_texts(200, 4) + ["some longer words in a row, repeated words in a row"]
    seeds = np.arange(len(texts), dtype=np.uint64)
    whole = sampler.encode(texts, seeds)
    tiny = pieces.Sampler(public_tokenizers.path(pieces.MODEL), cache=5)
    parts = [tiny.encode(texts[i:i + 1], seeds[i:i + 1]) for i in range(len(texts))]
    assert np.array_equal(whole[0], np.concatenate([p[0] for p in parts]))
    assert np.array_equal(whole[1], np.concatenate([p[1] for p in parts]))


def test_encode_and_decode_tables(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    one = pieces.decode(pieces.encode(docs, keep=["doc_id", "text", "size", "ids"])
                        .withColumnRenamed("text", "before")).collect()
    assert len(one) == len(odd_rows) and all((r.before or "") == r.text for r in one)
    key = lambda rows: sorted((r.doc_id or -1, tuple(r.ids)) for r in rows)
    again = pieces.encode(docs.repartition(7)).collect()
    other = pieces.encode(docs, seed=1).collect()
    assert key(one) == key(again) != key(other)
    assert pieces.encode(docs_of([])).collect() == []


# ---- token store -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(token_store.TOKENIZER))


def test_word_table_equals_the_library(tokenizer):
    path = public_tokenizers.path(token_store.TOKENIZER)
    for encoder in (token_store.WordEncoder(path), token_store.WordEncoder(path, cache=10)):
        for seed in range(3):
            texts = random_texts(700, seed)
            ids, n = encoder.encode(texts)
            want = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
            assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("kind", ["runs", "periods", "random", "tiny", "empty documents"])
def test_grammar_round_trip_and_random_access(kind):
    rng = np.random.default_rng(0)
    body = {"runs": np.repeat(rng.integers(2, 9, 300), rng.integers(1, 90, 300)),
            "periods": np.tile(rng.integers(2, 50, 37), 400), "random": rng.integers(2, 49_408, 5000),
            "tiny": np.array([5]), "empty documents": np.array([], int)}[kind].astype(np.uint32)
    cuts = np.sort(rng.integers(0, len(body) + 1, 20))
    docs = [np.append(d, 1).astype(np.uint32) for d in np.split(body, cuts)]
    ids, per = np.concatenate(docs), np.array(list(map(len, docs)))
    block = token_store.Block(token_store.pack([None, *range(len(docs) - 1)], ids, per, 49_408))
    assert np.array_equal(block.all_ids(), ids) and block.doc_ids == [None, *range(len(docs) - 1)]
    if kind in ("runs", "periods"):
        assert len(block.symbols) < len(ids) / 4 and len(block.rules)
    for i, d in enumerate(docs):
        assert np.array_equal(block.document(i), d)
        for _ in range(5):
            a, b = sorted(rng.integers(0, len(d) + 2, 2).tolist())
            assert np.array_equal(block.document(i, a, b), d[a:b])
    for (a, b), n in zip(block.rules.tolist(), block.lengths.tolist()):
        assert n == sum(1 if s < block.base else int(block.lengths[s - block.base]) for s in (a, b))


def test_the_most_frequent_pair_goes_first():
    ids = np.array([7, 8] * 50 + [7, 9] * 20 + [1], np.uint32)
    closes = np.zeros(len(ids), bool)
    closes[-1] = True
    symbols, rules, lengths = token_store.compress(ids, closes, 100, rounds=1, per_round=1, min_count=2)
    assert rules.tolist() == [[7, 8]] and lengths.tolist() == [2] and (symbols == 100).sum() == 50


def test_token_digests(docs_of, odd_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 500)
    out = token_store.token_digests(docs_of(odd_rows)).collect()
    want = Counter()
    for i, t, _ in odd_rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(out, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert token_store.token_digests(docs_of([])).collect() == []


def test_blocks_survive_a_read_of_the_store(spark, docs_of, tmp_path):
    rows = [(i, f"word{i % 7} again and again {i}", "s") for i in range(300)]
    path = token_store.write_tokens(docs_of(rows), str(tmp_path / "store"))
    blocks = spark.read.parquet(path)
    assert blocks.agg(F.sum("n_docs")).first()[0] == 300
    with pytest.raises(ValueError):
        token_store.Block(b"\0" * 64)


def test_pairs_are_replaced_until_none_is_frequent():
    """Twenty copies of each of ten documents become one symbol each; elsewhere no pair occurs 16 times."""
    rng = np.random.default_rng(4)
    copies = np.tile(np.hstack((rng.integers(2, 40_000, (10, 400)), np.ones((10, 1), int))), (20, 1))
    words = np.append((rng.pareto(1.0, 60_000) * 3).astype(int) + 2, 1)
    ids = np.concatenate((copies.ravel(), words)).astype(np.uint32)
    closes = np.zeros(len(ids), bool)
    closes[400:copies.size:401] = closes[-1] = True
    symbols, rules, lengths = token_store.compress(ids, closes, 1 << 25)
    assert np.array_equal(token_store.expand(symbols, rules, lengths, 1 << 25), ids)
    ends = np.cumsum([1 if s < 1 << 25 else int(lengths[s - (1 << 25)]) for s in symbols.tolist()])
    assert np.searchsorted(ends, copies.size) + 1 == 200
    inside = ~closes[ends[:-1] - 1]
    assert Counter(zip(symbols[:-1][inside].tolist(), symbols[1:][inside].tolist())).most_common(1)[0][1] < 16


def test_plain_words_are_encoded_as_the_library_does():
    """Words that go straight to the model: Latin-1 letters of both cases, any ASCII punctuation after them;
    words that look like them but are not (marks, other letters, apostrophes, longer tails)."""
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    words = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) + "".join(rng.choices(marks, k=rng.randrange(6)))
             for _ in range(4000)]
    words += ["ét́e", "don't", "x'll", "ÿ÷", "×a", "İi", "Ÿa", "ſs", "a b", "b.c", "7th", "", "a" * 5000]
    encoder = token_store.WordEncoder(public_tokenizers.path(token_store.TOKENIZER), cache=1500)
    assert encoder.mapped is not None
    for texts in (words, [" ".join(words), None, " ".join(words[:50])], words[::-1]):
        ids, n = encoder.encode(texts)
        want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert ids.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]


def test_distinct_codes_that_share_slots():
    rng = np.random.default_rng(2)
    code = rng.integers(0, 1 << 60, 500).astype(np.uint64)[rng.integers(0, 500, 20_000)]
    for slot in (code % np.uint64(7), code >> np.uint64(45), code % np.uint64(1 << 18)):
        got = token_store._distinct(code, slot.astype(np.intp) % (1 << 18))
        for a, b in zip(got, np.unique(code, return_inverse=True, return_counts=True)):
            assert np.array_equal(a, b)
    nothing = token_store._distinct(np.empty(0, np.uint64), np.empty(0, np.intp))
    assert [len(x) for x in nothing] == [0, 0, 0]


def test_nested_rules_expand_level_by_level():
    base, rng = 10, np.random.default_rng(3)
    rules = np.array([[rng.integers(0, base + k), rng.integers(max(0, base + k - 2), base + k)] for k in range(40)],
                     np.uint32)
    plain = [[i] for i in range(base)]
    for a, b in rules.tolist():
        plain.append(plain[a] + plain[b])
        if len(plain[-1]) > 5000:
            break
    rules = rules[:len(plain) - base]
    lengths = token_store.rule_lengths(rules, base)
    assert lengths.tolist() == [len(p) for p in plain[base:]]
    symbols = rng.integers(0, len(plain), 60).astype(np.uint32)
    assert token_store.expand(symbols, rules, lengths, base).tolist() == sum((plain[s] for s in symbols), [])
