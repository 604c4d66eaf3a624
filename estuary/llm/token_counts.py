"""Token counts of whole texts without their ids.

1. The ``HOT`` most frequent pre-tokens of a sample of ``SAMPLE_ROWS`` documents
   (both bounds) are broadcast with the pieces of each. The list only decides which
   of the two ways below a pre-token takes, never a count.
2. Every text is cut into words at ASCII white space, and every distinct word of a
   task into pre-tokens by the tokenizer file's own normaliser and pre-tokenizer.
   Broadcast counts times frequencies are summed on the spot; of the other
   pre-tokens each document keeps its frequencies.
3. The pieces of each distinct other pre-token are counted once, by the file's
   model, joined to the documents' frequencies by pre-token, and summed. The most
   frequent pre-tokens were broadcast and so are no keys of this join.

Only counts leave a task, never ids. A document is known by a row number that is
written with its sums before the join, so a retried task finds the same numbers.

A word that holds the string of an added token ("<|endoftext|>") is one pre-token:
the library counts its pieces as a whole, as it would inside the text.

Defined results: NULL and blank texts count 0 tokens; NULL and repeated doc_ids,
repeated rows and equal texts give one row each; other columns are ignored; an
empty table gives no rows. A text is held whole by one task, its words are not
limited in length. Works with tokenizer files of the tokenizers library that drop
white space (checked when the file is read); others are refused.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import materialize, rebatched, trimmed

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
HOT = 1 << 18  # pre-tokens that are broadcast
SAMPLE_ROWS = 1 << 14  # documents that name them
CACHE_WORDS = 400_000  # distinct words that a task holds
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# First character of a pre-token that is a word with an added token's string, or that the
# library has cut and mapped. No pre-token holds white space.
_WHOLE, _MAPPED = " ", "\t"


class PreTokenizer:
    """Words of texts, pre-tokens of words and pieces of pre-tokens, as the file has them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        t = self.tokenizer = Tokenizer.from_file(path)
        ids = lambda s: t.encode(s, add_special_tokens=False).ids
        if t.pre_tokenizer is None or ids(" A\n\tb \r") != ids("A") + ids("b"):
            raise ValueError(f"{path}: token counts need a tokenizer that drops white space")
        added = [re.escape(a.content.encode()) for a in t.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(added)) if added else re.compile(rb"(?!)")
        self.folds = self.normal("ABCDEFGHIJKLMNOPQRSTUVWXYZ") == "abcdefghijklmnopqrstuvwxyz"
        # The file's pattern cuts words of Latin, Greek and Cyrillic letters, whose classes all
        # versions of Unicode share; the library cuts the others (and those with a wide space).
        self.pattern = _pattern(json.loads(t.to_str())["pre_tokenizer"])
        odd = rb"[\xd4-\xff]|\xc2[\x85\xa0]" if self.pattern else rb""
        self.odd = re.compile(b"|".join([odd, *added]))
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text

    def words(self, raw: bytes) -> list[bytes]:
        """Words of a text; ASCII letters are folded if the tokenizer folds them."""
        if self.folds and not self.added.search(raw):
            raw = raw.translate(_LOWER)
        return raw.split()

    def _cut(self, word: bytes) -> list[str]:
        if self.added.search(word):
            return [_WHOLE + word.decode()]
        return [_MAPPED + p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.normal(word.decode()))]

    def split(self, words: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of all words, one after the other, and their number per word."""
        odd = list(map(self.odd.search, words))
        plain = [w for w, x in zip(words, odd) if x is None]
        tokens = self.pattern.findall(self.normal(b" ".join(plain).decode())) if plain else []
        ends = np.array([i for i, t in enumerate(tokens) if t == " "] + [len(tokens)] * bool(plain), np.int64)
        is_odd = np.fromiter((x is not None for x in odd), bool, len(words))
        per_word = np.zeros(len(words), np.int64)
        per_word[~is_odd] = np.diff(ends, prepend=-1) - 1
        if plain and not is_odd.any():
            return [t for t in tokens if t != " "], per_word
        out, at = [], np.concatenate(([0], ends + 1)).tolist()
        k = 0
        for i, x in enumerate(odd):
            if x is None:
                out += tokens[at[k]:at[k + 1] - 1]
                k += 1
            else:
                own = self._cut(words[i])
                per_word[i] = len(own)
                out += own
        return out, per_word

    def pieces(self, token: str) -> int:
        if token[0] == _WHOLE:
            return len(self.tokenizer.encode(token[1:], add_special_tokens=False).ids)
        if token[0] == _MAPPED:
            return len(self.tokenizer.model.tokenize(token[1:]))
        if not (token.isascii() and token.isprintable()):
            token = self.byte_level.pre_tokenize_str(token)[0][0]
        return len(self.tokenizer.model.tokenize(token))


def _pattern(pre: dict):
    """Compiled pattern of a pre-tokenizer that keeps what a pattern matches and then maps
    bytes to characters; a single space stands for the end of a word. None for others."""
    steps = pre.get("pretokenizers", [])
    if [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return None
    cut, mapped = steps
    text = cut["pattern"].get("Regex")
    keeps = cut["behavior"] == "Removed" and cut["invert"] and not (mapped["add_prefix_space"] or mapped["use_regex"])
    return regex.compile(f"{text}| ") if text and keeps else None


_loaded: dict[str, PreTokenizer] = {}


def _pre_tokenizer(path: str) -> PreTokenizer:
    if path not in _loaded:
        _loaded[path] = PreTokenizer(path)
    return _loaded[path]


# ---- pre-tokens ---------------------------------------------------------------------------------

def _frequencies(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(token, freq) of a task's texts, written whenever it holds CACHE_WORDS words."""
    pre, held = _pre_tokenizer(path), Counter()

    def flush():
        words = list(held)
        tokens, per_word = pre.split(words)
        freq: Counter[str] = Counter()
        times = np.repeat(np.fromiter(held.values(), np.int64, len(words)), per_word).tolist()
        for t, n in zip(tokens, times):
            freq[t] += n
        held.clear()
        return pa.record_batch([pa.array(list(freq), pa.string()), pa.array(list(freq.values()), pa.int64())],
                               names=["token", "freq"])

    for b in rebatched(batches, "text", 1 << 20):
        for t in b.column("text"):
            held.update(pre.words(t.as_buffer().to_pybytes() if t.is_valid else b""))
        if len(held) >= CACHE_WORDS:
            yield flush()
    if held:
        yield flush()


def _pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pre = _pre_tokenizer(path)
    for b in batches:
        n = [pre.pieces(t) for t in b.column("token").to_pylist()]
        yield pa.record_batch([*b.columns, pa.array(n, pa.int64())], names=["token", "freq", "n_pieces"])


def with_pieces(tokens: DataFrame, path: str) -> DataFrame:
    """(token, freq) rows of distinct pre-tokens with n_pieces."""
    return tokens.select("token", "freq").mapInArrow(lambda it: trimmed(_pieces(it, path)),
                                                     "token string, freq bigint, n_pieces bigint")


def frequent_pieces(docs: DataFrame, path: str, hot: int = HOT, sample_rows: int = SAMPLE_ROWS) -> dict[str, int]:
    """Pieces of the ``hot`` most frequent pre-tokens of about ``sample_rows`` documents."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.select("text").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    partial = sample.mapInArrow(lambda it: trimmed(_frequencies(it, path)), "token string, freq bigint")
    top = partial.groupBy("token").agg(F.sum("freq").alias("freq")).orderBy(F.col("freq").desc(), "token").limit(hot)
    found = with_pieces(top, path).select("token", "n_pieces").toArrow()
    return dict(zip(*(c.to_pylist() for c in found.columns)))


# ---- documents ----------------------------------------------------------------------------------

class _Sums:
    """Sums of the broadcast counts over texts, and the pre-tokens that have none.

    Word k of the table has the sum ``hot[k]`` and the other pre-tokens ``rest[k]``.
    The table keeps the first words it meets, which hold nearly all of the frequent
    ones, as far as they fit; others are cut where they occur."""

    def __init__(self, path: str, counts: dict[str, int]):
        self.pre, self.counts = _pre_tokenizer(path), counts
        self.known: dict[bytes, int] = {}
        self.hot, self.rest = array("q"), []

    def _learn(self, words: list[bytes]) -> dict[bytes, int]:
        tokens, per_word = self.pre.split(words)
        n = np.fromiter(map(self.counts.get, tokens, repeat(-1)), np.int64, len(tokens))
        ends = np.cumsum(per_word)
        total = np.concatenate(([0], np.cumsum(np.maximum(n, 0))))
        rest: list[tuple] = [()] * len(words)
        other = np.flatnonzero(n < 0)
        for k, i in zip(other.tolist(), np.searchsorted(ends, other, "right").tolist()):
            rest[i] += (tokens[k],)
        first = len(self.rest)
        self.hot.frombytes((total[ends] - total[ends - per_word]).tobytes())
        self.rest += rest
        return dict(zip(words, range(first, first + len(words))))

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, list[Counter]]:
        """Sum of the broadcast counts and frequencies of the other pre-tokens per text."""
        words, ends = [], []
        for t in texts:
            words += self.pre.words(t)
            ends.append(len(words))
        which = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        kept = len(self.rest)
        holes = np.flatnonzero(which < 0).tolist()
        if holes:
            missing = [words[i] for i in holes]
            new = self._learn(list(dict.fromkeys(missing)))
            which[holes] = np.fromiter(map(new.__getitem__, missing), np.int64, len(missing))
            if kept + len(new) <= CACHE_WORDS:
                self.known |= new
                kept += len(new)
        total = np.concatenate(([0], np.cumsum(np.array(self.hot, np.int64)[which])))
        sums = np.diff(total[ends], prepend=0)
        rest: list[Counter] = [Counter() for _ in texts]
        has = np.fromiter(map(bool, self.rest), bool, len(self.rest))
        at = np.flatnonzero(has[which])
        for i, k in zip(np.searchsorted(ends, at, "right").tolist(), which[at].tolist()):
            rest[i].update(self.rest[k])
        del self.hot[kept:], self.rest[kept:]
        return sums, rest


_BASE = "doc_id bigint, n_bytes bigint, n bigint, tokens array<string>, times array<bigint>"


def _sum_hot(batches: Iterator[pa.RecordBatch], path: str, counts: dict[str, int]) -> Iterator[pa.RecordBatch]:
    sums = _Sums(path, counts)
    for b in rebatched(batches, "text", 1 << 20):
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in b.column("text")]
        n, rest = sums.of(texts)
        yield pa.record_batch(
            [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n),
             pa.array([list(c) for c in rest], pa.list_(pa.string())),
             pa.array([list(c.values()) for c in rest], pa.list_(pa.int64()))],
            names=["doc_id", "n_bytes", "n", "tokens", "times"])


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every document."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, hot))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        lambda it: trimmed(_sum_hot(it, path, frequent.value)), _BASE)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "pretoken-rows")
    rare = rows.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("t")).select(
        "row", F.col("t.tokens").alias("token"), F.col("t.times").alias("times"))
    counts = with_pieces(rare.groupBy("token").agg(F.sum("times").alias("freq")), path)
    counted = rare.join(counts.select("token", "n_pieces"), "token").select(
        "row", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("n_bytes"),
        (F.col("times") * F.col("n_pieces")).alias("n"))
    return (rows.select("row", "doc_id", "n_bytes", "n").unionByName(counted).groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
