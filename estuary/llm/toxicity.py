"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed words, word pairs and pairs with one word left
out (presence, not counts, so a long text does not drown a single insult). FTRL
keeps a step size per coordinate and an L1 threshold that holds most weights at
exactly zero; the result is a short list of weights that is shipped with the
scoring function.

Training: the labelled rows outside the hold-out split, at most ``max_rows`` of
them (the smallest id hashes, so the choice does not depend on partitioning).
A round deals their texts to ``SHARDS`` tasks, each of which runs FTRL over its
rows several times; then the shards' states are averaged per coordinate and the
next round starts from the average.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import id_crc32, id_text, materialize, release_memory
from estuary.llm.quality import one_label

HOLD_OUT = (3, 1)  # rows whose crc32(doc_id) % 3 is 1 are never trained on
BITS = 20  # 2**20 hashed coordinates
THRESHOLD = 0.7
PAIR_VALUE = 0.5
MAX_ROWS = 16_000  # labelled rows that training reads at most
SHARDS = 4
ROUNDS, PASSES = 3, 3  # averaging rounds, passes of each round
ALPHA, BETA, L1, L2 = 5.0, 1.0, 2.0, 0.0
_STRIP = b".,;:!?\"'()[]{}<>*#$%&|-_~`"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MIX = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 14  # coordinates that travel as one binary value
_BLOCKS = "block int, z binary, n binary"
CACHE_WORDS = 100_000
_word_hashes: dict[bytes, int] = {}


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased and outer punctuation taken off.
    Hashes of words seen before come from a bounded cache of the Python worker."""
    words = (text or "").encode().translate(_LOWER).split()
    known = _word_hashes
    if len(known) > CACHE_WORDS:
        known.clear()
    out = list(map(known.get, words))
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                w = words[i]
                out[i] = known[w] = xxhash.xxh64_intdigest(w.strip(_STRIP), 7)
    return np.array(out, np.uint64)


def coordinates(text: str | None, bits: int = BITS) -> np.ndarray:
    """Sorted distinct coordinates of a text: words in the lower half of the
    space; pairs, and pairs around one word, in the upper half."""
    h = word_hashes(text)
    shift, half = np.uint64(65 - bits), np.uint64(1 << (bits - 1))
    with np.errstate(over="ignore"):
        pair = (h[:-1] * _MIX + h[1:]) * _MIX
        skip = (h[:-2] * _MIX ^ (h[2:] + np.uint64(1))) * _MIX
        pairs = (np.concatenate((pair, skip)) >> shift) + half
        return np.unique(np.concatenate(((h * _MIX) >> shift, pairs))).astype(np.int32)


def values(at: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Input value of each present coordinate: pairs count less than words, which
    makes them dearer under the L1 term. The intercept (last) counts 1."""
    return np.where((at >= 1 << (bits - 1)) & (at < 1 << bits), PAIR_VALUE, 1.0)


@dataclass
class Ftrl:
    """State per coordinate: z (shifted gradient sum) and n (squared gradient sum)."""
    z: np.ndarray
    n: np.ndarray

    @classmethod
    def empty(cls, bits: int = BITS) -> Ftrl:
        return cls(np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1))  # the last one is the intercept

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, y: int) -> None:
        """One proximal step on the row whose present coordinates are ``at``."""
        w, x = self.weights(at), values(at)
        g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


@dataclass(frozen=True)
class Weights:
    """The nonzero weights (times the input value), ascending by coordinate, and the intercept."""
    at: np.ndarray
    value: np.ndarray
    intercept: float
    bits: int = BITS

    def scores(self, texts: pd.Series) -> np.ndarray:
        dense = np.zeros((1 << self.bits), np.float32)
        dense[self.at] = self.value
        margin = np.array([dense[coordinates(t, self.bits)].sum(dtype=np.float64) for t in texts], np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(margin + self.intercept, -700, 700)))

    def score(self, text: Column) -> Column:
        @F.pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(self.scores(s))
            release_memory()

        return of(text)


def held_out(doc_id: str = "doc_id", split: tuple[int, int] = HOLD_OUT) -> Column:
    return id_crc32(doc_id) % split[0] == split[1]


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(shard, ord, y, tie, text): at most ``max_rows`` labelled rows outside the
    hold-out split, chosen by id hash on the labels alone."""
    hash_of = F.xxhash64(id_text("doc_id"))
    chosen = (one_label(labels, "toxic").where(~held_out()).withColumn("ord", hash_of)
              .orderBy("ord", "doc_id").limit(max_rows))

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_rows rows of three numbers
    # one text for each chosen id, however often it is repeated
    rows = rows.groupBy("doc_id", "ord", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return rows.select((F.pmod("ord", F.lit(SHARDS))).cast("int").alias("shard"), "ord", "y",
                       F.xxhash64("text").alias("tie"), "text")


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mean change of each coordinate of a block over the shards that moved it."""
    z, n = (np.array([np.frombuffer(x, np.float32) for x in pdf[c]], np.float64) for c in ("z", "n"))
    moved = np.maximum((n != 0).sum(0), 1)
    return pd.DataFrame({"block": pdf["block"].iloc[:1], "z": [(z.sum(0) / moved).tobytes()],
                         "n": [(n.sum(0) / moved).tobytes()]})


def _round_of(state: Ftrl, k: int, passes: int):
    """FTRL passes over a shard's rows, each in an order drawn from its number;
    returns the change of the state in blocks of coordinates."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s = Ftrl(state.z.copy(), state.n.copy())
        pdf = pdf.sort_values(["ord", "tie"], kind="stable")
        last = len(s.z) - 1
        xs = [np.append(coordinates(t), np.int32(last)) for t in pdf["text"]]
        ys = pdf["y"].tolist()
        for e in range(passes):
            for i in np.random.default_rng(k * passes + e).permutation(len(xs)):
                s.learn(xs[i], ys[i])
        xs = None
        release_memory()
        dz, dn = (s.z - state.z).astype(np.float32), (s.n - state.n).astype(np.float32)
        blocks = range(0, len(dz), BLOCK)
        return pd.DataFrame({"block": range(len(blocks)), "z": [dz[i:i + BLOCK].tobytes() for i in blocks],
                             "n": [dn[i:i + BLOCK].tobytes() for i in blocks]})

    return run


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, rounds: int = ROUNDS,
        passes: int = PASSES) -> Weights:
    """Train and return the sparse weights. Without labelled rows of both kinds
    every weight is zero and every score is the intercept's."""
    rows = materialize(training_rows(docs, labels, max_rows), "toxicity")
    state = Ftrl.empty()
    for k in range(rounds):
        moved = (rows.groupBy("shard").applyInPandas(_round_of(state, k, passes), _BLOCKS)
                 .groupBy("block").applyInPandas(_average, _BLOCKS).collect())  # 2**BITS + 1 pairs of numbers
        z, n = state.z.copy(), state.n.copy()
        for r in moved:
            at = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
            z[at] += np.frombuffer(r["z"])
            n[at] += np.frombuffer(r["n"])
        state = Ftrl(z, n)
    w = state.weights()
    at = np.flatnonzero(w[:-1])
    return Weights(at.astype(np.int32), (w[at] * values(at)).astype(np.float32), float(w[-1]))


def classify(docs: DataFrame, model: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (NULL text scores as
    the empty text; repeated rows give repeated rows)."""
    return (docs.select("doc_id", held_out().alias("held_out"), model.score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_clean(docs: DataFrame, model: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, columns unchanged."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                         model.score(F.col("text")).alias("_score"))
    return packed.where(F.col("_score") < threshold).select(
        *[F.col("_doc").getField(c).alias(c) for c in docs.columns])
