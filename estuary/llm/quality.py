"""Quality classifier: regularised quadratic discriminant analysis.

A document becomes a vector of transformed statistics. Per class, a mean and a
covariance are estimated from all labelled training rows by one distributed sum
of moments (a few hundred numbers reach the driver, whatever the corpus size).
The covariance is shrunk twice: towards the pooled covariance, then towards its
own diagonal. The score is the posterior of label 1 from the difference of the
two Mahalanobis log densities; each class keeps the inverse of its Cholesky
factor, so scoring a batch is one matrix product per class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import id_crc32, release_memory

HOLD_OUT = (5, 0)  # rows whose crc32(doc_id) % 5 is 0 are never trained on
POOL = 0.8  # weight of the pooled covariance
DIAGONAL = 0.1  # weight of the diagonal
THRESHOLD = 0.3

FEATURES = ("log_chars", "log_words", "mean_word_len", "symbol", "upper", "digit", "sentence_mark", "other_punct",
            "line_breaks", "distinct_words", "adjacent_repeats", "top_word", "letters")

# Byte classes: 0 other, 1 upper-case ASCII letter, 2 lower-case letter or part of a
# multi-byte character, 3 digit, 4 symbol, 5 sentence mark, 6 other punctuation, 7 line feed.
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[128:] = 2
_CLASS[48:58] = 3
for _b in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _CLASS[_b] = 6
for _b in b"#*$%&|<>!@^~_=+{}[]\\":
    _CLASS[_b] = 4
for _b in b".,;:?":
    _CLASS[_b] = 5
_CLASS[10] = 7


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of one whole text. Shares enter as arcsine square
    roots, lengths as logarithms. NULL counts as the empty text, whose shares are 0."""
    raw = (text or "").encode()
    words = raw.lower().split()
    n, n_bytes = len(words), len(raw)
    by_class = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8)
    ink = max(n_bytes - int(by_class[0]) - int(by_class[7]), 1)
    if n:
        counts = Counter(words)
        distinct, top = len(counts) / n, max(counts.values()) / n
        repeats = sum(map(eq, words, islice(words, 1, None))) / max(n - 1, 1)
    else:
        distinct = top = repeats = 0.0
    # the distinct share falls with length in any text: compare with the square root law
    distinct = min(distinct * np.sqrt(1 + n / 200.0), 2.0) / 2.0
    top = top * min(1.0, n / 20.0)  # one of few words is no sign of repetition
    shares = np.array([by_class[4] / ink, by_class[1] / ink, by_class[3] / ink, by_class[5] / max(n, 1) / 4,
                       by_class[6] / ink, by_class[7] / max(n, 1), distinct, repeats, top, by_class[2] / ink])
    bent = np.arcsin(np.sqrt(np.clip(shares, 0.0, 1.0)))
    return np.concatenate(([np.log1p(n_bytes), np.log1p(n), np.log1p(ink / max(n, 1))], bent))


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))


@dataclass(frozen=True)
class Discriminant:
    """Fitted model: per class (label 0, 1) the log prior with normaliser, the mean
    and the inverse Cholesky factor; all bounded by the number of features."""
    shift: np.ndarray
    scale: np.ndarray
    mean: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]
    offset: tuple[float, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of label 1, from 0 to 1, for each row of statistics."""
        z = (x - self.shift) / self.scale
        log_density = [self.offset[c] - 0.5 * np.square((z - self.mean[c]) @ self.whiten[c].T).sum(1) for c in (0, 1)]
        return 1.0 / (1.0 + np.exp(np.clip(log_density[0] - log_density[1], -700, 700)))

    def score(self, text: Column) -> Column:
        @F.pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(self.scores(_matrix(s)))
            release_memory()

        return of(text)


def from_moments(n: np.ndarray, s1: np.ndarray, s2: np.ndarray, pool: float = POOL,
                 diagonal: float = DIAGONAL) -> Discriminant:
    """Model from per-class counts (2), sums (2, d) and sums of products (2, d, d).

    A class without rows takes the pooled moments and half the weight of a row
    as its prior; without any labelled row every score is 0.5.
    """
    d, total = s1.shape[1], max(n.sum(), 1.0)
    shift = s1.sum(0) / total
    pooled = s2.sum(0) / total - np.outer(shift, shift)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    within = np.zeros((d, d))
    means, covs = [], []
    for c in (0, 1):
        m = s1[c] / n[c] if n[c] else shift
        cov = s2[c] / n[c] - np.outer(m, m) if n[c] else pooled
        means.append((m - shift) / scale)
        covs.append(cov / np.outer(scale, scale))
        within += covs[-1] * (n[c] / total)
    whiten, offset = [], []
    for c in (0, 1):
        cov = (1 - pool) * covs[c] + pool * within
        cov = (1 - diagonal) * cov + diagonal * (np.diag(np.diag(cov)) + 0.05 * np.eye(d))
        factor = np.linalg.cholesky(cov + 1e-6 * np.eye(d))
        whiten.append(np.linalg.inv(factor))
        offset.append(float(np.log(max(n[c], 0.5) / max(total, 1.0)) - np.log(np.diag(factor)).sum()))
    return Discriminant(shift, scale, tuple(means), tuple(whiten), tuple(offset))


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y): one label per document; NULLs are left out, a document with
    conflicting labels takes the majority (a tie counts as 1)."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull()).groupBy("doc_id")
            .agg((F.avg(F.col(name).cast("double")) >= 0.5).cast("int").alias("y")))


def held_out(doc_id: str = "doc_id", split: tuple[int, int] = HOLD_OUT) -> Column:
    return id_crc32(doc_id) % split[0] == split[1]


def fit(docs: DataFrame, labels: DataFrame, pool: float = POOL, diagonal: float = DIAGONAL) -> Discriminant:
    """Fit on every labelled document outside the hold-out split.

    Statistics are computed before the join with the labels, so texts are not
    shuffled. Moments are summed per class by Arrow batches inside each task and
    then by Spark.
    """
    d = len(FEATURES)

    @F.pandas_udf("array<double>")
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(_matrix(s)))
        release_memory()

    def moments(batches):
        n, s1, s2 = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for b in batches:
            y, x = b["y"].to_numpy(), np.array(b["x"].to_list()).reshape(-1, d)
            for c in (0, 1):
                xc = x[y == c]
                n[c] += len(xc)
                s1[c] += xc.sum(0)
                s2[c] += xc.T @ xc
        values = np.concatenate((n, s1.ravel(), s2.ravel()))
        yield pd.DataFrame({"k": np.arange(len(values)), "v": values})

    rows = (docs.where(~held_out()).select("doc_id", stats("text").alias("x"))
            .join(one_label(labels, "quality"), "doc_id").select("y", "x"))
    sums = rows.mapInPandas(moments, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    v = np.zeros(2 + 2 * d + 2 * d * d)  # fixed size: features only
    for r in sums:
        v[r["k"]] = r["v"]
    return from_moments(v[:2], v[2:2 + 2 * d].reshape(2, d), v[2 + 2 * d:].reshape(2, d, d), pool, diagonal)


def classify(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (NULL text scores as
    the empty text; repeated rows give repeated rows)."""
    return (docs.select("doc_id", held_out().alias("held_out"), model.score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, columns unchanged."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                         model.score(F.col("text")).alias("_score"))
    return packed.where(F.col("_score") >= threshold).select(
        *[F.col("_doc").getField(c).alias(c) for c in docs.columns])
