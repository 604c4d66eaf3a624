"""Approximate nearest neighbours: multiprobe p-stable hashing.

Each of ``TABLES`` hash tables projects a vector on a few Gaussian directions and
cuts every projection into bins of width ``WIDTH``; the bins are the bucket. A
query visits perturbed buckets in the order of their estimated success: given its
own projection u, the projection of a neighbour of cosine s is normal with mean
s*u and variance 1 - s*s, so a bucket's success is a product of interval masses.
It goes on until the visited buckets hold ``SUCCESS`` of the mass in each table. A
query that would need more than ``MAX_PROBES`` buckets for that visits none; it is
compared with every row.
The candidates of all tables are merged and ranked by the exact inner product of
the original vectors in double precision.

Inner products of vectors of unequal length are reduced to cosines by one more
component (sqrt(1 - |x|^2 / max|x|^2)), which no query has.

The index is fitted on a bounded sample (``SAMPLE`` vectors, smallest id hashes).
It gives each query the cosine s to expect at rank k, from the query's own scores
there: the best that, with 95% certainty, k rows of the table reach. So a group of
copies changes what its own members expect and nothing for others. The sample also
gives each query a floor, its 3k/2-th best score there: only better candidates leave
their bucket. The
number of directions follows the number of rows, so that buckets hold about
``BUCKET_ROWS`` rows, up to the size where queries begin to need more than
``MAX_PROBES`` buckets. From there on it is the number that has the fewest rows
compared for queries of the sample, and buckets may grow.
A bucket with more rows than ``BLOCK``, or more queries, is dealt into blocks;
every block of its rows meets every block of its queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estuary.llm.common import materialize

K = 20
TABLES = 2
WIDTH = 1.0
SUCCESS = 0.72  # estimated mass visited in each table
SAMPLE = 8192
MISSED = 0.05  # share of queries that may expect a higher cosine than that of rank k
BUCKET_ROWS = 2048
BLOCK = 4096
MAX_PROBES = 4096  # buckets visited by a query in a table at most; one that needs more is compared with every row
PILOTS = 64  # queries of the sample that try a number of directions
_BIN_NATS = 1.42 - math.log(WIDTH)  # entropy of a unit normal cut into bins of that width
_erf = np.frompyfunc(math.erf, 1, 1)


@dataclass(frozen=True)
class Index:
    """Projections of all tables, and what the probe order needs. ``cosine`` is the
    expected cosine at rank k where a query has none of its own, ``longest`` the largest
    norm of a vector, ``rank`` the rank in the sample that stands for rank k of all rows."""
    directions: np.ndarray  # (tables, bins per bucket, dim + 1)
    offset: np.ndarray  # (tables, bins per bucket)
    cosine: float
    longest: float
    sample_ids: np.ndarray
    sample: np.ndarray
    rank: int = K

    def expect(self, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query, from its scores in the sample without its own row: the floor,
        a score that more than k rows are sure to reach (its 3k/2-th best; -inf in a
        small sample), and the expected cosine at rank k (``cosine`` in a small sample)."""
        s = x @ self.sample.T
        s[ids[:, None] == self.sample_ids[None, :]] = -np.inf
        at = [s.shape[1] - (k + (k + 1) // 2), s.shape[1] - self.rank]
        s = np.partition(s, [i for i in at if i > 0], axis=1) if max(at) > 0 else s
        floor = s[:, at[0]] if at[0] > 0 else np.full(len(ids), -np.inf)
        if at[1] <= 0:
            return floor, np.full(len(ids), self.cosine)
        return floor, np.clip(s[:, at[1]] / (np.sqrt((x * x).sum(1)) * self.longest), 0.0, 0.98)

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(tables, rows, directions) of rows scaled to length 1."""
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        scale = norm if query else np.full_like(norm, self.longest)
        rest = np.zeros_like(norm) if query else np.sqrt(np.maximum(0.0, 1 - np.square(norm / scale)))
        return np.einsum("rd,tmd->trm", np.hstack((x / scale, rest)), self.directions)

    def bins(self, u: np.ndarray, t: int) -> np.ndarray:
        return np.floor((u + self.offset[t]) / WIDTH).astype(np.int64)

    def probes(self, x: np.ndarray, cosines: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per table: (table, row numbers, bucket keys) in the order of estimated success,
        for neighbours of the queries' expected ``cosines``. A query whose first
        ``MAX_PROBES`` buckets hold less than ``SUCCESS`` in some table has no rows in any."""
        proj = self.project(x, True)
        s = np.full(len(x), self.cosine) if cosines is None else cosines
        sd = np.sqrt(np.maximum(1e-6, 1 - s * s))[:, None]
        reach = np.arange(-math.ceil(4 / WIDTH), math.ceil(4 / WIDTH) + 1)
        whole, out = np.ones(len(x), bool), []
        for t, u in enumerate(proj):
            keys = np.zeros((len(x), 1), np.int64)
            mass = np.ones((len(x), 1))
            for j in range(u.shape[1]):  # the best products of the first j bins hold the best of all
                bins = self.bins(s * u[:, j], np.s_[t, j])[:, None] + reach
                edge = (np.concatenate((bins, bins[:, -1:] + 1), 1) * WIDTH - self.offset[t, j] - (s * u[:, j])[:, None]) / sd
                part = np.diff(_erf(edge / math.sqrt(2)).astype(np.float64), axis=1) / 2
                mass = (mass[:, :, None] * part[:, None, :]).reshape(len(x), -1)
                keys = (_mix_key(keys)[:, :, None] + bins[:, None, :]).reshape(len(x), -1)
                best = np.argsort(-mass, axis=1, kind="stable")[:, :MAX_PROBES]
                mass, keys = np.take_along_axis(mass, best, 1), np.take_along_axis(keys, best, 1)
            total = np.cumsum(mass, axis=1)
            visit = (total - mass < SUCCESS) & (mass > 0)
            row, at = np.nonzero(visit)
            whole &= total[:, -1] >= SUCCESS
            out.append((row, keys[row, at]))
        for t, (row, key) in enumerate(out):
            yield t, row[whole[row]], key[whole[row]]

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(tables, rows) bucket keys of rows."""
        out = []
        for t, u in enumerate(self.project(x, False)):
            key = np.zeros(len(x), np.int64)
            for j in range(u.shape[1]):
                key = _mix_key(key) + self.bins(u[:, j], np.s_[t, j])
            out.append(key)
        return np.array(out)


def _mix_key(k: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)).astype(np.int64)


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id BIGINT, v array<double>) of the rows that take part.

    Left out: NULL ids; vectors that are NULL, all zero, or hold a NULL, NaN or
    infinite component; vectors whose length is not the most frequent one (ties:
    the longest). A repeated id counts once, with its smallest vector.
    """
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("v", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    dims = rows.groupBy(F.size("v").alias("_d")).count()  # one row per length
    dim = dims.orderBy(F.desc("count"), F.desc("_d")).limit(1)
    return rows.join(F.broadcast(dim.select("_d")), F.size("v") == F.col("_d"), "left_semi")


def sample_rank(k: int, share: float, missed: float = MISSED) -> int:
    """The least rank in a sample of that share whose score the k-th best of all rows
    reaches, but for ``missed`` of the samples (k where all rows are sampled)."""
    held = np.cumsum([math.comb(k - 1, i) * share ** i * (1 - share) ** (k - 1 - i) for i in range(k)])
    return 1 + min(int(np.searchsorted(held, 1 - missed)), k - 1)


def fit(rows: DataFrame, k: int = K, tables: int = TABLES, sample: int = SAMPLE, seed: int = 7) -> tuple[Index, int] | None:
    """The index and the number of rows; None for an empty table."""
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, longest, dim = rows.agg(F.count(F.lit(1)), F.sqrt(F.max(norm2)), F.max(F.size("v"))).first()
    if not n:
        return None
    picked = rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(sample).select("vec_id", "v").toArrow()
    ids, some = picked["vec_id"].to_numpy(), _vectors(picked["v"])
    m = int(np.clip(round(math.log(max(n / BUCKET_ROWS, 1.0)) / _BIN_NATS), 1, 24))
    rng = np.random.default_rng(seed)
    index = Index(rng.standard_normal((tables, m, dim + 1)), rng.uniform(0, WIDTH, (tables, m)), 0.0, float(longest),
                  ids, some, sample_rank(k, min(1.0, len(ids) / n)))
    return fewest_compared(index, k), n


def fewest_compared(index: Index, k: int) -> Index:
    """The index with as many of its directions as have the fewest rows compared for
    queries of the sample (all of them where every query keeps to ``MAX_PROBES``)."""
    x = index.sample[:PILOTS]
    cosines = index.expect(index.sample_ids[:PILOTS], x, k)[1]
    best, least = index, math.inf
    for m in range(index.offset.shape[1], 0, -1):
        one = replace(index, directions=index.directions[:, :m], offset=index.offset[:, :m])
        buckets = sum(np.bincount(row, minlength=len(x)) for _, row, _ in one.probes(x, cosines))
        # shares of all rows; a query without buckets meets every row
        compared = np.where(buckets > 0, buckets * math.exp(-_BIN_NATS * m), 1.0).mean()
        if compared < least:
            best, least = one, compared
        if buckets.all():
            break
    return best


def _best(query_ids, q, floors, row_ids, b, k: int):
    """The k best rows (by inner product, then smaller id) of each query among ``b``,
    without those below the query's floor.

    A matrix product finds all that can be among the k best, equal ones included;
    their scores are then summed in one fixed order, so equal vectors tie exactly.
    """
    order = np.argsort(row_ids, kind="stable")
    row_ids, b = row_ids[order], b[order]
    out = []
    step = max(1, (1 << 22) // max(1, len(row_ids)))
    for a in range(0, len(query_ids), step):
        qa, ids = q[a:a + step], query_ids[a:a + step]
        s = qa @ b.T
        s[ids[:, None] == row_ids[None, :]] = -np.inf
        if s.shape[1] > k:
            least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        else:
            least = np.full(len(ids), -np.inf)
        least = np.maximum(least, floors[a:a + step])
        slack = 1e-9 * (np.abs(least) + 1e-300)
        qi, bi = np.nonzero((s >= np.where(np.isfinite(least), least - slack, -np.inf)[:, None]) & (s > -np.inf))
        exact = np.concatenate([(qa[qi[i:i + 65536]] * b[bi[i:i + 65536]]).sum(1)
                                for i in range(0, max(1, len(qi)), 65536)])
        order = np.lexsort((bi, -exact, qi))
        qi, bi, exact = qi[order], bi[order], exact[order]
        first = np.searchsorted(qi, np.arange(len(ids)))
        ok = np.arange(len(qi)) - first[qi] < k
        out.append((ids[qi[ok]], row_ids[bi[ok]], exact[ok]))
    return [np.concatenate(x) for x in zip(*out)]


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


_FOUND = "query_id bigint, vec_id bigint, score double"


def _rank_blocks(rows: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Best k of each query in each block. ``rows`` and ``queries`` share ``keys``;
    a bucket is dealt into blocks of rows and of queries first."""
    many = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    blocks = many(rows, "rn").join(many(queries, "qn"), keys)  # buckets that have both
    deal = lambda df, own, other, own_n, other_n, *more: (
        df.join(blocks, keys).withColumn(own, F.pmod(F.xxhash64("vec_id", F.lit(own)), F.col(own_n)).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
        .select(*keys, "rb", "qb", F.col("vec_id").alias("vec_id"), F.col("v").alias("v"), *more))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        q, v, s = _best(right["vec_id"].to_numpy(), _vectors(right["v"]), right["floor"].to_numpy(),
                        left["vec_id"].to_numpy(), _vectors(left["v"]), k)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    by = [*keys, "rb", "qb"]
    return (deal(rows, "rb", "qb", "rn", "qn").groupBy(*by)
            .cogroup(deal(queries, "qb", "rb", "qn", "rn", "floor").groupBy(*by)).applyInArrow(rank, _FOUND))


def _top(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query, k: int = K, tables: int = TABLES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of every query.

    ``is_query`` is a condition on vec_id. Candidates are all rows that take part
    (see ``valid_vectors``) but the query's own. A query whose buckets held fewer
    than k rows, or that needs too many buckets (see ``Index.probes``), is compared
    with every row, in blocks, so it gets k (or all).
    """
    rows = materialize(valid_vectors(df), "vectors")
    fitted = fit(rows, k, tables)
    if fitted is None:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index, n = fitted
    schema = "t int, bucket bigint, vec_id bigint, v array<double>, floor double"

    def put(batches: Iterator[pa.RecordBatch], query: bool) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, 256 if query else 4096):
                b = big.slice(start, 256 if query else 4096)
                x = _vectors(b.column("v"))
                floor = np.zeros(len(x))
                if query:
                    floor, cosines = index.expect(b.column("vec_id").to_numpy(), x, k)
                    found = index.probes(x, cosines)
                else:
                    found = ((t, np.arange(len(x)), key) for t, key in enumerate(index.keys(x)))
                for t, row, key in found:
                    some = b.take(pa.array(row))
                    yield pa.record_batch([pa.array(np.full(len(row), t, np.int32)), pa.array(key),
                                           some.column("vec_id"), some.column("v"), pa.array(floor[row])],
                                          names=["t", "bucket", "vec_id", "v", "floor"])

    stored = rows.mapInArrow(lambda it: put(it, False), schema)
    asked = rows.where(is_query).mapInArrow(lambda it: put(it, True), schema)
    found = materialize(_top(_rank_blocks(stored, asked, ["t", "bucket"], k), k), "neighbours")
    want = min(k, n - 1)
    short = (rows.where(is_query).join(found.groupBy(F.col("query_id").alias("vec_id")).count(), "vec_id", "left")
             .where(F.coalesce("count", F.lit(0)) < want)
             .select("vec_id", "v", F.lit(float("-inf")).alias("floor")))
    if want > 0 and not short.isEmpty():
        groups = math.ceil(n / BLOCK)
        every = rows.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
        ask = short.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        rest = _top(_rank_blocks(every, ask, ["g"], k), k)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")
