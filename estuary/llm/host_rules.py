"""Host-level quality rules.

Each document gets rule counts and a base verdict. Failures are aggregated by
host, failure rates are shrunk towards the corpus rate with a beta prior whose
parameters are estimated from the hosts themselves (method of moments), and a
host whose shrunk rate is above a limit loses its documents.

All expressions are built-in; long texts are handled by array functions on the
row, nothing is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions.exprs import let
from estuary.llm.common import SPACE_CHARS, materialize, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
HOST_LIMIT = 0.5  # shrunk failure rate above which a host is rejected
MAX_STRENGTH = 1e6  # prior strength when the hosts show no more spread than chance


def repeated_window_words(hashes: Column, width: int = WINDOW) -> Column:
    """Number of positions lying in a ``width``-window that occurs twice or more.

    ``hashes`` is the array of 64-bit word hashes. Windows are compared by a
    64-bit hash of their word hashes. Texts without a repeated window (the usual
    case) stop after a distinct count.
    """
    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (width - 1), F.lit(0)))
    grams = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, width)]))

    def covered(g):
        ranked = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def in_pairs(s):
            same = lambda k: F.coalesce(F.get(s, k)["x"], F.lit(None).cast("bigint"))
            hits = F.filter(s, lambda e, k: (e["x"].eqNullSafe(same(k - 1)) & (k > 0)) | e["x"].eqNullSafe(same(k + 1)))
            at = F.sort_array(F.transform(hits, lambda e: e["i"]))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda v, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - v, F.lit(width)))),
                F.lit(0), lambda a, v: a + v))

        return let(ranked, in_pairs)

    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, source and the rule counts of each document (BIGINT), base_failed.

    NULL and empty texts have no words, so they fail. n_dup_lines counts lines
    with a word that equal an earlier line.
    """
    w = docs.select("doc_id", "source", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    w = w.withColumn("w", words("text"))
    lines = F.filter(F.split("text", "\n"), lambda s: F.btrim(s, F.lit(SPACE_CHARS)) != "")
    w = w.select(
        "doc_id", "source", F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("bigint").alias("n_dup_lines"),
        let(F.transform("w", lambda x: F.xxhash64(x)), lambda h: repeated_window_words(h)).cast("bigint").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return w.withColumn("base_failed", failed)


def host_verdicts(rows: DataFrame, host: str = "source", failed: str = "base_failed",
                  limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host (NULL is a host of its own): n, fails, shrunk_rate, host_kept.

    The beta prior has the corpus rate m as mean. Its strength follows from the
    spread of host rates beyond binomial noise; with no such spread it is
    MAX_STRENGTH and every host gets nearly the corpus rate.
    """
    per = rows.groupBy(host).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(failed).cast("bigint")).alias("fails"))
    rate = F.col("fails") / F.col("n")
    moments = per.agg(F.sum("n").alias("_n"), F.sum("fails").alias("_f"), F.count(F.lit(1)).alias("_k"),
                      F.sum(F.col("n") * rate * rate).alias("_q"))
    m = F.col("_f") / F.col("_n")
    noise = m * (1 - m)
    spread = F.col("_q") / F.col("_n") - m * m - noise * F.col("_k") / F.col("_n")
    strength = F.when(spread * F.lit(MAX_STRENGTH) <= noise, F.lit(MAX_STRENGTH)).otherwise(
        F.greatest(noise / spread - 1, F.lit(1.0)))
    prior = moments.select(m.alias("_m"), strength.alias("_s"))
    shrunk = (F.col("fails") + F.col("_m") * F.col("_s")) / (F.col("n") + F.col("_s"))
    return (per.crossJoin(F.broadcast(prior))  # one row
            .withColumn("shrunk_rate", shrunk).withColumn("host_kept", F.col("shrunk_rate") <= limit)
            .drop("_m", "_s"))


def judge_documents(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The rule counts, base_failed, host_kept and kept of every document.

    A document is kept if it passes the base rules and its host is kept; a host whose
    rate equals the limit is kept. NULL and repeated doc_ids and repeated rows give one
    row each and count as often. Only doc_id, source and text are read, so other columns
    may have any name. An empty table gives no rows. The texts are read once: the counts are written as a
    narrow table, which the host aggregation and the join back read.
    """
    rows = materialize(base_rules(docs), "rules")
    hosts = host_verdicts(rows, limit=limit).select(F.col("source").alias("_host"), "shrunk_rate", "host_kept")
    return (rows.join(hosts, rows["source"].eqNullSafe(hosts["_host"])).drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept")))
