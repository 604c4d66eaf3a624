"""Corpus pipeline: quality, toxicity, near-duplicates, mixing, piece encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns the DataFrame that the next stage works on. All but the last keep the
columns of ``documents``. ``run`` applies them to the whole table and writes each
result once to the shared folder, so a lost executor never costs more than the
stage at hand.

Rows without a text count as the empty text in every stage. NULL doc_ids and
repeated rows are handled as each operator states; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm import mixing, pieces, quality, simhash, toxicity
from estuary.llm.common import materialize, table
from estuary.session import configure


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant accepts (score 0.3 or more)."""
    configure(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the logistic regression scores below 0.7."""
    configure(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each component of fingerprints of
    3-word shingles linked at 3 bits or fewer."""
    configure(spark)
    return simhash.drop_near_duplicates(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    configure(spark)
    return mixing.apply_mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces and ids (the sampled pieces) of every document of the mix."""
    configure(spark)
    return pieces.encode(docs, keep=["doc_id", "source"]).select(
        "doc_id", "source", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources to target weights", mix_to_weights),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: The classifiers and the lattice draw have no SQL form; tests/llm compares the
#: stages with plain-Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k + 1}")
    return docs


QUERIES = {"pipeline": run}
