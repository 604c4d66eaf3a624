"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source the rows are ordered by that
key and a distributed prefix sum of their sizes decides, for each row, how much
of it lies below the source's budget: whole epochs first, then the part of one
more epoch that fits, cut exactly at the budget.

The prefix sum has two levels. The first hex digits of the key are the row's
range (4096 ranges per source), range totals get a running sum per source, and
rows are summed inside their range only. A source with a third of all rows is
spread over all its ranges, and the range is a function of the key, so a task
that is run again after a lost executor gives the same sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estuary.llm.common import SPACE, SPACE_CHARS, id_text, materialize, word_count

RANGE_DIGITS = 3  # hex digits of the key that name a range: 4096 ranges per source
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # all targets together, as a share of all sizes
MAX_EPOCHS = 2


def hash_key(doc_id: Column | str, seed: str = "mix") -> Column:
    """Hash-random key: 32 hex digits, ordered like a 128-bit number."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_text(doc_id)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    Sources in code-point order (NULL last) take ``weights`` in turn. The total
    ``share`` x all sizes is split by weight; a source stops at ``max_epochs``
    times its size and the excess is shared again among the others by weight.
    The fixed point has a closed form: sorted by cap/weight, a source is capped
    iff its cap is below its part of what the sources before it left over.
    Sources of size 0 get target 0. The windows run over the source table.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    fill = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    t = (per.withColumn("weight", turn).withColumn("_cap", cap)
         .withColumn("_left", F.least(F.sum("source_size").over(whole) * F.lit(float(share)), F.sum("_cap").over(whole))
                     - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
         .withColumn("_wleft", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("_open", F.col("_cap") * F.col("_wleft") >= F.col("weight") * F.col("_left")))
    # the first source in fill order that is not capped fixes the level for all after it
    first_open = F.min(F.when(F.col("_open"), F.struct("_rank", "_left", "_wleft"))).over(whole)
    t = t.withColumn("_rank", F.row_number().over(fill)).withColumn("_f", first_open)
    level = F.col("weight") * F.col("_f._left") / F.col("_f._wleft")
    return t.select("source", "source_size", "weight",
                    F.when(F.col("_f").isNull() | (F.col("_rank") < F.col("_f._rank")), F.col("_cap"))
                    .otherwise(level).alias("target"))


def mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        seed: str = "mix") -> DataFrame:
    """How much of each row the mix takes.

    ``rows`` has columns doc_id, source, size (BIGINT, not NULL), optionally
    ``tie`` (any orderable value), and any others. Returns them plus key,
    source_size, target, epochs (whole repeats) and taken (epochs x size plus
    the part of the last epoch below the budget ``round(target)``), so the taken
    sizes of a source sum to its rounded target and no row exceeds
    max_epochs x size.

    Ties: rows are ordered by key, doc_id, size, ``tie``; rows equal in all of
    them are interchangeable. NULL doc_ids share one key and follow size and
    tie. A NULL source is a source of its own. An empty table gives no rows.
    """
    ties = ["doc_id", "size"] + (["tie"] if "tie" in rows.columns else [])
    keyed = rows.withColumn("key", hash_key("doc_id", seed)).withColumn("_range", F.substring("key", 1, RANGE_DIGITS))
    totals = keyed.groupBy("source", "_range").agg(F.sum("size").alias("size"))
    t = source_targets(totals, weights, share, max_epochs)
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    t = t.select(F.col("source").alias("_s"), "source_size", "target", epochs.alias("epochs"),
                 (budget - epochs * F.col("source_size")).alias("_rest"))
    # per range: what is left of its source's last epoch when the range begins
    below = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.select("source", F.col("_range").alias("_r"),
                           F.coalesce(F.sum("size").over(below), F.lit(0)).alias("_off"))
    ranges = (ranges.join(t, ranges["source"].eqNullSafe(t["_s"])).drop("source")
              .withColumn("_room", F.col("_rest") - F.col("_off")).drop("_rest", "_off"))
    inside = (Window.partitionBy("source", "_range").orderBy("key", *ties)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    prior = F.sum("size").over(inside) - F.col("size")
    return (keyed.join(ranges, keyed["source"].eqNullSafe(ranges["_s"]) & (keyed["_range"] == ranges["_r"]))
            .withColumn("_fits", F.least(F.col("size"), F.greatest(F.col("_room") - prior, F.lit(0))))
            .withColumn("taken", F.col("epochs") * F.col("size") + F.col("_fits"))
            .drop("_s", "_r", "_range", "_room", "_fits"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and word count of each document (NULL text: 0), written once
    as a narrow table so that the texts are not scanned again."""
    return materialize(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word (n >= 1)."""
    leading = F.when(F.ltrim(text, F.lit(SPACE_CHARS)) == text, 1).otherwise(2)
    rest = F.element_at(F.split(text, SPACE, (n + leading).cast("int")), -1)
    cut = F.left(text, F.length(text) - F.length(rest))
    return F.when(n >= word_count(text), text).otherwise(F.rtrim(cut, F.lit(SPACE_CHARS)))


def apply_mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with the
    columns of ``docs`` (doc_id, text, source and any others).

    The one copy per source that the budget cuts keeps its first words only
    (``n_chars``, where present, is set to the cut length). A document that is
    not taken is absent; one without words takes no budget and stays once.
    """
    packed = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("tie"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    m = mix(packed, **kw)
    part = F.col("taken") - F.col("epochs") * F.col("size")
    copies = F.when(F.col("size") == 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.concat(
        F.array_repeat(F.col("size"), F.col("epochs").cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))))
    m = m.select("_doc", "size", F.explode(copies).alias("_n"))
    is_cut = F.col("_n") < F.col("size")
    text = F.when(is_cut, first_words(F.col("_doc.text"), F.col("_n"))).otherwise(F.col("_doc.text"))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(text.alias("text"))
        elif c == "n_chars":
            out.append(F.when(is_cut, F.length(text)).otherwise(F.col("_doc.n_chars")).cast(docs.schema[c].dataType)
                       .alias(c))
        else:
            out.append(F.col("_doc").getField(c).alias(c))
    return m.select(*out)
