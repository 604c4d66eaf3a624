"""Battle cleaning: one projection computes an ordered ``reason`` per vote, so
kept battles and every counter come from the same scan. Conversations are indexed once,
by the place a vote may start from; a vote only looks its place up."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estuary.functions.exprs import let
from estuary.operators.activity import VOTES

# Identity words that disqualify a battle, as listed by the
# reference (its mixed-case entries can never match lower-cased text; kept).
IDENTITY_WORDS = [
    "vicuna",
    "lmsys",
    "koala",
    "uc berkeley",
    "open assistant",
    "laion",
    "chatglm",
    "chatgpt",
    "openai",
    "anthropic",
    "claude",
    "bard",
    "palm",
    "Lamda",
    "google",
    "**NETWORK ERROR DUE TO HIGH TRAFFIC. PLEASE REGENERATE OR REFRESH THIS PAGE.**",
]

# Vote action → battle outcome.
VOTE_TO_WIN = {"leftvote": "model_a", "rightvote": "model_b", "tievote": "tie", "bothbad_vote": "tie (bothbad)"}

def strip_h3(raw: Column) -> Column:
    """``remove_html``: when the name starts with ``<h3>``, keep
    ``raw[raw.find(": ") + 2 : -6]`` (python slice semantics: a missing ``": "``
    gives find = -1, i.e. start 1; the 6-character suffix is cut blindly)."""
    at = F.locate(": ", raw)
    start = F.when(at == 0, F.lit(1)).otherwise(at + 1)
    size = F.greatest(F.length(raw) - 6 - start, F.lit(0))
    return F.when(raw.startswith("<h3>"), F.substring(raw, start + 1, size)).otherwise(raw)


# ---- one row per place of a conversation ----------------------------------------------------------

# Texts are lower-cased before the search, so entries with capitals never match.
_LEAK_WORDS = [w for w in IDENTITY_WORDS if w == w.lower()]
_LEAK = "|".join(re.escape(w) for w in _LEAK_WORDS)
_EDGE = max(map(len, _LEAK_WORDS)) - 1  # characters that a word can reach into the next text


def conversation_index(turns: DataFrame, language: Callable[[Column], Column] | None = None) -> DataFrame:
    """What a vote needs to know of the messages from place ``i`` on, one row per place:
    ``n_msgs`` of the conversation, ``leak`` (an identity word begins there or later; words across
    the joins of messages count), ``head`` and ``tail`` (first and last characters of the joined
    lower-cased texts, as many as a word can reach over) and the ``language`` of message i.

    Messages meet their neighbours in narrow rows: only the edges of a text are
    sorted by conversation, and no row holds more than a few of them. NULL and empty
    messages have a place but no text."""
    text = F.lower(F.coalesce("text", F.lit("")))
    lang = language(F.col("text")) if language else F.lit("unknown")
    rows = turns.select("conv_id", "i", lang.alias("language"), F.nullif(F.left(text, F.lit(_EDGE)), F.lit("")).alias("_l"),
                        F.nullif(F.right(text, F.lit(_EDGE)), F.lit("")).alias("_r"), text.rlike(_LEAK).alias("_own"))
    conv = Window.partitionBy("conv_id")
    # numbers of the messages with text: _EDGE of them always hold _EDGE characters
    rows = rows.withColumn("_k", F.count("_l").over(conv.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)))
    after = conv.orderBy("_k").rangeBetween(1, _EDGE)
    own = F.when(F.col("_l").isNotNull(), F.col("_k"))
    rows = rows.select("*", F.array_join(F.collect_list("_l").over(after), "").alias("_next"),
                       F.array_join(F.collect_list("_r").over(after), "").alias("_ends"),
                       F.max("_k").over(conv).alias("_last"), F.count(F.lit(1)).over(conv).alias("n_msgs"))
    edge = lambda c, side: side(c, F.lit(_EDGE))
    text_l, text_r = F.coalesce("_l", F.lit("")), F.coalesce("_r", F.lit(""))
    rows = rows.select(
        "conv_id", "i", "n_msgs", "language", own.alias("_own_k"),
        (F.col("_own") | F.concat(text_r, edge(F.col("_next"), F.left)).rlike(_LEAK)).alias("_leak"),
        edge(F.concat(text_l, F.when(F.length(text_l) < _EDGE, F.col("_next")).otherwise("")), F.left).alias("head"),
        F.concat(text_r, "_ends").alias("_ends"), (F.col("_last") - F.col("_k")).alias("_left"))
    rest = conv.orderBy("i").rowsBetween(0, Window.unboundedFollowing)
    # the last characters of a long rest are those of the place _EDGE messages before the end
    far = F.max(F.when((F.col("_left") == _EDGE - 1) & F.col("_own_k").isNotNull(), edge(F.col("_ends"), F.right))).over(conv)
    return rows.select("conv_id", "i", "n_msgs", "language", F.max("_leak").over(rest).alias("leak"), "head",
                       F.when(F.col("_left") >= _EDGE, far).otherwise(edge(F.col("_ends"), F.right)).alias("tail"))


def indexed_votes(votes: DataFrame, index: DataFrame) -> DataFrame:
    """Votes (event_id, tstamp, type, models, hidden_a, hidden_b, offset, conv_id, leak) with the
    row of their conversation's index at the vote's offset, as :func:`battle_reasons` takes them.

    Both states share the conversation from the offset on; ``leak`` is a last message that
    only the second one has. A vote is a lookup of one narrow row: no message is copied."""
    at = index.select("conv_id", F.col("i").cast("int").alias("offset"), "n_msgs", "language",
                      F.struct("leak", "head", "tail").alias("_at"))
    v = votes.where(F.col("type").isin(VOTES)).join(at, ["conv_id", "offset"], "left")
    joined = F.concat(F.col("_at.tail"), F.col("_at.head"))
    last = F.concat(F.right(F.concat(F.col("_at.tail"), F.col("_at.tail")), F.lit(_EDGE)), F.lower(F.coalesce("leak", F.lit(""))))
    leaked = F.col("_at.leak") | joined.rlike(_LEAK) | last.rlike(_LEAK)
    return v.select("event_id", "tstamp", "type", "models", F.col("hidden_a").alias("_hid0"), F.col("hidden_b").alias("_hid1"),
                    "offset", "n_msgs", "language", F.coalesce(leaked, F.lit(False)).alias("_leaked"))


# ---- votes as they stand in the log ----------------------------------------------------------------

def _after_offset_text(state: Column) -> Column:
    """Lower-cased message texts after the state's offset, joined with no separator."""
    msgs = state["messages"]
    tail = F.slice(msgs, state["offset"] + 1, F.greatest(F.size(msgs) - state["offset"], F.lit(0)))
    kept = F.filter(tail, lambda m: m[1].isNotNull() & (m[1] != ""))
    return F.array_join(F.transform(kept, lambda m: F.lower(m[1])), "")


def logged_votes(votes: DataFrame, language: Callable[[Column], Column] | None = None) -> DataFrame:
    """Votes of the log, whose ``states[i] = {model_name, offset, messages[[role, text]]}`` carry
    their own messages, in the form that :func:`battle_reasons` takes."""
    v = votes.where(F.col("type").isin(VOTES))
    s0, s1 = F.element_at("states", 1), F.element_at("states", 2)
    first = F.try_element_at(F.try_element_at(s0["messages"], s0["offset"] + 1), F.lit(2))
    return v.select("event_id", "tstamp", "type", "models", s0["model_name"].alias("_hid0"), s1["model_name"].alias("_hid1"),
                    s0["offset"].alias("offset"), F.size(s0["messages"]).alias("n_msgs"),
                    (language(first) if language else F.lit("unknown")).alias("language"),
                    F.concat(_after_offset_text(s0), _after_offset_text(s1)).rlike(_LEAK).alias("_leaked"))


def battle_reasons(votes: DataFrame) -> DataFrame:
    """Ordered validity checks → ``reason`` (names → anony → mismatch → offset → leak) of
    :func:`indexed_votes` or :func:`logged_votes`."""
    # bound once: a filter on the reason would otherwise spell the names out many times
    names = let(F.struct(strip_h3(F.element_at("models", 1)).alias("a"), strip_h3(F.element_at("models", 2)).alias("b")),
                lambda p: F.struct(p["a"].alias("pub0"), p["b"].alias("pub1"),
                                   F.when(F.col("_hid0").isNotNull(), F.col("_hid0")).otherwise(p["a"]).alias("hid0"),
                                   F.when(F.col("_hid0").isNotNull(), F.col("_hid1")).otherwise(p["b"]).alias("hid1")))

    def judged(n: Column) -> Column:
        one_empty = (n["pub0"] == "") != (n["pub1"] == "")
        anony = (n["pub0"] == "") | (n["pub0"] == "Model A")
        mismatch = ~(n["pub0"].eqNullSafe(n["hid0"]) & n["pub1"].eqNullSafe(n["hid1"]))
        reason = (F.when(one_empty, "invalid_names")
                  .when(~anony & mismatch, "invalid_mismatch")
                  .when(F.col("n_msgs").isNull() | (F.col("offset") >= F.col("n_msgs")), "invalid_offset")
                  .when(F.col("_leaked"), "leaked_identity")
                  .otherwise("kept"))
        return F.struct(n["pub0"].alias("pub0"), n["pub1"].alias("pub1"), n["hid0"].alias("hid0"), n["hid1"].alias("hid1"),
                        anony.alias("anony"), reason.alias("reason"))

    return votes.select("event_id", "tstamp", "type", "offset", "n_msgs", "language",
                        let(names, judged).alias("_j")).select("event_id", "tstamp", "type", "offset", "n_msgs", "language",
                                                               "_j.*")


def rename_model(c: Column) -> Column:
    return F.replace(c, F.lit("bard"), F.lit("palm-2"))


def vote_to_win(c: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in VOTE_TO_WIN.items() for x in kv])
    return F.element_at(m, c)


def clean_battles(votes: DataFrame) -> DataFrame:
    """Kept battles: model_a, model_b, win, anony, rounds, language, tstamp
    (+ event_id, the tie-break of the time order)."""
    r = battle_reasons(votes).where(F.col("reason") == "kept")
    m0 = F.when(F.col("anony"), F.col("hid0")).otherwise(F.col("pub0"))
    m1 = F.when(F.col("anony"), F.col("hid1")).otherwise(F.col("pub1"))
    return r.select("event_id", rename_model(m0).alias("model_a"), rename_model(m1).alias("model_b"),
                    vote_to_win(F.col("type")).alias("win"), "anony",
                    F.floor((F.col("n_msgs") - F.col("offset")) / 2).cast("int").alias("rounds"), "language", "tstamp")


def cleaning_counters(votes: DataFrame) -> DataFrame:
    """#votes, #invalid, #leaked, #battles, #anony (anony counted before the
    offset and leak drops, as the reference does)."""
    r = battle_reasons(votes)
    invalid = F.col("reason").startswith("invalid")
    return r.agg(
        F.count(F.lit(1)).alias("votes"), F.count_if(invalid).alias("invalid"),
        F.count_if(F.col("reason") == "leaked_identity").alias("leaked_identity"),
        F.count_if(F.col("reason") == "kept").alias("battles"),
        F.count_if(F.col("anony") & (F.col("reason") != "invalid_names")).alias("anony"))


def model_catalog(votes: DataFrame) -> DataFrame:
    """Distinct hidden names over kept battles, before the rename."""
    r = battle_reasons(votes).where(F.col("reason") == "kept")
    return r.select(F.explode(F.array("hid0", "hid1")).alias("model")).distinct()


def won_conversations(votes: DataFrame, turns: DataFrame, loser: str, winner: str) -> DataFrame:
    """Winner/loser by vote (left/right only; the reference's bothbad branch
    reuses a stale winner and is excluded) for one (loser, winner) pair, with
    both conversations as rows (event_id, side, i, role, text). The second state's extra
    message ``leak`` comes last; it is an assistant's."""
    left = F.col("type") == "leftvote"
    v = votes.where(F.col("type").isin("leftvote", "rightvote")).select(
        "event_id", "conv_id", F.when(left, F.col("hidden_a")).otherwise(F.col("hidden_b")).alias("winner"),
        F.when(left, F.col("hidden_b")).otherwise(F.col("hidden_a")).alias("loser"),
        F.when(left, "loser").otherwise("winner").alias("second"), "leak")
    v = v.where((F.col("loser") == loser) & (F.col("winner") == winner))
    sides = v.select("*", F.explode(F.array(F.lit("winner"), F.lit("loser"))).alias("side"))
    own = sides.join(turns.select("conv_id", "i", "role", "text"), "conv_id").select(
        "event_id", "winner", "loser", "side", "i", "role", "text")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("i"))
    extra = v.where(F.col("leak") != "").join(sizes, "conv_id").select(
        "event_id", "winner", "loser", F.col("second").alias("side"), "i", F.lit("assistant").alias("role"),
        F.col("leak").alias("text"))
    return own.unionByName(extra)
