"""Conversation and instruction text: prompt rendering by template, role
mapping, supervision spans, token lengths, limits, stop handling.

Per-conversation work uses array higher-order functions on one row (a
conversation's turns are collected per conversation – bounded by its length);
no operator collects across conversations.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.functions.exprs import let
from estuary.operators.series import ST_END, ST_HIS, ST_PATCH, ST_PRE, ST_START

IGNORE_INDEX = -100

# Conversation templates (key, system, role0, role1, style, sep, sep2, offset).
_SYS_HUMAN = ("A chat between a curious human and an artificial intelligence assistant. "
              "The assistant gives helpful, detailed, and polite answers to the human's questions.")
_SYS_USER = ("A chat between a curious user and an artificial intelligence assistant. "
             "The assistant gives helpful, detailed, and polite answers to the user's questions.")
_SYS_LLAVA = ("You are LLaVA, a large language and vision assistant trained by UW Madison WAIV Lab."
              "You are able to understand the visual content that the user provides, and assist the user with a variety of tasks using natural language."
              "Follow the instructions carefully and explain your answers in detail.")
_SYS_LEGACY = ("You are LLaVA, a large language model trained by UW Madison WAIV Lab."
               "You are designed to assist human with a variety of tasks using natural language."
               "Follow the instructions carefully.")
_SYS_MPT_MM = """<|im_start|>system
- You are LLaVA, a large language and vision assistant trained by UW Madison WAIV Lab.
- You are able to understand the visual content that the user provides, and assist the user with a variety of tasks using natural language.
- You should follow the instructions carefully and explain your answers in detail."""
_SYS_MPT = """<|im_start|>system
- You are a helpful language and vision assistant.
- You are able to understand the visual content that the user provides, and assist the user with a variety of tasks using natural language.
- You should follow the instructions carefully and explain your answers in detail."""
_SYS_MPT_TEXT = """<|im_start|>system
- You are a helpful assistant chatbot trained by MosaicML.
- You answer questions.
- You are excited to be able to help the user, but will refuse to do anything that could be considered harmful to the user.
- You are more than just an information source, you are also able to write poetry, short stories, and make jokes."""
_MPT_ROLES = ("<|im_start|>user\n", "<|im_start|>assistant\n")

TEMPLATES = [
    ("default", _SYS_HUMAN, "Human", "Assistant", "SINGLE", "###", None, 2),
    ("v1", _SYS_HUMAN, "Human", "Assistant", "SINGLE", "###", None, 2),
    ("simple", _SYS_HUMAN, "Human", "Assistant", "SINGLE", "###", None, 2),
    ("simple_legacy", _SYS_LEGACY, "Human", "Assistant", "SINGLE", "###", None, 2),
    ("multimodal", _SYS_LLAVA, "Human", "Assistant", "SINGLE", "###", None, 2),
    ("mpt_multimodal", _SYS_MPT_MM, _MPT_ROLES[0], _MPT_ROLES[1], "MPT", "<|im_end|>", None, 0),
    ("llava_v1", _SYS_LLAVA, "USER", "ASSISTANT", "TWO", " ", "</s>", 0),
    ("bair_v1", "BEGINNING OF CONVERSATION:", "USER", "GPT", "TWO", " ", "</s>", 0),
    ("vicuna_v1_1", _SYS_USER, "USER", "ASSISTANT", "TWO", " ", "</s>", 0),
    ("mpt", _SYS_MPT, _MPT_ROLES[0], _MPT_ROLES[1], "MPT", "<|im_end|>", None, 0),
    ("mpt_text", _SYS_MPT_TEXT, _MPT_ROLES[0], _MPT_ROLES[1], "MPT", "<|im_end|>", None, 0),
]
TEMPLATE_SCHEMA = "template string, system string, role0 string, role1 string, style string, sep string, sep2 string, offset int"


def prompt_templates(spark: SparkSession, extra: list[tuple] | None = None) -> DataFrame:
    """Template dimension (about a dozen rows; broadcast by construction)."""
    return spark.createDataFrame(TEMPLATES + (extra or []), TEMPLATE_SCHEMA)


def template(key: str) -> dict:
    row = next(t for t in TEMPLATES if t[0] == key)
    return dict(zip(["template", "system", "role0", "role1", "style", "sep", "sep2", "offset"], row))


# ---------------------------------------------------------------- helpers


def messages_of(turns: DataFrame, key: str = "conv_id", order: str = "turn", roles: dict | None = None,
                skip_system: bool = True) -> DataFrame:
    """Turns → one row per conversation with ``messages ARRAY<STRUCT<role, msg>>``
    in turn order; roles are renamed through ``roles``."""
    t = turns.where(F.col("role") != "system") if skip_system else turns
    role = F.col("role")
    if roles:
        m = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv])
        role = F.coalesce(F.element_at(m, F.col("role")), F.col("role"))
    g = t.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), role.alias("role"),
                                                                 F.col("text").alias("msg")))).alias("_m"))
    return g.select(key, F.transform("_m", lambda s: F.struct(s["role"].alias("role"), s["msg"].alias("msg"))).alias("messages"))


def _has(msg: Column) -> Column:
    return msg.isNotNull() & (msg != "")


def render_prompt(messages: str | Column, style: str, system: str | Column, sep: str | Column,
                  sep2: str | Column | None = None) -> Column:
    """``Conversation.get_prompt`` for SINGLE, TWO and MPT styles; a NULL or empty
    message renders the short form (``role:`` or ``role``)."""
    msgs = F.col(messages) if isinstance(messages, str) else messages
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    sep, sep2, system = lit(sep), lit(sep2), lit(system)
    if style == "SINGLE":
        parts = F.transform(msgs, lambda m: F.when(_has(m["msg"]), F.concat(m["role"], F.lit(": "), m["msg"], sep))
                            .otherwise(F.concat(m["role"], F.lit(":"))))
    elif style == "TWO":
        parts = F.transform(msgs, lambda m, i: F.when(_has(m["msg"]), F.concat(
            m["role"], F.lit(": "), m["msg"], F.when(i % 2 == 0, sep).otherwise(sep2))).otherwise(F.concat(m["role"], F.lit(":"))))
    elif style == "MPT":
        parts = F.transform(msgs, lambda m: F.when(_has(m["msg"]), F.concat(m["role"], m["msg"], sep)).otherwise(m["role"]))
    else:
        raise ValueError(style)
    return F.concat(system, sep, F.array_join(parts, ""))


def render_with_template(conv: DataFrame, tpl: DataFrame, messages: str = "messages") -> DataFrame:
    """Render each conversation with the template named in its ``template``
    column (broadcast equi-join on the template key; style chosen per row)."""
    j = conv.join(F.broadcast(tpl), "template")
    roles = lambda: F.transform(messages, lambda m, i: F.struct(
        F.when(i % 2 == 0, F.col("role0")).otherwise(F.col("role1")).alias("role"), m["msg"].alias("msg")))
    single = render_prompt(roles(), "SINGLE", F.col("system"), F.col("sep"))
    two = render_prompt(roles(), "TWO", F.col("system"), F.col("sep"), F.col("sep2"))
    mpt = render_prompt(roles(), "MPT", F.col("system"), F.col("sep"))
    prompt = F.when(F.col("style") == "SINGLE", single).when(F.col("style") == "TWO", two).otherwise(mpt)
    return j.withColumn("prompt", prompt)


def expand_special_tokens(text: Column, k: int, use_start_end: bool = True) -> Column:
    """``<ST_HIS>``/``<ST_PRE>`` → ``<ST_start>`` + k × ``<ST_patch>`` + ``<ST_end>``."""
    rep = ST_PATCH * k
    if use_start_end:
        rep = ST_START + rep + ST_END
    return F.replace(F.replace(text, F.lit(ST_HIS), F.lit(rep)), F.lit(ST_PRE), F.lit(rep))


def map_roles(messages: Column) -> tuple[Column, Column]:
    """human/gpt sources → (messages without a leading non-human turn,
    alternation-ok flag). The reference asserts; here a flag column."""
    first_human = F.element_at(messages, 1)["role"] == "human"
    trimmed = F.when(first_human | (F.size(messages) == 0), messages).otherwise(F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0))))
    ok = F.forall(F.transform(trimmed, lambda m, i: (m["role"] == F.when(i % 2 == 0, F.lit("human")).otherwise(F.lit("gpt")))),
                  lambda b: b)
    return trimmed, ok


def add_speaker_signal(system: str, messages: Column, roles=("Human", "Assistant")) -> Column:
    """``header + Σ("### " + Role + ": " + value + "\\n") + "### "`` with header
    = system + blank line; unknown speakers become ``unknown``."""
    role = lambda m: (F.when(F.lower(m["role"]) == "human", F.lit(roles[0]))
                      .when(F.lower(m["role"]) == "gpt", F.lit(roles[1])).otherwise(F.lit("unknown")))
    body = F.array_join(F.transform(messages, lambda m: F.concat(F.lit("### "), role(m), F.lit(": "), m["msg"], F.lit("\n"))), "")
    return F.concat(F.lit(system + "\n\n"), body, F.lit("### "))


# ---------------------------------------------------------------- tokens and spans


def ws_tokens(text: Column) -> Column:
    """Default tokenizer: whitespace words (``str.split()``)."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def tok_len(text: Column) -> Column:
    """Token count with a leading BOS token, like a sentencepiece ``input_ids``."""
    return F.size(ws_tokens(text)) + 1


def token_ids(text: Column, vocab: int = 32000) -> Column:
    """Portable word ids in [3, vocab): first 8 hex digits of md5 mod (vocab-3) + 3."""
    return F.transform(ws_tokens(text), lambda w: (F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"),
                                                           F.lit(vocab - 3)) + 3).cast("int"))


def _spans(parts: list[Column]) -> Column:
    return F.concat(*parts)


def _clip_spans(spans: Column, total: Column) -> Column:
    clipped = F.transform(spans, lambda s: F.struct(F.least(s["s"], total).alias("s"), F.least(s["e"], total).alias("e")))
    return F.filter(clipped, lambda s: s["e"] > s["s"])


def _span(s: Column, e: Column) -> Column:
    return F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"))


Measure = Callable[[Column], Column]


def word_lengths(apart: str | None = None) -> Measure:
    """Lengths of the texts of an array by the whitespace tokenizer; ``apart`` is a string that is a
    token of its own wherever it stands. ``estuary.operators.tokens.lengths`` measures with a model."""
    cut = (lambda t: F.replace(t, F.lit(apart), F.lit(f" {apart} "))) if apart else (lambda t: t)
    return lambda texts: F.transform(texts, lambda t: tok_len(cut(t)))


def _valid_rounds(rounds: Column, sep: str) -> Column:
    """Rounds before the first one that is empty or has not exactly one ``sep``."""
    valid = F.transform(rounds, lambda r: (r != "") & (F.size(F.split(r, re.escape(sep), -1)) == 2))
    pos = F.array_position(valid, False)
    return F.slice(rounds, 1, F.when(pos == 0, F.size(rounds)).otherwise(pos - 1).cast("int"))


def _instructions(rounds: Column, sep: str) -> Column:
    return F.transform(rounds, lambda r: F.concat(F.element_at(F.split(r, re.escape(sep), -1), 1), F.lit(sep)))


def _round_mask(measured: Column, begin: int, before: int, max_len: int, lead: list[Column], sep_len: bool = False) -> Column:
    """Spans from one array of lengths: the whole text, then (the separator, if ``sep_len``) then the rounds, then
    the instruction part of each round. Counting starts at ``begin``; ``before`` tokens of an
    instruction part are not masked. A counted length that differs from the total masks everything."""
    skip = 2 if sep_len else 1

    def of(m: Column) -> Column:
        total = F.least(F.element_at(m, 1), F.lit(max_len))
        n = ((F.size(m) - skip) / 2).cast("int")
        each = F.element_at(m, 2) if sep_len else F.lit(0)
        rlen = F.transform(F.slice(m, F.lit(skip + 1), n), lambda x: x + each)
        ilen = F.transform(F.slice(m, n + skip + 1, n), lambda x: x - before)
        starts = F.transform(rlen, lambda _, k: F.aggregate(F.slice(rlen, F.lit(1), k), F.lit(begin), lambda a, x: a + x))
        cur_end = F.aggregate(rlen, F.lit(begin), lambda a, x: a + x)
        spans = F.concat(*([F.array(*lead)] if lead else []),
                         F.zip_with(starts, ilen, lambda s, i: _span(s, s + i)), F.array(_span(cur_end, total)))
        mismatch = (cur_end < max_len) & (cur_end != total)
        return F.struct(total.alias("total"), mismatch.alias("mismatch"),
                        F.when(mismatch, F.array(_span(F.lit(0), total))).otherwise(_clip_spans(spans, total)).alias("spans"))

    return let(measured, of)


def supervision_mask_v1(conversation: Column, sep: str, sep2: str, role1: str, max_len: int = 2048,
                        measure: Measure | None = None) -> Column:
    """Masked token spans of ``preprocess_v1`` (TWO style): the first token, each
    round's instruction part (length − 2), everything after the last round;
    everything when the counted length disagrees with the total. ``sep2`` is a
    token of its own, as the first token that each round's count includes. ``measure`` gives the
    tokens of each text of an array (whitespace words by default)."""
    measure = measure or word_lengths(sep2)
    rsep = sep + role1 + ": "
    kept = _valid_rounds(F.split(conversation, re.escape(sep2), -1), rsep)
    measured = measure(F.concat(F.array(conversation), kept, _instructions(kept, rsep)))
    return _round_mask(measured, 1, 2, max_len, [_span(F.lit(0), F.lit(1))])


def supervision_mask_mpt(conversation: Column, sep: str, role1: str, max_len: int = 2048,
                         measure: Measure | None = None) -> Column:
    """``preprocess_mpt``: first round = system + user + gpt parts, later rounds =
    pairs; a round's length adds the separator's length; counting starts at 0."""
    measure = measure or word_lengths()
    bsep = sep + role1
    parts = F.split(conversation, re.escape(sep), -1)
    n_parts = F.size(parts)
    first = F.array_join(F.slice(parts, 1, 3), sep)
    later = F.transform(F.filter(F.sequence(F.lit(4), F.greatest(n_parts, F.lit(4)), F.lit(2)), lambda i: i <= n_parts),
                        lambda i: F.array_join(F.slice(parts, i, 2), sep))
    kept = _valid_rounds(F.concat(F.array(first), later), bsep)
    measured = measure(F.concat(F.array(conversation, F.lit(sep)), kept, _instructions(kept, bsep)))
    return _round_mask(measured, 0, 0, max_len, [], sep_len=True)


def supervision_mask_turns(system: str, messages: Column, roles=("Human", "Assistant"), measure: Measure | None = None) -> Column:
    """``_mask_targets``: the header is masked; a human turn is masked from
    ``cur + 2`` to its end; lengths are per-piece token counts."""
    measure = measure or word_lengths()
    header = system + "\n\n"
    role = lambda m: (F.when(F.lower(m["role"]) == "human", F.lit(roles[0]))
                      .when(F.lower(m["role"]) == "gpt", F.lit(roles[1])).otherwise(F.lit("unknown")))
    pieces = F.transform(messages, lambda m: F.concat(F.lit("### "), role(m), F.lit(": "), m["msg"], F.lit("\n")))
    human = F.transform(messages, lambda m: m["role"] == "human")
    measured = measure(F.concat(F.array(add_speaker_signal(system, messages, roles), F.lit(header)), pieces))

    def of(m: Column) -> Column:
        total, h = F.element_at(m["m"], 1), F.element_at(m["m"], 2)
        lens = F.slice(m["m"], F.lit(3), F.greatest(F.size(m["m"]) - 2, F.lit(0)))
        starts = F.transform(lens, lambda _, k: F.aggregate(F.slice(lens, F.lit(1), k), h, lambda a, x: a + x))
        spans = F.concat(F.array(_span(F.lit(0), h)), F.transform(
            F.filter(F.arrays_zip(starts.alias("st"), lens.alias("ln"), m["hu"].alias("hu")), lambda z: z["hu"]),
            lambda z: _span(z["st"] + 2, z["st"] + z["ln"])))
        return F.struct(total.alias("total"), F.lit(False).alias("mismatch"), _clip_spans(spans, total).alias("spans"))

    return let(F.struct(measured.alias("m"), human.alias("hu")), of)


def pad_and_mask(ids: Column, labels: Column, batch_max: Column, pad_id: int = 0) -> Column:
    """Right-pad ids with ``pad_id`` and labels with −100 to the batch max; the
    attention mask is ``id != pad`` (an id equal to pad is masked too)."""
    pad_n = batch_max - F.size(ids)
    pids = F.concat(ids, F.array_repeat(F.lit(pad_id), pad_n))
    plab = F.concat(labels, F.array_repeat(F.lit(IGNORE_INDEX), pad_n))
    return F.struct(pids.alias("input_ids"), plab.alias("labels"),
                    F.transform(pids, lambda x: x != pad_id).alias("attention_mask"))


# ---------------------------------------------------------------- serving text rules


def round_count(n_messages: Column, offset: Column | int) -> Column:
    return F.floor((n_messages - offset) / 2).cast("int")


def conversation_limit_status(text: Column, rounds: Column, limit_rounds: int = 50, char_limit: int = 2560) -> tuple[Column, Column]:
    """Ordered rules: empty text → ``skip``; ≥ limit rounds → ``limit``; else
    ``ok`` with the text cut to ``char_limit`` characters (the cut is last)."""
    status = F.when(F.length(text) <= 0, F.lit("empty")).when(rounds >= limit_rounds, F.lit("limit")).otherwise(F.lit("ok"))
    return status, F.when(status == "ok", F.substring(text, 1, char_limit))


def fix_code_blocks(text: Column) -> Column:
    """Split on "\\n```"; only when the block count is odd, replace ``\\_`` by
    ``_`` in the odd blocks."""
    sep = "\n```"
    blocks = F.split(text, re.escape(sep), -1)
    fixed = F.transform(blocks, lambda b, i: F.when(i % 2 == 1, F.replace(b, F.lit("\\_"), F.lit("_"))).otherwise(b))
    return F.when(F.contains(text, F.lit(sep)) & (F.size(blocks) % 2 == 1), F.array_join(fixed, sep)).otherwise(text)


def marker_balance(text: Column, k: int, start: str = ST_START, patch: str = ST_PATCH, end: str = ST_END) -> Column:
    """Start markers = end markers and every start is followed by exactly k
    patches and an end."""
    n_start = F.size(F.split(text, re.escape(start), -1)) - 1
    n_end = F.size(F.split(text, re.escape(end), -1)) - 1
    n_full = F.size(F.split(text, re.escape(start + patch * k + end), -1)) - 1
    return (n_start == n_end) & (n_full == n_start)


def strip_marker(text: Column, marker: str = "<graph>") -> Column:
    return F.regexp_replace(text, re.escape(marker), "")


def rfind(out: Column, stop: Column, start: Column | int = 0) -> Column:
    """Python ``out.rfind(stop, start)`` (0-based, −1 when absent)."""
    start = start if isinstance(start, Column) else F.lit(start)
    loc = F.call_function("locate", F.reverse(stop), F.reverse(out))  # 1-based in reversed text, 0 = absent
    last = F.length(out) - (loc - 1) - F.length(stop)
    return F.when((loc > 0) & (last >= start), last).otherwise(F.lit(-1))


def partial_stop(out: Column, stop: Column) -> Column:
    """Does the output's tail start the stop string; i = 0 tests the whole output."""
    m = F.least(F.length(out), F.length(stop))
    tails = F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0)))
    test = F.exists(tails, lambda i: F.startswith(stop, F.when(i == 0, out).otherwise(F.right(out, i))))
    return F.when(m > 0, test).otherwise(F.lit(False))


def truncate_at_stop(out: Column, stops: Column, start: Column | int = 0) -> Column:
    """List form: the first stop string found (last occurrence at or after
    ``start``) cuts the output; otherwise a partial match of a stop ends the
    scan. Returns struct(text, stopped, partial)."""
    init = F.struct(out.alias("text"), F.lit(False).alias("stopped"), F.lit(False).alias("partial"))

    def step(acc, s):
        done = acc["stopped"] | acc["partial"]
        pos = rfind(acc["text"], s, start)
        return F.when(done, acc).when(pos >= 0, F.struct(acc["text"].substr(F.lit(1), pos).alias("text"),
                                                         F.lit(True).alias("stopped"), F.lit(False).alias("partial"))
                                      ).otherwise(F.struct(acc["text"].alias("text"), F.lit(False).alias("stopped"),
                                                           partial_stop(acc["text"], s).alias("partial")))

    return F.aggregate(stops, init, step)


def stop_keyword_hit(out: Column, keywords: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(out, k))


def finish_reason(step: Column, max_new_tokens: Column | int, stopped: Column) -> Column:
    """``length`` when the last step was used (wins over stop), else ``stop``."""
    mx = max_new_tokens if isinstance(max_new_tokens, Column) else F.lit(max_new_tokens)
    return F.when(step == mx - 1, F.lit("length")).when(stopped, F.lit("stop"))


def keep_last_context(ids: Column, context_len: Column | int, max_new_tokens: Column | int,
                      encoder_decoder: bool = False) -> Column:
    """``ids[-max_src_len:]`` with python slice rules (0 keeps all, a negative
    bound drops from the front)."""
    c = context_len if isinstance(context_len, Column) else F.lit(context_len)
    m = max_new_tokens if isinstance(max_new_tokens, Column) else F.lit(max_new_tokens)
    src = c if encoder_decoder else c - m - 8
    n = F.size(ids)
    start0 = F.when(src > 0, F.greatest(n - src, F.lit(0))).when(src == 0, F.lit(0)).otherwise(F.least(-src, n))
    return F.slice(ids, start0 + 1, n - start0)


DEFAULT_MAX_TOKENS = 512


def chat_gen_params(requests: DataFrame, model: str = "model", messages: str = "messages", prompt: str = "prompt",
                    max_tokens: str = "max_tokens") -> DataFrame:
    """Generation parameters of a chat request: ``max_tokens`` defaults to 512;
    chatglm models receive the raw message list instead of a rendered prompt."""
    glm = F.contains(F.lower(F.col(model)), F.lit("chatglm"))
    return requests.withColumn("gen_max_tokens", F.coalesce(F.col(max_tokens), F.lit(DEFAULT_MAX_TOKENS))).withColumn(
        "gen_prompt", F.when(glm, F.to_json(F.col(messages))).otherwise(F.col(prompt)))


def chat_to_prompt(turns: DataFrame, tpl: dict, key: str = "conv_id") -> DataFrame:
    """OpenAI-style messages → template prompt: the **last** system message
    overrides the template system; user/assistant map to the two roles; an
    empty assistant turn is appended; other roles are flagged."""
    sys_msg = turns.where(F.col("role") == "system").groupBy(key).agg(F.max_by("text", "turn").alias("sys"))
    m = messages_of(turns, key, roles={"user": tpl["role0"], "assistant": tpl["role1"]})
    bad = turns.groupBy(key).agg(F.count_if(~F.col("role").isin("system", "user", "assistant")).alias("_bad"))
    j = m.join(sys_msg, key, "left").join(bad, key)
    msgs = F.concat("messages", F.array(F.struct(F.lit(tpl["role1"]).alias("role"), F.lit(None).cast("string").alias("msg"))))
    system = F.coalesce(F.col("sys"), F.lit(tpl["system"]))
    return j.select(key, render_prompt(msgs, tpl["style"], system, tpl["sep"], tpl["sep2"]).alias("prompt"),
                    (F.col("_bad") > 0).alias("invalid_role"))


def pair_turns(turns: DataFrame, offset: int = 0, key: str = "conv_id", pos: str = "i") -> DataFrame:
    """Messages after ``offset`` as [user, assistant] pairs; an open last pair
    has a NULL assistant."""
    t = turns.where(F.col(pos) >= offset).withColumn("_k", F.col(pos) - offset)
    return t.groupBy(key, F.floor(F.col("_k") / 2).alias("pair")).agg(
        F.max_by(F.when(F.col("_k") % 2 == 0, F.col("text")), F.when(F.col("_k") % 2 == 0, F.col("_k"))).alias("user"),
        F.max_by(F.when(F.col("_k") % 2 == 1, F.col("text")), F.when(F.col("_k") % 2 == 1, F.col("_k"))).alias("assistant"))
