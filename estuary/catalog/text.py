"""Registered queries of the conversation/instruction text group and oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from estuary.catalog import series as CS
from estuary.catalog.common import flat
from estuary.catalog.fixtures_sql import with_recipes
from estuary.operators import text as X
from estuary.operators import tokens as TK
from estuary.sources import tables as TB

SRC_ROLES = {"user": "human", "assistant": "gpt"}
V1 = X.template("vicuna_v1_1")
MPT = X.template("mpt_text")
SIMPLE = X.template("simple")


def _turns(spark, d):
    return TB.turns(spark, d)


def _sources(spark, d):
    """Conversation sources in the human/gpt vocabulary, leading non-human dropped."""
    m = X.messages_of(_turns(spark, d), roles=SRC_ROLES)
    trimmed, ok = X.map_roles(F.col("messages"))
    return m.select("conv_id", trimmed.alias("messages"), ok.alias("valid"))


def _positional(messages, tpl):
    return F.transform(messages, lambda m, i: F.struct(
        F.when(i % 2 == 0, F.lit(tpl["role0"])).otherwise(F.lit(tpl["role1"])).alias("role"), m["msg"].alias("msg")))


def q_expand_special_tokens(spark, d):
    r = CS._rendered(spark, d)
    return flat(r.select("id", X.expand_special_tokens(F.col("human"), 2).alias("human"),
                         X.expand_special_tokens(F.col("gpt"), 2).alias("gpt")))


def _render(spark, d, tpl, style):
    m = X.messages_of(_turns(spark, d), roles={"user": tpl["role0"], "assistant": tpl["role1"]})
    return flat(m.select("conv_id", X.render_prompt("messages", style, tpl["system"], tpl["sep"], tpl["sep2"]).alias("prompt")))


def q_render_prompt_single(spark, d):
    return _render(spark, d, SIMPLE, "SINGLE")


def q_render_prompt_two(spark, d):
    return _render(spark, d, V1, "TWO")


def q_render_prompt_mpt(spark, d):
    return _render(spark, d, MPT, "MPT")


def q_prompt_templates(spark, d):
    tpl = X.prompt_templates(spark)
    keys = [t[0] for t in X.TEMPLATES]
    m = X.messages_of(_turns(spark, d))
    pick = F.element_at(F.array(*[F.lit(k) for k in keys]), (F.col("conv_id") % len(keys)).cast("int") + 1)
    r = X.render_with_template(m.withColumn("template", pick), tpl)
    return flat(r.select("conv_id", "template", "prompt"))


def q_map_roles(spark, d):
    s = _sources(spark, d)
    return flat(s.select("conv_id", F.size("messages").alias("n_messages"), "valid",
                         F.element_at("messages", 1)["role"].alias("first_role")))


def q_add_speaker_signal(spark, d):
    m = X.messages_of(_turns(spark, d), roles=SRC_ROLES)
    return flat(m.select("conv_id", X.add_speaker_signal(SIMPLE["system"], F.col("messages")).alias("conversation")))


def _span_rows(df):
    e = df.select("conv_id", "r.total", "r.mismatch", F.posexplode("r.spans").alias("span_no", "sp"))
    return flat(e.select("conv_id", "span_no", F.col("sp.s").alias("span_start"), F.col("sp.e").alias("span_end"),
                         "total", "mismatch"))


def q_supervision_mask_v1(spark, d):
    s = _sources(spark, d)
    conv = X.render_prompt(_positional(F.col("messages"), V1), "TWO", V1["system"], V1["sep"], V1["sep2"])
    return _span_rows(s.select("conv_id", X.supervision_mask_v1(conv, V1["sep"], V1["sep2"], V1["role1"]).alias("r")))


def _pieces():
    """The public sentencepiece model; ``</s>`` is one token."""
    import public_tokenizers

    return TK.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def q_supervision_mask_v1_pieces(spark, d):
    s = _sources(spark, d)
    conv = X.render_prompt(_positional(F.col("messages"), V1), "TWO", V1["system"], V1["sep"], V1["sep2"])
    mask = X.supervision_mask_v1(conv, V1["sep"], V1["sep2"], V1["role1"], measure=TK.lengths(_pieces()))
    return _span_rows(s.select("conv_id", mask.alias("r")))


def q_token_lengths_pieces(spark, d):
    t = _turns(spark, d)
    n = F.element_at(TK.lengths(_pieces())(F.array("text")), 1)
    return flat(t.select("conv_id", "turn", F.least(n, F.lit(2048)).alias("ids_len")))


def q_supervision_mask_mpt(spark, d):
    s = _sources(spark, d)
    conv = X.render_prompt(_positional(F.col("messages"), MPT), "MPT", MPT["system"], MPT["sep"])
    return _span_rows(s.select("conv_id", X.supervision_mask_mpt(conv, MPT["sep"], MPT["role1"]).alias("r")))


def q_supervision_mask_turns(spark, d):
    m = X.messages_of(_turns(spark, d), roles=SRC_ROLES)
    return _span_rows(m.select("conv_id", X.supervision_mask_turns(SIMPLE["system"], F.col("messages")).alias("r")))


def q_token_lengths(spark, d):
    t = _turns(spark, d)
    return flat(t.select("conv_id", "turn", F.least(X.tok_len(F.col("text")), F.lit(2048)).alias("ids_len")))


def q_pad_and_mask_batch(spark, d):
    m = X.messages_of(_turns(spark, d), roles=SRC_ROLES)
    ids = X.token_ids(X.add_speaker_signal(SIMPLE["system"], F.col("messages")))
    b = m.select("conv_id", F.floor(F.col("conv_id") / 4).alias("batch"), ids.alias("ids"))
    b = b.withColumn("batch_max", F.max(F.size("ids")).over(Window.partitionBy("batch")))
    p = b.select("conv_id", "batch", X.pad_and_mask(F.col("ids"), F.col("ids"), F.col("batch_max")).alias("p"))
    return flat(p.select("conv_id", "batch", F.size("p.input_ids").alias("padded_len"),
                         F.size(F.filter("p.attention_mask", lambda x: x)).alias("attended"),
                         F.size(F.filter("p.labels", lambda x: x == X.IGNORE_INDEX)).alias("ignored"),
                         F.aggregate("p.input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum")))


def q_chat_to_prompt(spark, d):
    return flat(X.chat_to_prompt(_turns(spark, d), V1))


def q_round_count(spark, d):
    t = _turns(spark, d)
    return flat(t.groupBy("conv_id").agg(X.round_count(F.count(F.lit(1)), 0).alias("rounds")))


def q_conversation_limits(spark, d):
    t = _turns(spark, d).where(F.col("role") == "user")
    status, cut = X.conversation_limit_status(F.col("text"), X.round_count(F.col("i"), 0), 50, 2560)
    return flat(t.select("conv_id", "turn", status.alias("status"), cut.alias("text")))


def q_pair_turns(spark, d):
    return flat(X.pair_turns(_turns(spark, d), offset=0))


def q_fix_code_blocks(spark, d):
    """Every third turn gets a closed code block, every third an open one."""
    t = _turns(spark, d)
    block = F.when(F.col("turn") % 3 == 1, F.lit("\n```a\\_b\n```c\\_d")).when(F.col("turn") % 3 == 2, F.lit("\n```a\\_b"))
    text = F.concat("text", F.coalesce(block, F.lit("")))
    return flat(t.select("conv_id", "turn", X.fix_code_blocks(text).alias("text")))


def q_marker_balance(spark, d):
    r = CS._rendered(spark, d)
    return flat(r.select("id", X.marker_balance(X.expand_special_tokens(F.col("human"), 2), 2).alias("balanced")))


def q_strip_marker(spark, d):
    docs = TB.table(spark, d, "documents").select("doc_id", "text")
    s = X.strip_marker(F.concat("text", F.when(F.col("doc_id") % 2 == 0, F.lit(" <graph> end<graph>")).otherwise(F.lit(""))))
    return flat(docs.select("doc_id", F.length(s).alias("n_chars"), F.md5(s).alias("md5")))


STOPS = ["</s>", ". "]


def q_truncate_at_stop(spark, d):
    t = _turns(spark, d).where(F.col("role") == "assistant")
    r = X.truncate_at_stop(F.col("text"), F.array(*[F.lit(s) for s in STOPS]), 0)
    return flat(t.select("conv_id", "turn", r["text"].alias("text"), r["stopped"].alias("stopped"), r["partial"].alias("partial")))


def q_partial_stop_flag(spark, d):
    t = _turns(spark, d)
    return flat(t.select("conv_id", "turn", X.partial_stop(F.col("text"), F.lit("</s>")).alias("partial"),
                         X.partial_stop(F.col("text"), F.lit(".\n")).alias("partial_nl")))


KEYWORDS = ["the ", "und ", "###"]


def q_stop_keyword_hit(spark, d):
    t = _turns(spark, d)
    return flat(t.select("conv_id", "turn", X.stop_keyword_hit(F.col("text"), KEYWORDS).alias("hit")))


def q_finish_reason(spark, d):
    r = TB.requests(spark, d)
    return flat(r.select("request_id", X.finish_reason(F.col("token_num") % 50, F.col("max_tokens"),
                                                       F.col("n") % 2 == 0).alias("finish_reason")))


def q_keep_last_context(spark, d):
    r = TB.requests(spark, d)
    ids = F.sequence(F.lit(1), F.greatest(F.col("token_num"), F.lit(1)))
    kept = X.keep_last_context(ids, 2048, F.col("max_tokens"))
    return flat(r.select("request_id", F.size(kept).alias("kept_len"), F.element_at(kept, 1).alias("first_id")))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

# ------------------------------------------------------------------ oracles


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _e(s: str) -> str:
    """SQL literal with explicit newlines."""
    return "(" + " || chr(10) || ".join(_q(p) for p in s.split("\n")) + ")"


NS = """ns as (select conv_id, turn, case role when 'user' then 'human' when 'assistant' then 'gpt' end src, text,
              row_number() over (partition by conv_id order by turn) - 1 j
        from turns where role <> 'system'),
fst as (select conv_id, max(src) filter (where j = 0) first_src from ns group by conv_id),
src as (select ns.conv_id, ns.turn, ns.src, ns.text,
               ns.j - case when f.first_src = 'human' then 0 else 1 end k
        from ns join fst f using (conv_id) where f.first_src = 'human' or ns.j > 0)"""


def _two_render(tpl: dict, role_expr: str, idx: str, from_: str) -> str:
    return (f"{_e(tpl['system'])} || {_q(tpl['sep'])} || coalesce(string_agg(case when text <> '' then {role_expr} || ': ' || text || "
            f"case when {idx} % 2 = 0 then {_q(tpl['sep'])} else {_q(tpl['sep2'])} end else {role_expr} || ':' end, '' order by turn), '')")


def _render_sql(tpl, style):
    role = f"case role when 'user' then {_e(tpl['role0'])} else {_e(tpl['role1'])} end"
    base = "select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 j from turns where role <> 'system'"
    if style == "SINGLE":
        agg = (f"{_e(tpl['system'])} || {_q(tpl['sep'])} || string_agg(case when text <> '' then {role} || ': ' || text || {_q(tpl['sep'])} "
               f"else {role} || ':' end, '' order by turn)")
    elif style == "TWO":
        agg = _two_render(tpl, role, "j", "m")
    else:
        agg = (f"{_e(tpl['system'])} || {_q(tpl['sep'])} || string_agg(case when text <> '' then {role} || text || {_q(tpl['sep'])} "
               f"else {role} end, '' order by turn)")
    return with_recipes("turns", f"select conv_id, {agg} prompt from ({base}) m group by conv_id")


def _tpl_sql():
    rows = []
    for i, t in enumerate(X.TEMPLATES):
        key, system, r0, r1, style, sep, sep2, off = t
        rows.append(f"({i}, {_q(key)}, {_e(system)}, {_e(r0)}, {_e(r1)}, {_q(style)}, {_q(sep)}, {_q(sep2) if sep2 else 'NULL'})")
    return "tpl(idx, template, system, role0, role1, style, sep, sep2) as (values " + ", ".join(rows) + ")"


TOKLEN = "(len(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')) + 1)"


def toklen(x: str) -> str:
    return TOKLEN.format(x=x)


SPEAKER = ("{sys} || coalesce(string_agg('### ' || case src when 'human' then 'Human' when 'gpt' then 'Assistant' else 'unknown' end"
           " || ': ' || text || chr(10), '' order by turn), '') || '### '")

ORACLE = {
    "expand_special_tokens": CS._with_more("dummy as (select 1)", """
select id, replace(replace(human, '<ST_HIS>', '<ST_start><ST_patch><ST_patch><ST_end>'), '<ST_PRE>', '<ST_start><ST_patch><ST_patch><ST_end>') human,
       replace(replace(gpt, '<ST_HIS>', '<ST_start><ST_patch><ST_patch><ST_end>'), '<ST_PRE>', '<ST_start><ST_patch><ST_patch><ST_end>') gpt
from rendered"""),
    "render_prompt_single": _render_sql(SIMPLE, "SINGLE"),
    "render_prompt_two": _render_sql(V1, "TWO"),
    "render_prompt_mpt": _render_sql(MPT, "MPT"),
    "prompt_templates": with_recipes("turns", "with " + _tpl_sql() + f""",
m as (select conv_id, turn, text, row_number() over (partition by conv_id order by turn) - 1 j from turns where role <> 'system'),
c as (select m.*, t.* from m join tpl t on t.idx = m.conv_id % {len(X.TEMPLATES)})
select conv_id, any_value(template) template,
  any_value(system) || any_value(sep) || string_agg(
    case when style = 'SINGLE' then (case when text <> '' then (case when j % 2 = 0 then role0 else role1 end) || ': ' || text || sep
                                          else (case when j % 2 = 0 then role0 else role1 end) || ':' end)
         when style = 'TWO' then (case when text <> '' then (case when j % 2 = 0 then role0 else role1 end) || ': ' || text ||
                                          case when j % 2 = 0 then sep else sep2 end
                                       else (case when j % 2 = 0 then role0 else role1 end) || ':' end)
         else (case when text <> '' then (case when j % 2 = 0 then role0 else role1 end) || text || sep
                    else (case when j % 2 = 0 then role0 else role1 end) end) end, '' order by turn) prompt
from c group by conv_id"""),
    "map_roles": with_recipes("turns", "with " + NS + """,
agg as (select conv_id, count(*) n_messages, bool_and(src = case when k % 2 = 0 then 'human' else 'gpt' end) valid,
               max(src) filter (where k = 0) first_role from src group by conv_id)
select f.conv_id, coalesce(a.n_messages, 0) n_messages, coalesce(a.valid, true) valid, a.first_role
from fst f left join agg a using (conv_id)"""),
    "add_speaker_signal": with_recipes("turns", """
with ns as (select conv_id, turn, case role when 'user' then 'human' when 'assistant' then 'gpt' end src, text from turns where role <> 'system')
select conv_id, """ + SPEAKER.format(sys=_q(SIMPLE["system"] + "\n\n").replace("\n", "' || chr(10) || '")) + """ conversation from ns group by conv_id"""),
    "token_lengths": with_recipes("turns", f"select conv_id, turn, least({toklen('text')}, 2048) ids_len from turns"),
    "chat_to_prompt": with_recipes("turns", """
with sysm as (select conv_id, arg_max(text, turn) sys from turns where role = 'system' group by conv_id),
bad as (select conv_id, count(*) filter (where role not in ('system', 'user', 'assistant')) > 0 invalid_role from turns group by conv_id),
m as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 j from turns where role <> 'system'),
r as (select conv_id, count(*) n, string_agg(case when text <> '' then (case role when 'user' then 'USER' else 'ASSISTANT' end) || ': ' || text ||
                   case when j % 2 = 0 then ' ' else '</s>' end
                 else (case role when 'user' then 'USER' else 'ASSISTANT' end) || ':' end, '' order by turn) body from m group by conv_id)
select r.conv_id, coalesce(s.sys, """ + _q(V1["system"]) + """) || ' ' || r.body || 'ASSISTANT:' prompt, b.invalid_role
from r left join sysm s using (conv_id) join bad b using (conv_id)"""),
    "round_count": with_recipes("turns", "select conv_id, cast(count(*) // 2 as bigint) rounds from turns group by conv_id"),
    "conversation_limits": with_recipes("turns", """
select conv_id, turn, case when length(text) <= 0 then 'empty' when i // 2 >= 50 then 'limit' else 'ok' end status,
       case when length(text) > 0 and i // 2 < 50 then substr(text, 1, 2560) end text
from turns where role = 'user'"""),
    "pair_turns": with_recipes("turns", """
select conv_id, cast(i // 2 as bigint) pair, max(text) filter (where i % 2 = 0) "user", max(text) filter (where i % 2 = 1) assistant
from turns group by conv_id, i // 2"""),
    "fix_code_blocks": with_recipes("turns", """
with f as (select conv_id, turn, text || case turn % 3 when 1 then chr(10) || '```a\\_b' || chr(10) || '```c\\_d'
                                          when 2 then chr(10) || '```a\\_b' else '' end as text from turns)
select conv_id, turn, case when contains(text, chr(10) || '```') and len(string_split(text, chr(10) || '```')) % 2 = 1
  then array_to_string(list_transform(string_split(text, chr(10) || '```'), lambda b, i: case when i % 2 = 0 then replace(b, '\\_', '_') else b end), chr(10) || '```')
  else text end text from f"""),
    "marker_balance": CS._with_more("dummy as (select 1)", "select id, true balanced from rendered"),
    "strip_marker": """
with d as (select doc_id, text || case when doc_id % 2 = 0 then ' <graph> end<graph>' else '' end text from documents)
select doc_id, length(replace(text, '<graph>', '')) n_chars, md5(replace(text, '<graph>', '')) md5 from d""",
    "stop_keyword_hit": with_recipes("turns", "select conv_id, turn, " + " or ".join(f"contains(text, {_q(k)})" for k in KEYWORDS) + " hit from turns"),
    "finish_reason": with_recipes("requests", """
select request_id, case when token_num % 50 = max_tokens - 1 then 'length' when n % 2 = 0 then 'stop' end finish_reason from requests"""),
    "keep_last_context": with_recipes("requests", """
with r as (select request_id, greatest(token_num, 1) n, 2048 - max_tokens - 8 src from requests),
s as (select request_id, n, case when src > 0 then greatest(n - src, 0) when src = 0 then 0 else least(-src, n) end start0 from r)
select request_id, cast(n - start0 as bigint) kept_len, cast(case when n - start0 > 0 then start0 + 1 end as bigint) first_id from s"""),
}

RFIND = "(case when strpos(reverse({o}), reverse({s})) > 0 then length({o}) - strpos(reverse({o}), reverse({s})) + 1 - length({s}) else -1 end)"
PARTIAL = ("coalesce(case when least(length({o}), length({s})) > 0 then list_bool_or(list_transform(range(0, least(length({o}), length({s}))), "
           "lambda i: starts_with({s}, case when i = 0 then {o} else right({o}, cast(i as int)) end))) end, false)")


def _trunc_sql():
    o, s1, s2 = "text", _q(STOPS[0]), _q(STOPS[1])
    p1 = RFIND.format(o=o, s=s1)
    return with_recipes("turns", f"""
with a as (select conv_id, turn, text, {p1} p1, {PARTIAL.format(o=o, s=s1)} part1 from turns where role = 'assistant'),
b as (select *, {RFIND.format(o=o, s=s2)} p2, {PARTIAL.format(o=o, s=s2)} part2 from a)
select conv_id, turn,
  case when p1 >= 0 then substr(text, 1, p1) when part1 then text when p2 >= 0 then substr(text, 1, p2) else text end text,
  p1 >= 0 or (not part1 and p2 >= 0) stopped,
  case when p1 >= 0 then false when part1 then true when p2 >= 0 then false else part2 end "partial"
from b""")


ORACLE["truncate_at_stop"] = _trunc_sql()
ORACLE["partial_stop_flag"] = with_recipes("turns", f"""
select conv_id, turn, {PARTIAL.format(o='text', s=_q('</s>'))} "partial", {PARTIAL.format(o='text', s="'.' || chr(10)")} partial_nl from turns""")


# ------------------------------------------------------------------ span and batch oracles

_TC = "(len(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')) + 1)"


def _tc(x: str) -> str:
    return _TC.format(x=x)


def _two_conv_sql(tpl: dict) -> str:
    """Conversation text of the trimmed sources in the TWO style (positional roles)."""
    role = f"(case when k % 2 = 0 then {_q(tpl['role0'])} else {_q(tpl['role1'])} end)"
    body = (f"string_agg(case when text <> '' then {role} || ': ' || text || case when k % 2 = 0 then {_q(tpl['sep'])} "
            f"else {_q(tpl['sep2'])} end else {role} || ':' end, '' order by turn)")
    return (NS + f""",
agg as (select conv_id, {body} body from src group by conv_id),
convs as (select f.conv_id, {_e(tpl['system'])} || {_q(tpl['sep'])} || coalesce(a.body, '') c from fst f left join agg a using (conv_id))""")


def _mpt_conv_sql(tpl: dict) -> str:
    role = f"(case when k % 2 = 0 then {_e(tpl['role0'])} else {_e(tpl['role1'])} end)"
    body = f"string_agg(case when text <> '' then {role} || text || {_q(tpl['sep'])} else {role} end, '' order by turn)"
    return (NS + f""",
agg as (select conv_id, {body} body from src group by conv_id),
convs as (select f.conv_id, {_e(tpl['system'])} || {_q(tpl['sep'])} || coalesce(a.body, '') c from fst f left join agg a using (conv_id))""")


def _spans_tail(spans: str, cur_end: str) -> str:
    return f"""fin as (select conv_id, total, ({cur_end}) < 2048 and ({cur_end}) <> total mismatch,
    case when ({cur_end}) < 2048 and ({cur_end}) <> total then [{{'s': 0, 'e': total}}]
         else list_filter(list_transform({spans}, lambda p: {{'s': least(p.s, total), 'e': least(p.e, total)}}), lambda p: p.e > p.s) end sp
  from k)
select conv_id, cast(unnest(range(0, len(sp))) as bigint) span_no, cast(unnest(sp).s as bigint) span_start, cast(unnest(sp).e as bigint) span_end,
       total, mismatch from fin"""


def _v1_sql() -> str:
    t = V1
    rsep = t["sep"] + t["role1"] + ": "
    return with_recipes("turns", "with " + _two_conv_sql(t) + f""",
r as (select conv_id, least({_tc('replace(c, ' + _q(t['sep2']) + ', ' + _q(' ' + t['sep2'] + ' ') + ')')}, 2048) total, string_split(c, {_q(t['sep2'])}) rounds from convs),
v as (select *, list_position(list_transform(rounds, lambda x: x <> '' and len(string_split(x, {_q(rsep)})) = 2), false) p from r),
k0 as (select conv_id, total, rounds[1:(case when p is null or p = 0 then len(rounds) else p - 1 end)] kept from v),
k as (select conv_id, total, kept, list_transform(kept, lambda x: {_tc('x')}) rlen,
             list_transform(kept, lambda x: {_tc("string_split(x, " + _q(rsep) + ")[1] || " + _q(rsep))} - 2) ilen from k0),
""" + _spans_tail(
        "[{'s': 0, 'e': 1}] || list_transform(range(1, len(kept) + 1), lambda j: {'s': 1 + coalesce(list_sum(rlen[1:j - 1]), 0), "
        "'e': 1 + coalesce(list_sum(rlen[1:j - 1]), 0) + ilen[j]}) || [{'s': 1 + coalesce(list_sum(rlen), 0), 'e': total}]",
        "1 + coalesce(list_sum(rlen), 0)"))


def _mpt_sql() -> str:
    t = MPT
    sep, bsep = t["sep"], t["sep"] + t["role1"]
    return with_recipes("turns", "with " + _mpt_conv_sql(t) + f""",
r as (select conv_id, least({_tc('c')}, 2048) total, string_split(c, {_q(sep)}) parts from convs),
rr as (select conv_id, total, [array_to_string(parts[1:3], {_q(sep)})] ||
          list_transform(list_filter(range(4, len(parts) + 1, 2), lambda i: i <= len(parts)),
                         lambda i: array_to_string(parts[i:i + 1], {_q(sep)})) rounds from r),
v as (select *, list_position(list_transform(rounds, lambda x: x <> '' and len(string_split(x, {_e(bsep)})) = 2), false) p from rr),
k0 as (select conv_id, total, rounds[1:(case when p is null or p = 0 then len(rounds) else p - 1 end)] kept from v),
k as (select conv_id, total, kept, list_transform(kept, lambda x: {_tc('x')} + {_tc(_q(sep))}) rlen,
             list_transform(kept, lambda x: {_tc("string_split(x, " + _e(bsep) + ")[1] || " + _e(bsep))}) ilen from k0),
""" + _spans_tail(
        "list_transform(range(1, len(kept) + 1), lambda j: {'s': coalesce(list_sum(rlen[1:j - 1]), 0), "
        "'e': coalesce(list_sum(rlen[1:j - 1]), 0) + ilen[j]}) || [{'s': coalesce(list_sum(rlen), 0), 'e': total}]",
        "coalesce(list_sum(rlen), 0)"))


def _turns_sql() -> str:
    header = SIMPLE["system"] + "\n\n"
    hsql = _q(header).replace("\n", "' || chr(10) || '")
    return with_recipes("turns", f"""
with ns as (select conv_id, turn, case role when 'user' then 'human' when 'assistant' then 'gpt' end src, text,
                   row_number() over (partition by conv_id order by turn) j from turns where role <> 'system'),
pc as (select conv_id, turn, j, src, '### ' || case src when 'human' then 'Human' when 'gpt' then 'Assistant' else 'unknown' end
              || ': ' || text || chr(10) piece from ns),
pl as (select *, {_tc('piece')} ln from pc),
st as (select *, {_tc(hsql)} + coalesce(sum(ln) over (partition by conv_id order by j rows between unbounded preceding and 1 preceding), 0) s0 from pl),
k as (select conv_id, {_tc(hsql + " || string_agg(piece, '' order by j) || '### '")} total,
             list(struct_pack(s := s0 + 2, e := s0 + ln) order by j) filter (where src = 'human') hs from st group by conv_id),
fin as (select conv_id, total, false mismatch,
    list_filter(list_transform([{{'s': {_tc(hsql)}::bigint * 0, 'e': {_tc(hsql)}::bigint}}] || coalesce(hs, []),
                               lambda p: {{'s': least(p.s, total), 'e': least(p.e, total)}}), lambda p: p.e > p.s) sp from k)
select conv_id, cast(unnest(range(0, len(sp))) as bigint) span_no, cast(unnest(sp).s as bigint) span_start, cast(unnest(sp).e as bigint) span_end,
       total, mismatch from fin""")


def _pad_sql() -> str:
    from estuary.catalog.evaluate import TOKIDS

    return with_recipes("turns", """
with ns as (select conv_id, turn, case role when 'user' then 'human' when 'assistant' then 'gpt' end src, text from turns where role <> 'system'),
conv as (select conv_id, """ + SPEAKER.format(sys=_q(SIMPLE["system"] + "\n\n").replace("\n", "' || chr(10) || '")) + f""" conversation
         from ns group by conv_id),
ids as (select conv_id, conv_id // 4 batch, {TOKIDS.format(x='conversation')} ids from conv),
b as (select *, max(len(ids)) over (partition by batch) bm from ids)
select conv_id, batch, cast(bm as bigint) padded_len, cast(len(ids) as bigint) attended, cast(bm - len(ids) as bigint) ignored,
       cast(list_sum(ids) as bigint) id_sum from b""")


def _markdown_sql() -> str:
    from estuary.catalog.activity import HORIZON

    return with_recipes("conv_log", "with " + HORIZON + """,
m as (select model, count(*) a, count(*) filter (where in_day) d, count(*) filter (where in_hour) hr from h where "type" = 'chat'
      group by model having count(*) filter (where in_day) > 0 and count(*) filter (where in_hour) > 0),
w as (select cast(greatest(max(length(model)), 5) as int) w0, cast(greatest(max(length(cast(a as varchar))), 3) as int) w1,
             cast(greatest(max(length(cast(d as varchar))), 8) as int) w2, cast(greatest(max(length(cast(hr as varchar))), 9) as int) w3 from m),
body as (select row_number() over (order by a desc, model) + 2 line_no,
                '| ' || rpad(model, w0, ' ') || ' | ' || lpad(cast(a as varchar), w1, ' ') || ' | ' || lpad(cast(d as varchar), w2, ' ')
                || ' | ' || lpad(cast(hr as varchar), w3, ' ') || ' |' line from m, w)
select 1 line_no, '| ' || rpad('model'::varchar, w0, ' ') || ' | ' || lpad('All'::varchar, w1, ' ') || ' | ' || lpad('Last Day'::varchar, w2, ' ') || ' | '
       || lpad('Last Hour'::varchar, w3, ' ') || ' |' line from w where exists (select 1 from m)
union all select 2, '|' || repeat('-', w0 + 2) || '|' || repeat('-', w1 + 2) || '|' || repeat('-', w2 + 2) || '|' || repeat('-', w3 + 2) || '|'
from w where exists (select 1 from m)
union all select line_no, line from body""".replace("select 1 line_no", "select cast(1 as bigint) line_no"))


ORACLE["supervision_mask_v1"] = _v1_sql()
ORACLE["supervision_mask_mpt"] = _mpt_sql()
ORACLE["supervision_mask_turns"] = _turns_sql()
ORACLE["pad_and_mask_batch"] = _pad_sql()
ORACLE["markdown_table"] = _markdown_sql()
