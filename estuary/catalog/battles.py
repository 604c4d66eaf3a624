"""Registered queries of the battle-cleaning group and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog.common import flat
from estuary.catalog.fixtures_sql import with_recipes
from estuary.operators import battles as B
from estuary.operators import language as L
from estuary.sources import tables as TB


def language_profiles(spark, d):
    """Profiles learnt from L.TRAIN_ROWS labelled documents outside the hold-out (doc_id divisible by 5)."""
    docs = TB.table(spark, d, "documents").where((F.col("doc_id") % 5 != 0) & F.col("lang").isNotNull())
    docs = L.training_rows(docs, "doc_id")
    names = F.create_map(*[F.lit(x) for kv in L.LANGUAGE_NAMES.items() for x in kv])
    return L.learn_profiles(docs.select(F.try_element_at(names, F.col("lang")).alias("language"), "text"), "language", "text")


def _votes(spark, d, detect=False):
    language = L.detector(L.collect_profiles(language_profiles(spark, d))) if detect else None
    return B.indexed_votes(TB.raw_votes(spark, d), B.conversation_index(TB.turns(spark, d), language))


def _reasons(spark, d):
    return B.battle_reasons(_votes(spark, d))


def q_vote_filter(spark, d):
    return flat(TB.raw_votes(spark, d).where(F.col("type").isin(B.VOTES)).select("event_id", "type"))


def q_strip_h3(spark, d):
    return flat(_reasons(spark, d).select("event_id", "pub0", "pub1"))


def q_resolve_models(spark, d):
    return flat(_reasons(spark, d).select("event_id", "hid0", "hid1"))


def q_battle_validity(spark, d):
    return flat(_reasons(spark, d).select("event_id", "reason"))


def q_classify_anony(spark, d):
    return flat(_reasons(spark, d).select("event_id", "anony"))


def q_detect_language(spark, d):
    docs = TB.table(spark, d, "documents")
    language = L.detector(L.collect_profiles(language_profiles(spark, d)))
    return flat(docs.select("doc_id", "lang", language(F.col("text")).alias("language"),
                            (F.col("doc_id") % 5 == 0).alias("held_out")))


def q_identity_leak(spark, d):
    r = _reasons(spark, d)
    return flat(r.select("event_id", (F.col("reason") == "leaked_identity").alias("leaked")))


def q_rename_model(spark, d):
    return flat(B.clean_battles(_votes(spark, d)).select("event_id", "model_a", "model_b"))


def q_vote_to_win(spark, d):
    v = TB.raw_votes(spark, d).where(F.col("type").isin(B.VOTES))
    return flat(v.select("event_id", B.vote_to_win(F.col("type")).alias("win")))


def q_clean_battles(spark, d):
    return flat(B.clean_battles(_votes(spark, d, detect=True)))


def q_cleaning_counters(spark, d):
    return flat(B.cleaning_counters(_votes(spark, d)))


def q_model_catalog(spark, d):
    return flat(B.model_catalog(_votes(spark, d)))


def q_won_conversations(spark, d):
    return flat(B.won_conversations(TB.raw_votes(spark, d), TB.turns(spark, d), loser="bard", winner="m1"))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

VOTES_SQL = "('tievote', 'leftvote', 'rightvote', 'bothbad_vote')"


def _strip(x: str) -> str:
    s0 = f"(case when strpos({x}, ': ') = 0 then 1 else strpos({x}, ': ') + 1 end)"
    e0 = f"greatest(length({x}) - 6, 0)"
    return (f"(case when starts_with({x}, '<h3>') then (case when {e0} > {s0} then substr({x}, {s0} + 1, {e0} - {s0}) else '' end)"
            f" else {x} end)")


_LEAK = " or ".join(f"contains(txt, '{w}')" for w in B.IDENTITY_WORDS)
_NAMES = " ".join(f"when '{code}' then '{name}'" for code, name in L.LANGUAGE_NAMES.items())

PIPE = f"""msgs as (select conv_id, count(*) n_msgs from turns group by conv_id),
v as (select r.*, m.n_msgs from raw_votes r join msgs m using (conv_id) where r."type" in {VOTES_SQL}),
p as (select v.*, {_strip('models[1]')} pub0, {_strip('models[2]')} pub1 from v),
h as (select p.*, case when hidden_a is not null then hidden_a else pub0 end hid0,
                  case when hidden_a is not null then hidden_b else pub1 end hid1,
             pub0 = '' or pub0 = 'Model A' anony from p),
tx as (select v.event_id,
              coalesce(string_agg(lower(t.text), '' order by t.i) filter (where t.i >= v."offset" and t.text <> ''), '') base_txt,
              max(t.text) filter (where t.i = v."offset") first_text
       from v join turns t on t.conv_id = v.conv_id group by v.event_id),
rs as (select h.*, tx.first_text, tx.base_txt || tx.base_txt || lower(h.leak) txt from h join tx using (event_id)),
rr as (select rs.*, case when (pub0 = '') <> (pub1 = '') then 'invalid_names'
                        when not anony and not (pub0 is not distinct from hid0 and pub1 is not distinct from hid1) then 'invalid_mismatch'
                        when "offset" >= n_msgs then 'invalid_offset'
                        when {_LEAK} then 'leaked_identity' else 'kept' end reason from rs)"""

def _grams(src: str) -> str:
    """Rows of ``src`` for each n-gram of their word, its ends marked."""
    return f"""select * from (select *, substr('_' || word || '_', i, n) gram
  from (select *, unnest(range(1, (length(word) + 4 - n)::bigint)) i from (select *, unnest([1, 2, 3]) n from {src}))) where gram <> '_'"""


def _lang(key: str, text: str, src: str) -> str:
    """Profiles by rank, scores of each distinct word, and the best language of each ``key`` of ``src``."""
    words = r"unnest(string_split_regex(lower({}), '[^\p{{L}}]+')) word".format
    return f"""tr as (select doc_id from documents where doc_id % 5 <> 0 and lang is not null group by 1
       order by md5(doc_id::varchar), doc_id limit {L.TRAIN_ROWS}),
lw as (select lang, word, count(*) c from (select lang, {words("text")} from documents join tr using (doc_id)
       where lang is not null) where word <> '' group by all),
lg as (select lang, gram, sum(c) c from ({_grams("lw")}) group by all),
prof as (select case lang {_NAMES} end language, gram, row_number() over (partition by lang order by c desc, gram) r
         from lg qualify r <= {L.TOP}),
tok as (select {key}, word, count(*) c from (select {key}, {words(text)} from {src}) where word <> '' group by all),
tg as (select word, gram from ({_grams("(select distinct word from tok)")})),
wn as (select word, count(*) n from tg group by 1),
ws as (select word, language, sum({L.TOP} + 1 - r) s, count(*) h from tg join prof using (gram) group by all),
dn as (select {key}, sum(c * n) n from tok join wn using (word) group by all),
ds as (select {key}, language, sum(c * s) s, sum(c * h) h from tok join ws using (word) group by all),
best as (select {key}, case when {L.MIN_SHARE} * h >= n then language else 'unknown' end language
         from ds join dn using ({key}) qualify row_number() over (partition by {key} order by s desc, language) = 1)"""


KEPT = """kept as (select event_id, replace(case when anony then hid0 else pub0 end, 'bard', 'palm-2') model_a,
                  replace(case when anony then hid1 else pub1 end, 'bard', 'palm-2') model_b,
                  case "type" when 'leftvote' then 'model_a' when 'rightvote' then 'model_b' when 'tievote' then 'tie'
                       else 'tie (bothbad)' end win, anony, cast((n_msgs - "offset") // 2 as bigint) rounds, tstamp, first_text
           from rr where reason = 'kept')"""


def _pipe(body: str, extra: str = "") -> str:
    return with_recipes(["raw_votes", "turns"], "with " + PIPE + ("," + extra if extra else "") + "\n" + body)


ORACLE = {
    "vote_filter": with_recipes("raw_votes", f"""select event_id, "type" from raw_votes where "type" in {VOTES_SQL}"""),
    "strip_h3": _pipe("select event_id, pub0, pub1 from rr"),
    "resolve_models": _pipe("select event_id, hid0, hid1 from rr"),
    "battle_validity": _pipe("select event_id, reason from rr"),
    "classify_anony": _pipe("select event_id, anony from rr"),
    "detect_language": "with " + _lang("doc_id", "text", "documents") + """
select d.doc_id, coalesce(b.language, 'unknown') language, d.lang, d.doc_id % 5 = 0 held_out
from documents d left join best b using (doc_id)""",
    "identity_leak": _pipe("select event_id, reason = 'leaked_identity' leaked from rr"),
    "rename_model": _pipe("select event_id, model_a, model_b from kept", KEPT),
    "vote_to_win": with_recipes("raw_votes", f"""
select event_id, case "type" when 'leftvote' then 'model_a' when 'rightvote' then 'model_b' when 'tievote' then 'tie'
       else 'tie (bothbad)' end win from raw_votes where "type" in {VOTES_SQL}"""),
    "clean_battles": _pipe("""select k.event_id, model_a, model_b, win, anony, rounds, coalesce(b.language, 'unknown') language, tstamp
from kept k left join best b using (event_id)""", KEPT + ",\n" + _lang("event_id", "first_text", "kept")),
    "cleaning_counters": _pipe("""select count(*) votes, count(*) filter (where reason like 'invalid%') invalid,
  count(*) filter (where reason = 'leaked_identity') leaked_identity, count(*) filter (where reason = 'kept') battles,
  count(*) filter (where anony and reason <> 'invalid_names') anony from rr"""),
    "model_catalog": _pipe("""select distinct model from (select hid0 model from rr where reason = 'kept'
  union all select hid1 from rr where reason = 'kept')"""),
    "won_conversations": with_recipes(["raw_votes", "turns"], """
with w as (select event_id, conv_id, leak from raw_votes where "type" = 'rightvote' and hidden_a = 'bard' and hidden_b = 'm1'),
n as (select conv_id, count(*) n from turns group by conv_id)
select w.event_id, 'm1' winner, 'bard' loser, 'winner' side, t.i, t.role, t.text from w join turns t using (conv_id)
union all select w.event_id, 'm1', 'bard', 'winner', n.n, 'assistant', w.leak from w join n using (conv_id) where w.leak <> ''
union all select w.event_id, 'm1', 'bard', 'loser', t.i, t.role, t.text from w join turns t using (conv_id)"""),
}
