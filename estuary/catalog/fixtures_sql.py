"""DuckDB text of the input recipes (FIXTURES.md part B) for the oracle side.

The driver registers only the raw tables, so every oracle query carries the
recipes it needs as common table expressions.
"""

from __future__ import annotations

import re

NAMES = "['gpt-4', 'gpt-3.5-turbo', 'claude-v1', 'vicuna-13b', 'vicuna-7b', 'koala-13b', 'm6', 'm7']"

RECIPES = {
    "site_day": """
select cast(user_id as int) n, cast(4178000 + 500 * (user_id) as varchar) site, cast(ts as date) "date",
  cast(sum(cast(value as decimal(18,2))) filter (event_type not in ('purchase','signup')) as double) sediment,
  cast(sum(cast(value as decimal(18,2))) filter (event_type in ('purchase','signup')) as double) discharge
from events group by 1, 2, 3""",
    "site_fold": """
select cast(user_id % 20 as int) n, cast(4178000 + 500 * (user_id % 20) as varchar) site, cast(ts as date) "date",
  cast(sum(cast(value as decimal(18,2))) filter (event_type not in ('purchase','signup')) as double) sediment,
  cast(sum(cast(value as decimal(18,2))) filter (event_type in ('purchase','signup')) as double) discharge
from events group by 1, 2, 3""",
    "flow_edge": """
select cast(user_id % 20 as int) src, cast((user_id + cast(json_extract(props,'$.k') as int)) % (20) as int) dst,
  count(*) - avg(count(*)) over () direction from events group by 1, 2""",
    "flow_user": """
select cast(user_id as int) src, cast((user_id + cast(json_extract(props,'$.k') as int)) % (select max(user_id) + 1 from events) as int) dst,
  count(*) - avg(count(*)) over () direction from events group by 1, 2""",
    "conv_log": """
select event_id, epoch(ts) tstamp, 'm' || (user_id % 8) model,
  case event_type when 'click' then 'chat' when 'view' then 'leftvote' when 'purchase' then 'rightvote'
       when 'signup' then 'tievote' else 'bothbad_vote' end "type",
  case when cast(json_extract(props,'$.k') as int) % 2 = 0 then ['',''] else ['m' || (user_id % 8), 'm' || ((user_id+1) % 8)] end models
from events""",
    "battles": f"""
select user_id::bigint board, event_id, epoch(ts) tstamp, {NAMES}[1 + user_id % 8] model_a,
  {NAMES}[1 + (user_id + 1 + cast(json_extract(props,'$.k') as int) % 7) % 8] model_b,
  case event_type when 'click' then 'model_a' when 'view' then 'model_b' when 'purchase' then 'tie' else 'tie (bothbad)' end win,
  cast(json_extract(props,'$.k') as int) % 3 <> 0 anony
from events""",
    "raw_votes": """
select e.event_id, epoch(e.ts) tstamp,
  case e.event_type when 'click' then 'leftvote' when 'view' then 'rightvote' when 'purchase' then 'tievote' when 'signup' then 'bothbad_vote' else 'chat' end "type",
  case e.event_id % 5 when 0 then ['',''] when 1 then ['', 'bard'] when 2 then ['Model A','Model B']
       when 3 then ['<h3>Model A: bard</h3>' || chr(10), '<h3>Model B: m1</h3>' || chr(10)] else ['m0','m1'] end models,
  case when e.event_id % 11 = 0 then null else 'bard' end hidden_a, 'm1' hidden_b, cast(e.event_id % 3 as int) "offset",
  c.conv_id, case when e.event_id % 13 = 0 then ' I am ChatGPT' else '' end leak
from events e join (select distinct conv_id from conversations) c on c.conv_id = e.event_id % (select count(distinct conv_id) from conversations)""",
    "turns": """
select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) - 1 i from conversations""",
    "requests": """
select o_orderkey request_id, 'm' || (o_custkey % 9) model, cast(o_orderkey % 600 - 20 as int) max_tokens, cast(o_orderkey % 5 as int) n,
  (o_custkey % 30) / 10.0::double - 0.4 temperature, (o_orderkey % 14) / 10.0::double - 0.1 top_p, cast(o_orderkey % 2100 as int) token_num from orders""",
    "chunks": """
select doc_id stream_id, cast(s as int) seq, substr(text, 1, (length(text) * least(s, 5) + 4) // 5) text, case when s = 6 then 'stop' end finish_reason
from documents, range(1, 7) r(s)""",
    "heartbeats": f"""
select event_id, 'w' || (user_id % 50) worker, epoch(ts) beat, cast(json_extract(props,'$.k') as int) % 8 queue_length,
  1 + user_id % 3 speed, user_id % 4 <> 0 check_heart_beat, [{NAMES}[1 + user_id % 50 % 8], {NAMES}[1 + user_id % 50 % 5]] model_names from events""",
    "metric_log": """
select l_suppkey run_id, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) epoch, l_discount + l_tax loss from lineitem""",
    "predictions": """
select event_id, value y_true, lag(value) over (partition by user_id order by ts, event_id) y_pred from events""",
    "labelled": """
select vec_id, label, cast((label + case when vec_id % 7 = 0 then 1 else 0 end) % 10 as int) pred from embeddings""",
    "params": """
select 'p' || vec_id name, embedding base_values, list_transform(embedding, lambda x: x + label * 0.01) target_values from embeddings""",
    "graph_items": """
select 'g_' || vec_id id, vec_id node_idx, [vec_id, (vec_id + 1) % n, (vec_id + 7) % n] node_list, [[0,0],[1,2]] edge_index
from embeddings, (select count(*) n from embeddings)""",
    "reviews": """
select d.doc_id, cast(d.doc_id * 7919 % 10007 as bigint) "Time", d.source "ProductId", l.quality "Score", split_part(d.text, chr(10), 1) "Summary", d.text "Text" from documents d left join labels l using (doc_id)""",
    "content": """
select doc_id, date '2024-01-01' + cast(doc_id % 30 as int) "date", md5(text) h from documents""",
}


def with_recipes(names: list[str] | str, body: str) -> str:
    """Prefix ``body`` with the recipes as CTEs (merging a leading WITH)."""
    if isinstance(names, str):
        names = [names]
    ctes = ",\n".join(f"{n} as ({RECIPES[n].strip()})" for n in names)
    stripped = body.strip()
    m = re.match(r"(?is)^with\s+(recursive\s+)?", stripped)
    if m:
        rec = "recursive " if m.group(1) else ""
        return f"with {rec}{ctes},\n{stripped[m.end():]}"
    return f"with {ctes}\n{stripped}"
