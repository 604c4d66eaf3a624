"""Registered queries of the ratings group and their DuckDB oracles.

A board is a user: ratings, replicates, ranks and leaderboards are per board. The
oracles fold all boards (and replicates) together, one recursion step a position.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog.common import flat
from estuary.catalog.fixtures_sql import with_recipes
from estuary.operators import ratings as R
from estuary.sources import tables as TB

BOOT_ROUNDS = 1000  # the reference's bootstrap rounds


def _anony(spark, d):
    return R.rating_input(TB.battles(spark, d))


def _no_ties(spark, d):
    return R.rating_input(TB.battles(spark, d), no_ties=True)


def q_rating_input(spark, d):
    b = _anony(spark, d)
    return flat(b.select("event_id", "model_a", "model_b", "win", (~F.col("win").contains("tie")).alias("no_tie")))


def q_elo_online(spark, d):
    return flat(R.elo_online(_anony(spark, d)).select("board", "model", F.round("rating", 6).alias("rating")))


def _boot(spark, d, lists=False):
    return R.bootstrap_elo(_anony(spark, d), rounds=BOOT_ROUNDS, seed=42, lists=lists)


def q_bootstrap_elo(spark, d):
    return flat(_boot(spark, d).select("board", "replicate", "model", F.round("rating", 6).alias("rating")))


def q_elo_median(spark, d):
    return flat(R.elo_median(_boot(spark, d, lists=True)))


def q_elo_interval(spark, d):
    i = R.elo_interval(_boot(spark, d, lists=True))
    return flat(i.select("board", "model", *[F.round(c, 6).alias(c) for c in
                                    ("lower", "rating", "upper", "error_y", "error_y_minus", "rating_rounded")]))


def q_model_order(spark, d):
    return flat(R.model_order(R.elo_online(_anony(spark, d))).select("board", "model", "rank"))


def q_pairwise_win_fraction(spark, d):
    p = R.pairwise_win_fraction(_no_ties(spark, d))
    return flat(p.select("model_a", "model_b", "wins", "battles", F.round("fraction", 6).alias("fraction")))


def q_win_fraction_order(spark, d):
    o = R.win_fraction_order(R.pairwise_win_fraction(_no_ties(spark, d)))
    return flat(o.select("model_a", "model_b", F.round("fraction", 6).alias("fraction"), "row_rank", "col_rank"))


def q_win_fraction_given_order(spark, d):
    """The matrix in a given order: registered models by registry position."""
    names = [m[0] for m in R.MODEL_REGISTRY]
    order = spark.createDataFrame([(m, k + 1) for k, m in enumerate(names)], "model string, rank int")
    o = R.win_fraction_order(R.pairwise_win_fraction(_no_ties(spark, d)), order)
    return flat(o.select("model_a", "model_b", F.round("fraction", 6).alias("fraction"), "row_rank", "col_rank"))


def q_average_win_rate(spark, d):
    a = R.average_win_rate(R.pairwise_win_fraction(_no_ties(spark, d)))
    return flat(a.select("model", F.round("avg_win_rate", 6).alias("avg_win_rate")))


def q_battle_counts(spark, d):
    return flat(R.battle_counts(_no_ties(spark, d)))


def q_leaderboard(spark, d):
    lb = R.leaderboard(R.elo_online(_anony(spark, d)), R.registry(spark))
    return flat(lb.select("board", "rank", "model", "line"))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

NAMED = """ab as (select row_number() over (partition by board order by tstamp, event_id) - 1 pos, board, event_id, model_a, model_b, win
       from battles where anony),
names as (select m, row_number() over (order by m) k from (select model_a m from ab union select model_b from ab)),
seq as (select ab.board, ab.pos, na.k ia, nb.k ib,
               case win when 'model_a' then 1.0 when 'model_b' then 0.0 else 0.5 end::double sa
        from ab join names na on na.m = ab.model_a join names nb on nb.m = ab.model_b),
n_of as (select board, count(*) n from ab group by board)"""
# one step of all folds: the ratings of both models, others as they were (NULL: not met yet)
STEP = """list_transform(range(1, len(r.ratings) + 1), lambda k:
      case when k = s.ia then coalesce(r.ratings[s.ia], 1000.0) + 4 * (s.sa - 1 / (1 + pow(10, (coalesce(r.ratings[s.ib], 1000.0) - coalesce(r.ratings[s.ia], 1000.0)) / 400)))
           when k = s.ib then coalesce(r.ratings[s.ib], 1000.0) + 4 * (1 - s.sa - 1 / (1 + pow(10, (coalesce(r.ratings[s.ia], 1000.0) - coalesce(r.ratings[s.ib], 1000.0)) / 400)))
           else r.ratings[k] end)"""
NONE_MET = "list_transform(range((select count(*) from names)), lambda x: null::double)"

ELO = f"""{NAMED},
firsts as (select board, m, min(p) first_pos from (select board, model_a m, pos * 2 p from ab union all select board, model_b, pos * 2 + 1 from ab) group by all),
r(board, pos, ratings) as (
  select board, -1::bigint, {NONE_MET} from n_of
  union all
  select r.board, s.pos, {STEP} from r join seq s on s.board = r.board and s.pos = r.pos + 1),
fin as (select board, arg_max(ratings, pos) ratings from r group by board),
elo as (select f.board, f.m model, fin.ratings[n.k] rating, f.first_pos from firsts f join fin using (board) join names n on n.m = f.m),
ranked as (select board, model, rating, row_number() over (partition by board order by rating desc, first_pos) "rank" from elo)"""

BOOT = f"""{NAMED},
d(board, replicate, j, ratings, n) as (
  select board, cast(x.i as bigint), -1::bigint, {NONE_MET}, n from n_of, range({BOOT_ROUNDS}) x(i)
  union all
  select r.board, r.replicate, r.j + 1, {STEP}, r.n
  from d r join seq s on s.board = r.board and r.j + 1 < r.n
   and s.pos = ('0x' || substr(md5('42|' || r.board || '|' || r.replicate || '|' || (r.j + 1)), 1, 15))::bigint % r.n),
last as (select board, replicate, ratings from d where j = n - 1),
boot as (select board, replicate, m model, ratings[k] rating from last, names where ratings[k] is not null)"""

PAIRS = """b as (select * from battles where anony and win not like '%tie%'),
pc as (select model_a, model_b, count(*) filter (where win = 'model_a') a_wins, count(*) filter (where win = 'model_b') b_wins,
              count(*) n from b group by 1, 2),
m as (select model_a i, model_b j, a_wins w, n from pc union all select model_b, model_a, b_wins, n from pc),
cells as (select i, j, sum(w) wins, sum(n) battles from m group by i, j),
lab_a as (select model_a model, sum(a_wins) > 0 a_idx, sum(b_wins) > 0 b_idx from pc group by 1),
lab_b as (select model_b model, sum(a_wins) > 0 a_col, sum(b_wins) > 0 b_col from pc group by 1),
lab as (select coalesce(a.model, b.model) model,
               coalesce(a.a_idx, false) and coalesce(b.b_col, false) and a.model is not null and b.model is not null row_ok,
               coalesce(b.a_col, false) and coalesce(a.b_idx, false) and a.model is not null and b.model is not null col_ok
        from lab_a a full join lab_b b on a.model = b.model),
frac as (select i model_a, j model_b, cast(wins as bigint) wins, cast(battles as bigint) battles,
                case when li.row_ok and lj.col_ok then wins / battles end fraction
         from cells left join lab li on li.model = i left join lab lj on lj.model = j),
avgw as (select model_a model, avg(fraction) avg_win_rate from frac group by 1),
ord as (select model, row_number() over (order by avg_win_rate desc nulls last, model) "rank" from avgw)"""

ORACLE = {
    "rating_input": with_recipes("battles", """
select event_id, model_a, model_b, win, win not like '%tie%' no_tie from battles where anony"""),
    "elo_online": with_recipes("battles", "with recursive " + ELO + "\nselect board, model, round(rating, 6) rating from elo"),
    "model_order": with_recipes("battles", "with recursive " + ELO + "\nselect board, model, \"rank\" from ranked"),
    "leaderboard": with_recipes("battles", "with recursive " + ELO + f""",
reg(full_name, link, description) as (values {", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (e[0], e[2], e[3])) + ")" for e in R.MODEL_REGISTRY)})
select board, "rank", model, '| ' || "rank" || ' | ' || case "rank" when 1 then '🥇' when 2 then '🥈' when 3 then '🥉' else '' end
       || ' [' || model || '](' || coalesce(link, 'None') || ') | ' || printf('%.0f', rating) || ' | ' || coalesce(description, 'None')
       || ' |' line from ranked left join reg on full_name = model"""),
    "bootstrap_elo": with_recipes("battles", "with recursive " + BOOT + "\nselect board, replicate, model, round(rating, 6) rating from boot"),
    "elo_median": with_recipes("battles", "with recursive " + BOOT + """
select board, model, cast(floor(quantile_cont(rating, 0.5) + 0.5) as bigint) rating from boot group by all"""),
    "elo_interval": with_recipes("battles", "with recursive " + BOOT + """,
q as (select board, model, quantile_cont(rating, 0.025) lower, quantile_cont(rating, 0.5) rating, quantile_cont(rating, 0.975) upper
      from boot group by all)
select board, model, round(lower, 6) lower, round(rating, 6) rating, round(upper, 6) upper, round(upper - rating, 6) error_y,
       round(rating - lower, 6) error_y_minus, round_even(rating, 2) rating_rounded from q"""),
    "pairwise_win_fraction": with_recipes("battles", "with " + PAIRS + """
select model_a, model_b, wins, battles, round(fraction, 6) fraction from frac"""),
    "win_fraction_order": with_recipes("battles", "with " + PAIRS + """
select f.model_a, f.model_b, round(f.fraction, 6) fraction, r1."rank" row_rank, r2."rank" col_rank
from frac f join ord r1 on r1.model = f.model_a join ord r2 on r2.model = f.model_b"""),
    "win_fraction_given_order": with_recipes("battles", "with " + PAIRS + f""",
given as (select unnest({[m[0] for m in R.MODEL_REGISTRY]}) model, unnest(range(1, {len(R.MODEL_REGISTRY) + 1})) "rank"),
ranked_cells as (select f.*, g."rank" col_rank from frac f join given g on g.model = f.model_b)
select g.model model_a, c.model_b, round(c.fraction, 6) fraction, cast(g."rank" as bigint) row_rank, cast(c.col_rank as bigint) col_rank
from given g left join ranked_cells c on c.model_a = g.model"""),
    "average_win_rate": with_recipes("battles", "with " + PAIRS + "\nselect model, round(avg_win_rate, 6) avg_win_rate from avgw"),
    "battle_counts": with_recipes("battles", """
with b as (select * from battles where anony and win not like '%tie%')
select i model_a, j model_b, cast(sum(n) as bigint) battles from (
  select model_a i, model_b j, count(*) n from b group by 1, 2 union all select model_b, model_a, count(*) from b group by 1, 2)
group by 1, 2"""),
}
