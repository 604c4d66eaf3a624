"""Registered queries of the spatio-temporal group and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from estuary.catalog.common import flat, scratch_path
from estuary.catalog.fixtures_sql import with_recipes
from estuary.operators import series as S
from estuary.sources import files
from estuary.sources import tables as TB

CODES = [str(TB.SITE_BASE + TB.SITE_STEP * i) for i in range(TB.N_SITES)]


def _folded(spark, d):
    return TB.site_fold(spark, d).select("n", "site").distinct()


def _dense(spark, d):
    return S.densify_series(TB.site_day(spark, d), TB.site_dim(spark, d), TB.calendar(spark, d))


def _windows(spark, d, drop_last=True):
    return S.sliding_windows(_dense(spark, d), drop_last=drop_last)


def _flow_text(spark, d):
    return S.flow_description(S.flow_neighbors(TB.flow_user(spark, d), TB.site_dim(spark, d)))


def _rendered(spark, d):
    return S.render_instruction(_windows(spark, d), _flow_text(spark, d), TB.site_dim(spark, d))


def _snapshots(spark, d):
    return S.assemble_snapshots(_windows(spark, d))


def _window_cells(w):
    cells = F.arrays_zip(F.concat("x_sediment", "y_sediment").alias("s"), F.concat("x_discharge", "y_discharge").alias("q"))
    return w.select("n", "site", "t", F.posexplode(cells).alias("k", "c")).select(
        "n", "site", "t", "k", F.col("c.s").alias("sediment"), F.col("c.q").alias("discharge"))


def q_scan_wide_series(spark, d):
    path = scratch_path(spark, "sediment_wide")
    files.sink_csv(S.to_wide(TB.site_fold(spark, d), CODES, "sediment"), path)
    return flat(files.scan_wide_series(spark, path, CODES))


def q_scan_flow_matrix(spark, d):
    m = S.flow_matrix_edges(TB.flow_edge(spark, d), _folded(spark, d))
    wide = m.groupBy("src_id").pivot("dst_col", [c.zfill(8) for c in CODES]).agg(F.first("direction"))
    path = scratch_path(spark, "flow_matrix")
    files.sink_csv(wide.withColumnRenamed("src_id", "Unnamed: 0"), path)
    return flat(files.scan_flow_matrix(spark, path))


def q_date_spine(spark, d):
    return flat(S.date_spine_of(TB.table(spark, d, "events").select("ts"), "ts"))


def q_date_membership_filter(spark, d):
    return flat(S.date_membership_filter(TB.site_day(spark, d), "2024-01-05", "2024-01-20"))


def q_fill_missing_zero(spark, d):
    return flat(S.fill_missing_zero(TB.site_day(spark, d)))


def q_unpivot_sites(spark, d):
    wide = S.to_wide(TB.site_fold(spark, d), CODES, "sediment")
    return flat(S.unpivot_sites(wide, "sediment"))


def q_densify_series(spark, d):
    return flat(_dense(spark, d))


def q_merge_features(spark, d):
    sd = TB.site_day(spark, d)
    sed = sd.where(F.col("sediment").isNotNull()).select("site", "date", "sediment")
    dis = sd.where(F.col("discharge").isNotNull()).select("site", "date", "discharge")
    m = S.merge_features(sed, dis)
    return flat(m.select("site", "date", "sediment", "discharge",
                         F.col("_sp").isNotNull().alias("has_sediment"), F.col("_dp").isNotNull().alias("has_discharge")))


def q_stack_cube(spark, d):
    c = S.stack_cube(_dense(spark, d), chunk=16)
    e = c.select("n", "site", "chunk", F.posexplode("values").alias("i", "v"))
    return flat(e.select("n", "site", "chunk", "i", F.col("v")[0].alias("sediment"), F.col("v")[1].alias("discharge")))


def _lookup_requests(spark, d):
    ev = TB.table(spark, d, "events").select("user_id", "ts")
    return ev.select((F.lit(TB.SITE_BASE) + TB.SITE_STEP * (F.col("user_id") + 5)).cast("string").alias("site"),
                     F.col("ts").cast("date").alias("date")).distinct()


def q_point_lookup(spark, d):
    return flat(S.point_lookup(_lookup_requests(spark, d), TB.site_day(spark, d)))


def q_range_missing_report(spark, d):
    sites = TB.site_dim(spark, d).select((F.lit(TB.SITE_BASE) + TB.SITE_STEP * (F.col("n") + 2)).cast("string").alias("site"))
    r = S.range_missing_report(TB.site_day(spark, d), sites, "2024-01-05", "2024-01-25")
    return flat(r.withColumn("missing_dates", F.array_join(F.transform("missing_dates", lambda x: x.cast("string")), ",")))


def q_site_labels(spark, d):
    sites = TB.site_day(spark, d).select("n", "site").distinct()
    return flat(S.site_labels(sites))


def q_flow_lookup(spark, d):
    """Every site and the one three places on, in the flow between all sites."""
    ev = TB.table(spark, d, "events").select("user_id")
    code = lambda n: (F.lit(TB.SITE_BASE) + TB.SITE_STEP * n).cast("string")
    pairs = ev.select(code(F.col("user_id")).alias("src"), code(F.col("user_id") + 3).alias("dst")).distinct()
    edges = TB.flow_user(spark, d).select(code(F.col("src")).cast("long").alias("src_id"),
                                          F.lpad(code(F.col("dst")), 8, "0").alias("dst_col"), "direction")
    return flat(S.flow_lookup(pairs, edges))


def q_flow_neighbors(spark, d):
    nb = S.flow_neighbors(TB.flow_user(spark, d), TB.site_dim(spark, d))
    return flat(nb.select("n", "site", F.array_join("incoming", ", ").alias("incoming"),
                          F.array_join("outgoing", ", ").alias("outgoing")))


def q_flow_description(spark, d):
    return flat(_flow_text(spark, d))


def q_sliding_windows(spark, d):
    return flat(_window_cells(_windows(spark, d)))


def q_sliding_windows_encoder(spark, d):
    return flat(_window_cells(_windows(spark, d, drop_last=False)))


def q_format_values(spark, d):
    return flat(S.format_values(_windows(spark, d)).select("n", "t", "sediment_str", "discharge_str"))


def q_time_range_phrase(spark, d):
    return flat(S.time_range_phrase(_windows(spark, d)).select("n", "t", "time_range"))


def q_render_instruction(spark, d):
    return flat(_rendered(spark, d))


def q_instruction_id(spark, d):
    return flat(S.instruction_id(_windows(spark, d)).select("n", "t", "id"))


def q_nest_conversation(spark, d):
    nc = S.nest_conversation(_rendered(spark, d))
    e = nc.select("id", F.posexplode("conversations").alias("pos", "c"))
    return flat(e.select("id", "pos", F.col("c.from").alias("from"), F.col("c.value").alias("value")))


def q_assemble_snapshots(spark, d):
    return flat(S.snapshot_cells(_snapshots(spark, d)))


def _parsed(spark, d):
    return S.parse_instruction_id(_rendered(spark, d).select("id"))


def q_parse_instruction_id(spark, d):
    return flat(_parsed(spark, d))


def q_join_snapshot(spark, d):
    j = S.join_snapshot(_parsed(spark, d), _snapshots(spark, d))
    return flat(j.select("id", "snapshot", "region_start", "region_end", F.size("data_x").alias("steps"),
                         F.size(F.element_at("data_x", 1)).alias("width")))


def q_slice_region(spark, d):
    cells = S.snapshot_cells(_snapshots(spark, d))
    return flat(S.slice_region(_parsed(spark, d), cells).select("id", "step", "site_n", "x_sediment", "x_discharge", "y_sediment", "y_discharge"))


def q_zscore_by_site(spark, d):
    z = S.zscore_by_site(_dense(spark, d))
    return flat(z.select("n", "t", "f", F.round("z", 6).alias("z")))


def q_zscore_inverse(spark, d):
    dense = _dense(spark, d)
    inv = S.zscore_inverse(S.zscore_by_site(dense), S.zscore_stats(dense))
    return flat(inv.select("n", "t", "f", F.round("value", 6).alias("value")))


def q_batch_assign(spark, d):
    b = S.batch_assign(_windows(spark, d).select("n", "site", "t"), ["site", "t"], seed=42, batch_size=64)
    return flat(b.select("n", "t", "pos", "batch"))


QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}

# ------------------------------------------------------------------ oracles

DENSE = """dense as (
  select g.n, g.site, g.t, g."date", coalesce(s.sediment, 0.0) sediment,
         case when s.site is null then 0.0 else coalesce(s.discharge, 'nan'::double) end discharge
  from (select cast(a.n as bigint) n, cast(4178000 + 500 * a.n as varchar) site, cast(b.t as bigint) t,
               (select min(cast(ts as date)) from events) + cast(b.t as int) "date"
        from (select distinct user_id n from events) a,
             range((select datediff('day', min(cast(ts as date)), max(cast(ts as date))) + 1 from events)) b(t)) g
  left join site_day s on s.site = g.site and s."date" = g."date")"""

WINDOWS = """starts as (select n, site, t, "date" from dense where t <= (select max(t) from dense) - {last}),
wcells as (select s.n, s.site, s.t, d.t - s.t k, d."date", d.sediment, d.discharge
           from starts s join dense d on d.site = s.site and d.t between s.t and s.t + 23)"""

FMT = "case when isnan({v}) then 'nan' else printf('%.2f', {v}) end"

WINDOW_TEXT = """wtext as (
  select n, site, t,
    string_agg(case when k < 12 then """ + FMT.format(v="sediment") + """ end, ' ' order by k) sediment_str,
    string_agg(case when k < 12 then """ + FMT.format(v="discharge") + """ end, ' ' order by k) discharge_str,
    strftime(min("date"), '%B %d, %Y, %H:%M, %A') || ' to ' || strftime(min("date") + 11, '%B %d, %Y, %H:%M, %A') time_range
  from wcells group by n, site, t)"""

FLOW = """users as (select distinct user_id n from events),
lab as (select n, 'site ' || chr(cast(65 + n as int)) label from users),
inc as (select e.dst n, string_agg('from ' || l.label, ', ' order by e.src) s
        from flow_user e join lab l on l.n = e.src where e.direction > 0 and e.src <> e.dst group by e.dst),
outg as (select e.src n, string_agg('to ' || l.label, ', ' order by e.dst) s
         from flow_user e join lab l on l.n = e.dst where e.direction > 0 and e.src <> e.dst group by e.src),
nb as (select cast(r.n as bigint) n, cast(4178000 + 500 * r.n as varchar) site,
              coalesce(inc.s, '') incoming, coalesce(outg.s, '') outgoing
       from users r left join inc on inc.n = r.n left join outg on outg.n = r.n),
ft as (select n, site, case when incoming <> '' then 'The water flows into this site: ' || incoming || '. ' else '' end
                     || case when outgoing <> '' then 'The water flows out from this site: ' || outgoing || '. ' else '' end flow_text
       from nb)"""

RENDER = """rendered as (
  select 'train_discharge_site_' || w.n || '_' || (w.n + 1) || '_len_' || w.t id, w.n, w.t,
    'Given the historical data for sediment and discharge over 12 time steps in site ' || chr(cast(65 + w.n as int))
    || ', the recorded sediment values are [' || w.sediment_str || '], and the recorded discharge values are ['
    || w.discharge_str || ']. The recording time of the historical data is ''' || w.time_range
    || ', with data points recorded at 1-day intervals''. Note: A sediment value of 0.00 indicates missing data. '
    || 'Now we aim to predict the sediment and discharge in this region within the next 12 time steps. '
    || ft.flow_text || ' To improve prediction accuracy, a spatio-temporal model is utilized to encode the historical data as tokens <ST_HIS>, '
    || 'where the first token corresponds to sediment and the second token corresponds to discharge. '
    || 'Please conduct an analysis of the patterns in this region, considering the provided time and information, '
    || 'and then generate the prediction tokens for classification, in the form <ST_PRE>.' human,
    'Based on the given information, the predicted tokens in this region are <ST_PRE>.' gpt
  from wtext w join ft on ft.n = w.n)"""


def _wsql(body: str, last: int = 24, flow: bool = False) -> str:
    parts = [DENSE, WINDOWS.format(last=last), WINDOW_TEXT]
    rec = ["site_day"]
    if flow:
        parts += [FLOW, RENDER]
        rec.append("flow_user")
    return with_recipes(rec, "with " + ",\n".join(parts) + "\n" + body)


_pivot_cols = ", ".join(f"max(sediment) filter (where site = '{c}') \"{c}\"" for c in CODES)

SNAP = """snap as (
  select a.t snapshot, a.k step, a.n site_n, a.sediment x_sediment, a.discharge x_discharge,
         b.sediment y_sediment, b.discharge y_discharge
  from wcells a join wcells b on b.n = a.n and b.t = a.t and b.k = a.k + 12 where a.k < 12)"""

PARSED = """parsed as (select id, cast(split_part(id, '_', 4) as int) region_start, cast(split_part(id, '_', 5) as int) region_end,
                   cast(split_part(id, '_', 7) as int) snapshot from rendered)"""

ZSTATS = """fl as (select n, site, t, 0 f, sediment v from dense union all select n, site, t, 1 f, discharge v from dense),
zs as (select n, avg(v) mean, stddev_pop(v) std from fl group by n),
zz as (select fl.n, fl.t, fl.f, case when zs.std = 0 then null else (fl.v - zs.mean) / zs.std end z, zs.mean, zs.std
       from fl join zs on zs.n = fl.n)"""

ORACLE = {
    "scan_wide_series": with_recipes("site_fold", f"""
select strftime("date", '%Y-%m-%d') "date", {_pivot_cols} from site_fold group by "date" """),
    "scan_flow_matrix": with_recipes("flow_edge", """
select cast(4178000 + 500 * src as bigint) src_id, lpad(cast(4178000 + 500 * dst as varchar), 8, '0') dst_col, direction
from flow_edge"""),
    "date_spine": """
select cast(datediff('day', d0, d) as bigint) t, strftime(d, '%Y-%m-%d') "date"
from (select min(cast(ts as date)) d0, max(cast(ts as date)) d1 from events) m,
     unnest(generate_series(m.d0, m.d1, interval 1 day)) g(d)""",
    "date_membership_filter": with_recipes("site_day", """
select cast(n as bigint) n, site, strftime("date", '%Y-%m-%d') "date", sediment, discharge from site_day
where "date" between date '2024-01-05' and date '2024-01-20'"""),
    "fill_missing_zero": with_recipes("site_day", """
select cast(n as bigint) n, site, strftime("date", '%Y-%m-%d') "date", coalesce(sediment, 0.0) sediment, discharge from site_day"""),
    "unpivot_sites": with_recipes("site_fold", """
with wide_dates as (select distinct "date" from site_fold),
codes as (select cast(4178000 + 500 * n as varchar) site from range(0, 20) r(n))
select strftime(w."date", '%Y-%m-%d') "date", c.site, s.sediment
from wide_dates w cross join codes c left join site_fold s on s."date" = w."date" and s.site = c.site"""),
    "densify_series": with_recipes("site_day", "with " + DENSE + """
select n, site, t, strftime("date", '%Y-%m-%d') "date", sediment, discharge from dense"""),
    "merge_features": with_recipes("site_day", """
with sed as (select site, "date", sediment from site_day where sediment is not null),
dis as (select site, "date", discharge from site_day where discharge is not null)
select coalesce(sed.site, dis.site) site, strftime(coalesce(sed."date", dis."date"), '%Y-%m-%d') "date",
       sed.sediment, dis.discharge, sed.site is not null has_sediment, dis.site is not null has_discharge
from sed full outer join dis on sed.site = dis.site and sed."date" = dis."date" """),
    "stack_cube": with_recipes("site_day", "with " + DENSE + """
select n, site, cast(t // 16 as bigint) chunk, cast(t % 16 as bigint) i, sediment, discharge from dense"""),
    "point_lookup": with_recipes("site_day", """
with req as (select distinct cast(4178000 + 500 * (user_id + 5) as varchar) site, cast(ts as date) "date" from events)
select r.site, strftime(r."date", '%Y-%m-%d') "date",
       case when s.site is not null then coalesce(s.sediment, 0.0) end sediment,
       case when s.site is not null then coalesce(s.discharge, 'nan'::double) end discharge
from req r left join site_day s on s.site = r.site and s."date" = r."date" """),
    "range_missing_report": with_recipes("site_day", """
with sites as (select distinct cast(4178000 + 500 * (user_id + 2) as varchar) site from events),
inside as (select * from site_day where "date" between date '2024-01-05' and date '2024-01-25'),
agg as (select site, count(*) "rows", count(*) filter (where sediment is null) missing,
               coalesce(string_agg(strftime("date", '%Y-%m-%d'), ',' order by "date") filter (where sediment is null), '') missing_dates
        from inside group by site),
present as (select distinct site from site_day)
select s.site, p.site is not null found, a."rows", a.missing,
       round(100.0::double * (a."rows" - a.missing) / a."rows", 6) available_pct, a.missing_dates
from sites s left join present p on p.site = s.site left join agg a on a.site = s.site"""),
    "site_labels": with_recipes("site_day", """
select distinct cast(n as bigint) n, site, 'site ' || chr(cast(65 + n as int)) label from site_day"""),
    "flow_lookup": with_recipes("flow_user", """
with pairs as (select distinct cast(4178000 + 500 * user_id as varchar) src, cast(4178000 + 500 * (user_id + 3) as varchar) dst from events)
select p.src, p.dst, e.direction from pairs p
left join flow_user e on cast(4178000 + 500 * e.src as varchar) = p.src and cast(4178000 + 500 * e.dst as varchar) = p.dst"""),
    "flow_neighbors": with_recipes("flow_user", "with " + FLOW + "\nselect n, site, incoming, outgoing from nb"),
    "flow_description": with_recipes("flow_user", "with " + FLOW + "\nselect n, site, flow_text from ft"),
    "sliding_windows": _wsql("select n, site, t, cast(k as bigint) k, sediment, discharge from wcells"),
    "sliding_windows_encoder": _wsql("select n, site, t, cast(k as bigint) k, sediment, discharge from wcells", last=23),
    "format_values": _wsql("select n, t, sediment_str, discharge_str from wtext"),
    "time_range_phrase": _wsql("select n, t, time_range from wtext"),
    "render_instruction": _wsql("select id, n, t, human, gpt from rendered", flow=True),
    "instruction_id": _wsql("select n, t, 'train_discharge_site_' || n || '_' || (n + 1) || '_len_' || t id from wtext"),
    "nest_conversation": _wsql("""select id, cast(0 as bigint) pos, 'human' "from", human "value" from rendered
union all select id, cast(1 as bigint) pos, 'gpt' "from", gpt "value" from rendered""", flow=True),
    "zscore_by_site": with_recipes("site_day", "with " + DENSE + ",\n" + ZSTATS + """
select cast(n as bigint) n, t, cast(f as bigint) f, round(z, 6) z from zz"""),
    "zscore_inverse": with_recipes("site_day", "with " + DENSE + ",\n" + ZSTATS + """
select cast(n as bigint) n, t, cast(f as bigint) f, round(z * std + mean, 6) "value" from zz"""),
    "batch_assign": _wsql("""select n, t, pos, cast(floor(pos / 64) as bigint) batch from (
  select n, t, row_number() over (order by ('0x' || substr(md5(concat_ws('|', '42', site, cast(t as varchar))), 1, 15))::bigint, site, t) - 1 pos
  from wtext)"""),
}


def _with_more(extra: str, body: str, flow: bool = True) -> str:
    parts = [DENSE, WINDOWS.format(last=24), WINDOW_TEXT]
    rec = ["site_day"]
    if flow:
        parts += [FLOW, RENDER]
        rec.append("flow_user")
    parts.append(extra)
    return with_recipes(rec, "with " + ",\n".join(parts) + "\n" + body)


ORACLE["assemble_snapshots"] = _with_more(SNAP, "select snapshot, step, site_n, x_sediment, x_discharge, y_sediment, y_discharge from snap", flow=False)
ORACLE["join_snapshot"] = _with_more(PARSED, """select id, cast(snapshot as bigint) snapshot, cast(region_start as bigint) region_start,
  cast(region_end as bigint) region_end, cast(12 as bigint) steps,
  (select count(distinct user_id) from events) width from parsed""")
ORACLE["slice_region"] = _with_more(PARSED + ",\n" + SNAP, """select p.id, s.step, s.site_n, s.x_sediment, s.x_discharge, s.y_sediment, s.y_discharge
from parsed p join snap s on s.snapshot = p.snapshot where p.region_start <= s.site_n and s.site_n < p.region_end""")
ORACLE["parse_instruction_id"] = _with_more(PARSED, """select id, cast(region_start as bigint) region_start, cast(region_end as bigint) region_end,
  cast(snapshot as bigint) snapshot, false bad_id from parsed""")
