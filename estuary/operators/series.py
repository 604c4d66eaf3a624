"""Spatio-temporal preparation: dense site calendars, flow neighbours, sliding
input/target windows, instruction text and snapshots.

Canonical form is long: (n INT, site STRING, t INT, date DATE|TIMESTAMP,
sediment DOUBLE, discharge DOUBLE). Arrays appear only per window or per sink
chunk, never per whole series.
"""

from __future__ import annotations

from datetime import date as _date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.functions.exprs import fmt2, fmt2_join, long_date_text
from estuary.plans.ordinal import global_ordinal, halo_slices

# Special tokens and instruction wording of the reference dataset.
ST_HIS = "<ST_HIS>"
ST_PRE = "<ST_PRE>"
ST_START = "<ST_start>"
ST_END = "<ST_end>"
ST_PATCH = "<ST_patch>"
FEATURES = ("sediment", "discharge")


# ---------------------------------------------------------------- calendar


def n_steps(start: str, end: str) -> int:
    """Length of the inclusive daily calendar start..end (parameter arithmetic)."""
    return (_date.fromisoformat(end) - _date.fromisoformat(start)).days + 1


def step_value(start: str, t: Column, unit: str = "day") -> Column:
    if unit == "day":
        return F.date_add(F.lit(start).cast("date"), t.cast("int"))
    if unit == "hour":
        return F.timestamp_seconds(F.unix_seconds(F.lit(start).cast("timestamp")) + t.cast("long") * 3600)
    raise ValueError(unit)


def date_spine(spark: SparkSession, start: str, end: str, unit: str = "day", steps: int | None = None) -> DataFrame:
    """Inclusive calendar (t, date); t is the offset from start, never a row number."""
    total = steps if steps is not None else n_steps(start, end) * (24 if unit == "hour" else 1)
    return spark.range(total).select(F.col("id").cast("int").alias("t"), step_value(start, F.col("id"), unit).alias("date"))


def date_spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """Inclusive daily calendar spanning the data (min..max of ``date_col``):
    a one-row aggregate expanded by ``sequence`` (calendar-sized, not data-sized)."""
    rng = df.agg(F.min(F.col(date_col).cast("date")).alias("_d0"), F.max(F.col(date_col).cast("date")).alias("_d1"))
    days = rng.select("_d0", F.explode(F.sequence("_d0", "_d1", F.expr("interval 1 day"))).alias("date"))
    return days.select(F.datediff("date", "_d0").alias("t"), "date")


def date_membership_filter(df: DataFrame, start: str, end: str, date_col: str = "date") -> DataFrame:
    """Rows whose date is inside the inclusive range (pushes down to the scan)."""
    return df.where(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def fill_missing_zero(df: DataFrame, cols: list[str] = ["sediment"]) -> DataFrame:
    """``fillna(0)`` applied to sediment only (discharge keeps its gaps)."""
    return df.na.fill(0.0, subset=cols)


# ---------------------------------------------------------------- wide <-> long


def site_labels(sites: DataFrame) -> DataFrame:
    """``"site " + chr(65 + n)`` for the ordered site dimension."""
    letter = F.decode(F.unhex(F.lpad(F.hex(F.col("n") + 65), 8, "0")), "UTF-32")  # any code point
    return sites.withColumn("label", F.concat(F.lit("site "), letter))


def to_wide(long: DataFrame, site_codes: list[str], value: str, date_col: str = "date") -> DataFrame:
    """Wide table date + one column per site (explicit pivot values: no extra pass)."""
    return long.groupBy(date_col).pivot("site", site_codes).agg(F.first(value, ignorenulls=False))


def duplicate_dates(wide: DataFrame, date_col: str = "date") -> DataFrame:
    """Dates that occur more than once in a wide table (the reference fails on
    them; here they are reported and rejected). A partial-aggregated count."""
    return wide.groupBy(date_col).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def unpivot_sites(wide: DataFrame, value: str, sites: list[str] | None = None, date_col: str = "date",
                  reject_duplicates: bool = True) -> DataFrame:
    """Wide → long (date, site, value). The column list is cut to the requested
    sites before ``unpivot`` because Catalyst does not prune through Expand.
    Rows of duplicated dates are rejected (see :func:`duplicate_dates`)."""
    if reject_duplicates:
        wide = wide.join(duplicate_dates(wide, date_col).select(date_col), date_col, "left_anti")
    cols = [c for c in wide.columns if c != date_col]
    if sites is not None:
        wanted = set(sites)
        cols = [c for c in cols if c in wanted]
    return (wide.select(date_col, *cols)
            .unpivot([date_col], cols, "site", value))


def merge_features(sediment: DataFrame, discharge: DataFrame) -> DataFrame:
    """Both long features on (site, date); each input keeps a presence flag so
    that an absent row (→ 0) differs from an empty cell (→ NaN for discharge)."""
    s = sediment.select("site", "date", "sediment", F.lit(True).alias("_sp"))
    d = discharge.select("site", "date", "discharge", F.lit(True).alias("_dp"))
    return s.join(d, ["site", "date"], "full")


def densify_series(facts: DataFrame, sites: DataFrame, start: str | DataFrame, steps: int | None = None,
                   unit: str = "day", policy: str = "reference") -> DataFrame:
    """Dense (site × calendar) series with the reference's missing rules:
    sediment empty or absent → 0; discharge absent → 0, empty → NaN.

    The calendar is a start and a number of steps, or a one-row DataFrame (start
    date, steps) made from the data. The grid is generated per site with
    ``explode(sequence)``; the facts are joined on (site, date), which has unique
    keys, so no key is hot.
    """
    if isinstance(start, DataFrame):
        one = start.select(F.col("start").alias("_start"), F.col("steps").alias("_steps"))
        grid = sites.crossJoin(F.broadcast(one)).select(
            "n", "site", "_start", F.explode(F.sequence(F.lit(0), F.col("_steps") - 1)).alias("t"))
        grid = grid.select("n", "site", "t", F.date_add("_start", F.col("t")).alias("date"))
    else:
        grid = sites.select("n", "site", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("t"))
        grid = grid.withColumn("date", step_value(start, F.col("t"), unit))
    if "_dp" not in facts.columns:
        facts = facts.select("site", "date", "sediment", "discharge", F.lit(True).alias("_sp"), F.lit(True).alias("_dp"))
    joined = grid.join(facts.drop("n") if "n" in facts.columns else facts, ["site", "date"], "left")
    nan = F.lit(float("nan"))
    if policy == "reference":
        dis = F.when(F.col("_dp").isNull(), F.lit(0.0)).otherwise(F.coalesce(F.col("discharge"), nan))
    else:  # "zero": both features 0 when missing
        dis = F.coalesce(F.col("discharge"), F.lit(0.0))
    return joined.select("n", "site", "t", "date", F.coalesce(F.col("sediment"), F.lit(0.0)).alias("sediment"),
                         dis.alias("discharge"))


def stack_cube(dense: DataFrame, chunk: int = 4096) -> DataFrame:
    """(N, T, F) cube as rows of bounded chunks: one row per (site, chunk) with
    ``values[i] = [sediment, discharge]`` at t = chunk·size + i."""
    c = F.floor(F.col("t") / chunk).cast("int")
    return (dense.groupBy("n", "site", c.alias("chunk"))
            .agg(F.sort_array(F.collect_list(F.struct("t", "sediment", "discharge"))).alias("_v"))
            .select("n", "site", "chunk",
                    F.transform("_v", lambda s: F.array(s["sediment"], s["discharge"])).alias("values")))


# ---------------------------------------------------------------- lookups


def point_lookup(requests: DataFrame, facts: DataFrame) -> DataFrame:
    """Batched ``get_sediment``/``get_quantity``: requests (req_id, date, site)
    left join the long facts. Missing date or site → NULL; empty sediment → 0;
    empty discharge → NaN."""
    f = facts.select("site", "date", "sediment", "discharge", F.lit(True).alias("_p"))
    j = requests.join(f, ["site", "date"], "left")
    return j.select(*[c for c in requests.columns],
                    F.when(F.col("_p"), F.coalesce("sediment", F.lit(0.0))).alias("sediment"),
                    F.when(F.col("_p"), F.coalesce("discharge", F.lit(float("nan")))).alias("discharge"))


def range_missing_report(facts: DataFrame, sites: DataFrame, start: str, end: str) -> DataFrame:
    """Per site: rows in [start, end], number of empty sediment cells,
    availability %, and the sorted list of missing dates. Unknown sites are
    reported with ``found = false`` and no counts."""
    inside = date_membership_filter(facts, start, end)
    agg = inside.groupBy("site").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("sediment").isNull()).alias("missing"),
        F.sort_array(F.collect_list(F.when(F.col("sediment").isNull(), F.col("date")))).alias("missing_dates"))
    present = facts.select("site").distinct().withColumn("found", F.lit(True))
    return (sites.join(present, "site", "left").join(agg, "site", "left")
            .select("site", F.coalesce("found", F.lit(False)).alias("found"), "rows", "missing",
                    F.round(F.try_divide(100.0 * (F.col("rows") - F.col("missing")), F.col("rows")), 6).alias("available_pct"),
                    "missing_dates"))


# ---------------------------------------------------------------- flow


def flow_matrix_edges(edges: DataFrame, sites: DataFrame) -> DataFrame:
    """Edge list on ordinals → on 8-character zero-padded site codes."""
    s = sites.select("n", "site")
    a = s.select(F.col("n").alias("src"), F.col("site").alias("src_code"))
    b = s.select(F.col("n").alias("dst"), F.col("site").alias("dst_code"))
    return (edges.join(a, "src").join(b, "dst")
            .select(F.col("src_code").cast("long").alias("src_id"),
                    F.lpad("dst_code", 8, "0").alias("dst_col"), "direction"))


def flow_lookup(pairs: DataFrame, matrix_edges: DataFrame) -> DataFrame:
    """``get_direction(src, dst)``: zero-pad both ids to 8 characters, match the
    source by integer value and the target by column name; absent → NULL.
    Ids longer than 8 characters are kept whole (``zfill`` never truncates)."""
    pad = lambda c: F.when(F.length(c) >= 8, c).otherwise(F.lpad(c, 8, "0"))
    p = pairs.select("*", pad(F.col("src").cast("string")).cast("long").alias("_sid"),
                     pad(F.col("dst").cast("string")).alias("_dcol"))
    m = matrix_edges.select(F.col("src_id").alias("_sid"), F.col("dst_col").alias("_dcol"), "direction")
    return p.join(m, ["_sid", "_dcol"], "left").drop("_sid", "_dcol")


def flow_neighbors(edges: DataFrame, sites: DataFrame) -> DataFrame:
    """For every site: sources flowing in and targets flowing out (direction > 0,
    itself excluded), each list in site order. One scan of the edges instead of
    N² lookups."""
    lab = site_labels(sites).select("n", "label")
    pos = edges.where((F.col("direction") > 0) & (F.col("src") != F.col("dst")))
    incoming = (pos.join(lab.withColumnRenamed("n", "src"), "src")
                .groupBy(F.col("dst").alias("n"))
                .agg(F.sort_array(F.collect_list(F.struct("src", "label"))).alias("_in")))
    outgoing = (pos.join(lab.withColumnRenamed("n", "dst"), "dst")
                .groupBy(F.col("src").alias("n"))
                .agg(F.sort_array(F.collect_list(F.struct("dst", "label"))).alias("_out")))
    empty = F.array().cast("array<string>")
    return (sites.select("n", "site").join(incoming, "n", "left").join(outgoing, "n", "left")
            .select("n", "site",
                    F.coalesce(F.transform("_in", lambda s: F.concat(F.lit("from "), s["label"])), empty).alias("incoming"),
                    F.coalesce(F.transform("_out", lambda s: F.concat(F.lit("to "), s["label"])), empty).alias("outgoing")))


def flow_description(neighbors: DataFrame) -> DataFrame:
    """Two sentences, each omitted when its list is empty; trailing spaces kept."""
    inc = F.when(F.size("incoming") > 0, F.concat(F.lit("The water flows into this site: "),
                                                  F.array_join("incoming", ", "), F.lit(". "))).otherwise(F.lit(""))
    out = F.when(F.size("outgoing") > 0, F.concat(F.lit("The water flows out from this site: "),
                                                  F.array_join("outgoing", ", "), F.lit(". "))).otherwise(F.lit(""))
    return neighbors.select("n", "site", F.concat(inc, out).alias("flow_text"))


# ---------------------------------------------------------------- windows


def sliding_windows(dense: DataFrame, steps: int | None = None, in_len: int = 12, out_len: int = 12,
                    drop_last: bool = True, bucket: int = 4096) -> DataFrame:
    """Input window t..t+in-1 and target window t+in..t+in+out-1 per site.

    ``drop_last=True`` keeps the training loop's ``range(T-24)`` (the last full
    window is dropped); ``False`` is the encoder's ``range(T-in-out+1)``. T is each
    site's own length unless ``steps`` cuts it.
    """
    width = in_len + out_len
    full = width + (1 if drop_last else 0)  # the dropped window is the one nothing follows
    if steps is not None:
        dense = dense.where(F.col("t") < steps)
    # The two-decimal texts are made once per row here: inside the windows each
    # value would otherwise be formatted again for each of the windows it is in.
    texts = dense.select("n", "site", "t", "date", "sediment", "discharge", fmt2("sediment").alias("_s"), fmt2("discharge").alias("_d"))
    w = halo_slices(texts, ["n", "site"], "t", full, ["t", "date", "sediment", "discharge", "_s", "_d"], bucket)
    x = lambda c: F.slice(c, F.col("at"), F.lit(in_len))
    y = lambda c: F.slice(c, F.col("at") + in_len, F.lit(out_len))
    return w.select(
        "n", "site", F.element_at("t", F.col("at")).alias("t"), F.element_at("date", F.col("at")).alias("start_date"),
        F.element_at("date", F.col("at") + (in_len - 1)).alias("end_date"),
        x("sediment").alias("x_sediment"), x("discharge").alias("x_discharge"),
        y("sediment").alias("y_sediment"), y("discharge").alias("y_discharge"),
        F.array_join(x("_s"), " ").alias("_sediment_str"), F.array_join(x("_d"), " ").alias("_discharge_str"))


def format_values(windows: DataFrame) -> DataFrame:
    """``" ".join(f"{v:.2f}")`` of the input windows (texts made once per row by
    :func:`sliding_windows` when available)."""
    if "_sediment_str" in windows.columns:
        return windows.withColumnRenamed("_sediment_str", "sediment_str").withColumnRenamed("_discharge_str", "discharge_str")
    return windows.withColumn("sediment_str", fmt2_join("x_sediment")).withColumn("discharge_str", fmt2_join("x_discharge"))


def time_range_phrase(windows: DataFrame) -> DataFrame:
    return windows.withColumn("time_range", F.concat(long_date_text("start_date"), F.lit(" to "), long_date_text("end_date")))


def instruction_id(windows: DataFrame) -> DataFrame:
    """``train_discharge_site_{n}_{n+1}_len_{idx // N}`` with idx = t·N + n, so the
    last part is t for any number N of sites."""
    return windows.withColumn("id", F.concat_ws("_", F.lit("train_discharge_site"), F.col("n").cast("string"),
                                                (F.col("n") + 1).cast("string"), F.lit("len"),
                                                F.col("t").cast("string")))


GPT_TEXT = f"Based on the given information, the predicted tokens in this region are {ST_PRE}."


def render_instruction(windows: DataFrame, flow_text: DataFrame, sites: DataFrame, interval: str = "1-day") -> DataFrame:
    """(id, n, t, human, gpt) for each window, the reference's wording."""
    lab = site_labels(sites).select("n", "label")
    w = instruction_id(time_range_phrase(format_values(windows)))
    w = w.join(lab, "n").join(flow_text.select("n", "flow_text"), "n", "left")
    human = F.concat(
        F.lit("Given the historical data for sediment and discharge over 12 time steps in "), F.col("label"),
        F.lit(", the recorded sediment values are ["), F.col("sediment_str"),
        F.lit("], and the recorded discharge values are ["), F.col("discharge_str"), F.lit("]. "),
        F.lit("The recording time of the historical data is '"), F.col("time_range"),
        F.lit(f", with data points recorded at {interval} intervals'. "),
        F.lit("Note: A sediment value of 0.00 indicates missing data. "),
        F.lit("Now we aim to predict the sediment and discharge in this region within the next 12 time steps. "),
        F.coalesce(F.col("flow_text"), F.lit("")),
        F.lit(f" To improve prediction accuracy, a spatio-temporal model is utilized to encode the historical data as tokens {ST_HIS}, "),
        F.lit("where the first token corresponds to sediment and the second token corresponds to discharge. "),
        F.lit("Please conduct an analysis of the patterns in this region, considering the provided time and information, "
              f"and then generate the prediction tokens for classification, in the form {ST_PRE}."))
    return w.select("id", "n", "t", human.alias("human"), F.lit(GPT_TEXT).alias("gpt"))


def nest_conversation(rendered: DataFrame) -> DataFrame:
    """``{id, conversations: [{from: human, value}, {from: gpt, value}]}``."""
    conv = F.array(F.struct(F.lit("human").alias("from"), F.col("human").alias("value")),
                   F.struct(F.lit("gpt").alias("from"), F.col("gpt").alias("value")))
    return rendered.select("id", conv.alias("conversations"))


def assemble_snapshots(windows: DataFrame, in_len: int = 12, out_len: int = 12, site_chunk: int = 4096) -> DataFrame:
    """One snapshot per window start t: data_x/data_y shaped (step, site, feature).

    Sites are grouped in chunks of ``site_chunk`` (one row per (snapshot,
    chunk)), so a snapshot over very many sites never becomes one unbounded
    row; with up to ``site_chunk`` sites (the reference's 20) it is one row."""
    g = windows.groupBy(F.col("t").alias("snapshot"), F.floor(F.col("n") / site_chunk).cast("int").alias("site_chunk")).agg(
        F.sort_array(F.collect_list(F.struct("n", "x_sediment", "x_discharge", "y_sediment", "y_discharge"))).alias("_s"))

    def cube(prefix: str, length: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.transform(
            "_s", lambda s: F.array(F.element_at(s[f"{prefix}_sediment"], i), F.element_at(s[f"{prefix}_discharge"], i))))

    return g.select("snapshot", "site_chunk", F.transform("_s", lambda s: s["n"]).alias("sites"),
                    cube("x", in_len).alias("data_x"), cube("y", out_len).alias("data_y"))


def snapshot_cells(snapshots: DataFrame) -> DataFrame:
    """Long view of snapshots: (snapshot, step, site_n, x_sediment, x_discharge, y_sediment, y_discharge)."""
    s = snapshots.select("snapshot", "sites", F.posexplode("data_x").alias("step", "_x"), "data_y")
    s = s.select("snapshot", "step", F.posexplode("sites").alias("_j", "site_n"), "_x",
                 F.element_at("data_y", F.col("step") + 1).alias("_y"))
    return s.select("snapshot", "step", "site_n",
                    F.element_at(F.element_at("_x", F.col("_j") + 1), 1).alias("x_sediment"),
                    F.element_at(F.element_at("_x", F.col("_j") + 1), 2).alias("x_discharge"),
                    F.element_at(F.element_at("_y", F.col("_j") + 1), 1).alias("y_sediment"),
                    F.element_at(F.element_at("_y", F.col("_j") + 1), 2).alias("y_discharge"))


def parse_instruction_id(instructions: DataFrame, id_col: str = "id") -> DataFrame:
    """``id.split('_')[3], [4], [6]`` → region_start, region_end, snapshot;
    malformed ids give NULLs and ``bad_id = true`` instead of failing the job."""
    rs = F.expr(f"try_cast(try_element_at(split({id_col}, '_'), 4) as int)")
    re_ = F.expr(f"try_cast(try_element_at(split({id_col}, '_'), 5) as int)")
    sn = F.expr(f"try_cast(try_element_at(split({id_col}, '_'), 7) as int)")
    out = instructions.select("*", rs.alias("region_start"), re_.alias("region_end"), sn.alias("snapshot"))
    return out.withColumn("bad_id", F.col("region_start").isNull() | F.col("region_end").isNull() | F.col("snapshot").isNull())


def join_snapshot(parsed: DataFrame, snapshots: DataFrame, site_chunk: int = 4096) -> DataFrame:
    """Attach data_x/data_y by snapshot number (N dialogues : 1 snapshot), of a chunked
    snapshot the chunk that holds the dialogue's first site."""
    p = parsed.withColumn("site_chunk", F.floor(F.col("region_start") / site_chunk).cast("int"))
    return p.join(snapshots, ["snapshot", "site_chunk"], "inner")


def unmatched_snapshots(parsed: DataFrame, snapshots: DataFrame) -> DataFrame:
    return parsed.join(snapshots.select("snapshot"), "snapshot", "left_anti")


def slice_region(parsed: DataFrame, cells: DataFrame, rs: str = "region_start", re_: str = "region_end",
                 site: str = "site_n") -> DataFrame:
    """Half-open node slice ``x[:, :, rs:re, f]`` on the long form: each region lists
    its sites and meets its cells by (snapshot, site)."""
    p = parsed.where(F.col(rs) < F.col(re_)).withColumn(site, F.explode(F.sequence(F.col(rs), F.col(re_) - 1)))
    return p.join(cells, ["snapshot", site])


# ---------------------------------------------------------------- scaling


def _both() -> tuple[Column, Column]:
    """Mean and population std of both features together, from counts, means and variances of each:
    no row is doubled."""
    n = [F.count(c) for c in ("sediment", "discharge")]
    m = [F.coalesce(F.avg(c), F.lit(0.0)) for c in ("sediment", "discharge")]
    v = [F.coalesce(F.var_pop(c), F.lit(0.0)) for c in ("sediment", "discharge")]
    total = n[0] + n[1]
    mean = F.try_divide(n[0] * m[0] + n[1] * m[1], total)
    spread = F.try_divide(n[0] * v[0] + n[1] * v[1], total) + F.try_divide(
        n[0] * n[1] * (m[0] - m[1]) * (m[0] - m[1]), total * total)
    return mean, F.sqrt(spread)


def zscore_stats(dense: DataFrame) -> DataFrame:
    """Per-site mean and population std over time and both features together."""
    mean, std = _both()
    return dense.groupBy("n", "site").agg(mean.alias("mean"), std.alias("std"))


def zscore_by_site(dense: DataFrame) -> DataFrame:
    """Both features of each row less the site's mean, over its std: the small per-site statistics
    meet the rows once, and the two features are written out at the very end."""
    stats = zscore_stats(dense)
    z = lambda c: F.try_divide(F.col(c) - F.col("mean"), F.col("std"))
    rows = dense.join(stats, ["n", "site"])
    return rows.select("n", "site", "t", F.posexplode(F.array(z("sediment"), z("discharge"))).alias("f", "z"), "mean", "std")


def zscore_inverse(scaled: DataFrame, stats: DataFrame) -> DataFrame:
    """``data * std + mean`` per site (the intended per-site broadcasting)."""
    return (scaled.select("n", "t", "f", "z").join(stats.select("n", "mean", "std"), "n")
            .select("n", "t", "f", (F.col("z") * F.col("std") + F.col("mean")).alias("value")))


def batch_assign(df: DataFrame, keys: list[str], seed: int = 42, batch_size: int = 64) -> DataFrame:
    """Deterministic shuffled batches: order by a portable hash of (seed, keys),
    position by a distributed ordinal, batch = floor(pos / size)."""
    from estuary.functions.exprs import portable_hash

    h = df.withColumn("_h", portable_hash(F.lit(seed), *keys))
    o = global_ordinal(h, ["_h", *keys], "pos", bucket=F.shiftright("_h", 44))  # 2^16 hash ranges
    return o.withColumn("batch", F.floor(F.col("pos") / batch_size)).drop("_h")
