"""Queries over regions: joins, windows at SD and state level, analogues, sowing, crop context."""

from __future__ import annotations

import calendar

from pyspark.sql import functions as F

from furrow.operators import aggregates as A
from furrow.operators import joins, sets, topk
from furrow.operators.spatial import ring_centroid, zone_split
from furrow.operators.timeseries import season_features
from furrow.plans import analogue as AN
from furrow.plans import digest as D
from furrow.plans import regions as RG
from furrow.plans import sowing as SW
from furrow.plans import windows as WN
from furrow.session import stored
from furrow.sources.readers import read_census
from furrow.workload import bind as B
from furrow.workload.daily import EVENTS, NAMES, _station_names, events
from furrow.workload.ranks import DECILE, REGION_FEATURES, SCORE, WINDOWS_BY_STATE, _station_map, state_windows
from furrow.workload.registry import query

TY, MM, MD = B.TARGET_YEAR, B.MTD_MONTH, B.MTD_DAY
FIRST, LAST, MIN_YEARS = 1995, 2000, 3
SCALE = MD / calendar.monthrange(TY, MM)[1]
FLOOR = 100.0


def _areas(spark, sf):
    return B.weights_df(spark, sf).select("sa2_code", F.col("weight").alias("area"))


def _members(spark, sf, floor=FLOOR):
    return stored(WN.sd_members(B.concordance_df(spark, sf), _areas(spark, sf), floor), "members")


AREAS = ("areas", "SELECT sa2_code, weight AS area FROM weights")
MEMBERS = (AREAS,
           ("m0", "SELECT c.*, allocation_ratio * area AS weight FROM concordance c JOIN areas USING (sa2_code) WHERE allocation_ratio * area > 0"),
           ("sdsize", f"SELECT sd_code, sum(weight) AS sd_area FROM m0 GROUP BY 1 HAVING sum(weight) >= {FLOOR}"),
           ("sdstate", """SELECT sd_code, state_name AS sd_state FROM (SELECT sd_code, state_name, row_number() OVER (PARTITION BY sd_code ORDER BY sum(weight) DESC, state_name) AS rn
               FROM m0 GROUP BY 1, 2) WHERE rn = 1"""),
           ("members", "SELECT m0.*, sd_area, sd_state FROM m0 JOIN sdsize USING (sd_code) JOIN sdstate USING (sd_code)"))


def totals_sql(wins, keys="sa2_code", src="history", mtd="mtd", complete=True) -> str:
    """Long window totals: (keys, year, window, value)."""
    parts = []
    for w in wins:
        n = w.last - w.first + 1
        if w.partial:
            rows = (f"SELECT {keys}, year, month, CASE WHEN month = {w.last} THEN rainfall_mm * {SCALE!r}::DOUBLE ELSE rainfall_mm END AS v FROM {src} "
                    f"WHERE month BETWEEN {w.first} AND {w.last} AND NOT (year = {TY} AND month = {w.last}) "
                    f"UNION ALL SELECT {keys}, year, {w.last}, rainfall_mm FROM {mtd} WHERE year = {TY}")
        else:
            rows = f"SELECT {keys}, year, month, rainfall_mm AS v FROM {src} WHERE month BETWEEN {w.first} AND {w.last}"
        gate = f"HAVING count(v) = {n}" if complete else "HAVING count(v) > 0"
        parts.append(f"SELECT {keys}, year, '{w.label}' AS \"window\", sum(v) AS value FROM ({rows}) GROUP BY ALL {gate}")
    return " UNION ALL ".join(parts)


def rank_sql(series, keys, target=TY, first=FIRST, last=LAST, min_years=MIN_YEARS, floor=None) -> str:
    k = ", ".join(f"t.{c}" for c in keys)
    on = " AND ".join(f"t.{c} = h.{c}" for c in keys)
    med = "median(h.value)"
    den = f"greatest({med}, {floor}::DOUBLE)" if floor else f"nullif({med}, 0)"
    return f"""SELECT {k}, t.value, count(h.value) AS n_hist_years, {med} AS hist_median, avg(h.value) AS hist_mean, quantile_cont(h.value, 0.1) AS hist_p10,
      quantile_cont(h.value, 0.9) AS hist_p90, t.value / {den} * 100 AS pct_of_median, t.value - {med} AS anomaly, count(*) FILTER (h.value < t.value) AS below,
      count(*) FILTER (h.value < t.value) / count(h.value)::DOUBLE * 100 AS percentile_rank, {DECILE.format(b='count(*) FILTER (h.value < t.value)', n='count(h.value)')} AS decile,
      {SCORE.format(b='count(*) FILTER (h.value < t.value)', n='count(h.value)')} AS decile_decimal
    FROM (SELECT * FROM {series} WHERE year = {target}) t JOIN (SELECT * FROM {series} WHERE year BETWEEN {first} AND {last} AND year <> {target}) h ON {on}
    GROUP BY {k}, t.value HAVING count(h.value) >= {min_years}"""


def weighted_sql(totals, level) -> str:
    lv = ", ".join(level)
    return f"""SELECT {lv}, "window", year, sum(value * weight) / nullif(sum(weight), 0) AS value FROM {totals} JOIN (SELECT DISTINCT sa2_code, {lv}, weight FROM members) USING (sa2_code)
      WHERE weight > 0 GROUP BY ALL"""


RANK_ROUND = ("value", "hist_median", "hist_mean", "hist_p10", "hist_p90", "pct_of_median", "anomaly", "percentile_rank")
HM = ("history", "mtd")


def _inputs(spark, sf):
    """History, and the month-to-date arguments that go with it."""
    history, mtd = B.history_and_mtd(spark, sf)
    return history, {"mtd": mtd, "mtd_month": MM, "through_day": MD}


# --- windows -----------------------------------------------------------------------------

DRILL = (WN.Window("jan_apr", 1, 4), WN.Window("jan_may", 1, 5, True))
CUMULATIVE = (WN.Window("mar_may", 3, 5, True), WN.Window("may", 5, 5, True))


@query("e14_window_ranks", rank_sql("tot", ("sa2_code", '"window"'), floor=0.1), HM, RANK_ROUND, (("tot", totals_sql(DRILL)),))
def _(spark, sf):
    history, mtd = _inputs(spark, sf)
    return WN.region_ranks(history, DRILL, TY, FIRST, LAST, min_years=MIN_YEARS, **mtd)


def _level(name, level):
    @query(f"e15_cumulative_window_{name}", rank_sql("ser", (*level, '"window"')), (*HM, "concordance", "weights"), RANK_ROUND,
           MEMBERS + (("tot", totals_sql(CUMULATIVE)), ("ser", weighted_sql("tot", level))))
    def _(spark, sf):
        history, mtd = _inputs(spark, sf)
        return WN.level_ranks(history, _members(spark, sf), CUMULATIVE, TY, FIRST, LAST, list(level), MIN_YEARS, **mtd)


_level("sd", ("sd_code",))
_level("state", ("sd_state",))


@query("e15_cumulative_window_region", rank_sql("tot", ("sa2_code", '"window"')), HM, RANK_ROUND, (("tot", totals_sql(CUMULATIVE)),))
def _(spark, sf):
    history, mtd = _inputs(spark, sf)
    return WN.region_ranks(history, CUMULATIVE, TY, FIRST, LAST, min_years=MIN_YEARS, median_floor=None, **mtd)


YTD = (WN.Window("ytd", 1, MM, True),)


@query("e16_ytd_accumulation", rank_sql("ser", ("sd_state", '"window"')), (*HM, "concordance", "weights"), RANK_ROUND,
       MEMBERS + (("tot", totals_sql(YTD)), ("ser", weighted_sql("tot", ("sd_state",)))))
def _(spark, sf):
    history, mtd = _inputs(spark, sf)
    return WN.level_ranks(history, _members(spark, sf), YTD, TY, FIRST, LAST, ["sd_state"], MIN_YEARS, **mtd)


YOY = (WN.Window("mar_apr", 3, 4), WN.Window("mar_may", 3, 5, True))


@query("e17_year_over_year", f"""
    SELECT sd_code, "window", a.value AS value_before, a.pct_of_median AS pct_of_median_before, a.decile_decimal AS decile_decimal_before,
           b.value AS value_now, b.pct_of_median AS pct_of_median_now, b.decile_decimal AS decile_decimal_now
    FROM ({rank_sql('ser', ('sd_code', '"window"'), target=2000, last=1999)}) a FULL JOIN ({rank_sql('ser', ('sd_code', '"window"'), target=2001, last=1999)}) b USING (sd_code, "window")""",
       (*HM, "concordance", "weights"), ("value_before", "pct_of_median_before", "value_now", "pct_of_median_now"), MEMBERS + (("tot", totals_sql(YOY)), ("ser", weighted_sql("tot", ("sd_code",)))))
def _(spark, sf):
    history, mtd = _inputs(spark, sf)
    return WN.year_over_year(history, _members(spark, sf), YOY, (2000, 2001), FIRST, ["sd_code"], MIN_YEARS, **mtd)


_MONTH = (WN.Window("month", MM, MM, True),)
SD_REVIEW = MEMBERS + (("tot", totals_sql(_MONTH)), ("ser", weighted_sql("tot", ("sd_code",))), ("sdr", f"""
    SELECT r.*, sd_name, state, sd_area FROM ({rank_sql('ser', ('sd_code', '"window"'), min_years=1)}) r
    JOIN (SELECT sd_code, min(sd_name) AS sd_name, min(sd_state) AS state, min(sd_area) AS sd_area FROM members GROUP BY 1) USING (sd_code)"""))


def _review_inputs(spark, sf):
    return (*B.history_and_mtd(spark, sf), _members(spark, sf))


def _sd_rows(spark, sf, inputs=None):
    history, mtd, members = inputs or _review_inputs(spark, sf)
    return WN.sd_review(history, mtd, members, TY, MM, MD, FIRST)


def _state_rows(inputs, sd_rows):
    history, mtd, members = inputs
    return WN.state_review(sd_rows, history, mtd, members, TY, MM, MD, FIRST)


@query("d24_sd_review", 'SELECT * EXCLUDE ("window") FROM sdr', (*HM, "concordance", "weights"), RANK_ROUND, SD_REVIEW)
def _(spark, sf):
    return _sd_rows(spark, sf)


_STATE_MEMBERS = weighted_sql("tot2", ("sd_state",)).replace("FROM members", "FROM members WHERE sd_code IN (SELECT sd_code FROM sdr)")
STATE_REVIEW = SD_REVIEW + (("tot2", totals_sql((*_MONTH, WN.Window("ytd", 1, MM, True)))), ("ser2", _STATE_MEMBERS),
                            ("sr", rank_sql("ser2", ("sd_state", '"window"'), min_years=1)), ("strev", """
    SELECT a.*, rain_mm / nullif(hist_scaled_median_mm, 0) * 100 AS pct_of_median, m.percentile_rank, m.decile, m.decile_decimal, y.value AS ytd_mm, y.hist_median AS ytd_median_mm,
           y.pct_of_median AS ytd_pct_of_median, y.percentile_rank AS ytd_percentile_rank, y.decile_decimal AS ytd_decile_decimal
    FROM (SELECT state, sum(sd_area) AS area, sum(value * sd_area) / sum(sd_area) AS rain_mm, sum(hist_median * sd_area) / sum(sd_area) AS hist_scaled_median_mm, count(*) AS n_sds FROM sdr GROUP BY 1) a
    LEFT JOIN (SELECT * FROM sr WHERE "window" = 'month') m ON a.state = m.sd_state LEFT JOIN (SELECT * FROM sr WHERE "window" = 'ytd') y ON a.state = y.sd_state"""))
_STATE_ROUND = ("rain_mm", "hist_scaled_median_mm", "pct_of_median", "percentile_rank", "ytd_mm", "ytd_median_mm", "ytd_pct_of_median", "ytd_percentile_rank")


@query("d24_state_review", "SELECT * FROM strev", (*HM, "concordance", "weights"), _STATE_ROUND, STATE_REVIEW)
def _(spark, sf):
    inputs = _review_inputs(spark, sf)
    return _state_rows(inputs, stored(_sd_rows(spark, sf, inputs), "sd-review"))


SA2_REVIEW = (AREAS, ("tot", totals_sql(_MONTH)), ("sa2r", f"""
    SELECT r.*, area, sd_code, sd_name FROM ({rank_sql('tot', ('sa2_code', '"window"'), min_years=1)}) r JOIN (SELECT * FROM areas WHERE area > 0) USING (sa2_code)
    JOIN (SELECT sa2_code, sd_code, sd_name FROM concordance WHERE allocation_ratio = 0.75) USING (sa2_code)"""))


def _sa2_rows(spark, sf, inputs=None):
    history, mtd = inputs[:2] if inputs else B.history_and_mtd(spark, sf)
    return WN.sa2_review(history, mtd, _areas(spark, sf), B.concordance_df(spark, sf), TY, MM, MD, FIRST)


@query("d25_sa2_review", 'SELECT * EXCLUDE ("window") FROM sa2r', (*HM, "concordance", "weights"), RANK_ROUND, SA2_REVIEW)
def _(spark, sf):
    return _sa2_rows(spark, sf)


@query("i19_monthly_review", """
    SELECT 'sd' AS level, sd_code AS code, state, value AS rain_mm, pct_of_median, decile, decile_decimal FROM sdr
    UNION ALL SELECT 'state', state, state, rain_mm, pct_of_median, decile, decile_decimal FROM strev
    UNION ALL SELECT 'sa2', sa2_code, NULL, value, pct_of_median, decile, decile_decimal FROM sa2r""", (*HM, "concordance", "weights"), ("rain_mm", "pct_of_median"),
       STATE_REVIEW + (SA2_REVIEW[2],))
def _(spark, sf):
    inputs = _review_inputs(spark, sf)
    sd = stored(_sd_rows(spark, sf, inputs), "sd-review")
    state = _state_rows(inputs, sd)
    cols = ["pct_of_median", "decile", "decile_decimal"]
    return sets.union_sparse(
        sd.select(F.lit("sd").alias("level"), F.col("sd_code").alias("code"), "state", F.col("value").alias("rain_mm"), *cols),
        state.select(F.lit("state").alias("level"), F.col("state").alias("code"), "state", "rain_mm", *cols),
        _sa2_rows(spark, sf, inputs).select(F.lit("sa2").alias("level"), F.col("sa2_code").alias("code"), F.col("value").alias("rain_mm"), *cols))


BREAKDOWN = (WN.Window("std", 1, 4), WN.Window("mon", 4, 4))


_BD = ("SELECT sd_code, sd_name, sd_state, sd_area, " + ", ".join(
    f"sum({c} * weight) FILTER (weight > 0) / nullif(sum(weight) FILTER (weight > 0 AND {c} IS NOT NULL), 0) AS {c}" for c in ("season", "season_median", "mon", "mon_median", "mtd", "full_median"))
    + """ FROM (SELECT m.*, own.season, own.season_median, own.mon, own.mon_median, g.rainfall_mm AS mtd, f.full_median FROM members m LEFT JOIN own USING (sa2_code)
        LEFT JOIN (SELECT sa2_code, median(rainfall_mm) AS full_median FROM history WHERE month = 5 AND year BETWEEN 1995 AND 2000 GROUP BY 1) f USING (sa2_code) LEFT JOIN mtd g USING (sa2_code)) z
      GROUP BY 1, 2, 3, 4""")
BREAKDOWN_SQL = MEMBERS + (
    ("tot", totals_sql(BREAKDOWN)), ("rk", rank_sql("tot", ("sa2_code", '"window"'), min_years=1)),
    ("own", """SELECT a.sa2_code, a.value AS season, a.hist_median AS season_median, b.value AS mon, b.hist_median AS mon_median FROM (SELECT * FROM rk WHERE "window" = 'std') a
               JOIN (SELECT * FROM rk WHERE "window" = 'mon') b USING (sa2_code)"""),
    ("ser", weighted_sql("tot", ("sd_code",))), ("lv", rank_sql("ser", ("sd_code", '"window"'), min_years=1)), ("bd", _BD))


@query("d26_sd_breakdown", """
    SELECT bd.*, d1.decile AS season_decile, d2.decile AS mon_decile, season / nullif(season_median, 0) * 100 AS season_pct, mon / nullif(mon_median, 0) * 100 AS mon_pct,
           full_median - mtd AS gap_to_median, mtd / nullif(full_median, 0) * 100 AS pct_of_full_median
    FROM bd LEFT JOIN (SELECT * FROM lv WHERE "window" = 'std') d1 USING (sd_code) LEFT JOIN (SELECT * FROM lv WHERE "window" = 'mon') d2 USING (sd_code)
    WHERE season IS NOT NULL AND mon IS NOT NULL""", (*HM, "concordance", "weights"),
       ("season", "season_median", "mon", "mon_median", "mtd", "full_median", "season_pct", "mon_pct", "gap_to_median", "pct_of_full_median"), BREAKDOWN_SQL)
def _(spark, sf):
    history, mtd = B.history_and_mtd(spark, sf)
    out = WN.sd_breakdown(history, _members(spark, sf), mtd, *BREAKDOWN, TY, FIRST, MM)
    for c in ("std", "std_median", "std_decile", "std_pct"):
        out = out.withColumnRenamed(c, c.replace("std", "season"))
    return out


def _monthly_state(src):
    return (f"SELECT state_name, year, month, sum(rainfall_mm * weight) / sum(weight) AS rainfall_mm FROM {src} JOIN (SELECT sa2_code, state_name, weight FROM weights) USING (sa2_code, state_name) "
            "WHERE weight > 0 AND rainfall_mm IS NOT NULL GROUP BY 1, 2, 3")


_TRAJ = tuple([WN.Window(calendar.month_abbr[m], m, m) for m in range(1, MM)] + [WN.Window("ytd", 1, MM - 1), WN.Window("mtd", MM, MM, True), WN.Window("ytd_mtd", 1, MM, True)])


@query("d28_moisture_trajectory", rank_sql("tot", ("state_name", '"window"'), min_years=1), (*HM, "weights"), RANK_ROUND,
       (("mh", _monthly_state("history")), ("mm", _monthly_state("mtd")), ("tot", totals_sql(_TRAJ, "state_name", "mh", "mm"))))
def _(spark, sf):
    history, mtd = B.history_and_mtd(spark, sf)
    return WN.moisture_trajectory(history, mtd, B.weights_df(spark, sf), TY, MM, MD, FIRST)


_SEED = (WN.Window("prev", MM - 1, MM - 1), WN.Window("mtd", MM, MM, True), WN.Window("both", MM - 1, MM, True))
_SKEYS = "sa2_code, sa2_name, sa3_name, sa4_name"
_SC = ("value", "hist_median", "percentile_rank", "pct_of_median", "decile")
SEEDING_SQL = (("tot", totals_sql(_SEED, _SKEYS)), ("rk", rank_sql("tot", (*_SKEYS.split(", "), '"window"'), min_years=1, floor=0.1)), ("wide", f"SELECT {_SKEYS}, " + ", ".join(
    f"max({c}) FILTER (\"window\" = '{w}') AS {w}_{c}" for w in ("prev", "mtd", "both") for c in _SC) + f" FROM rk GROUP BY {_SKEYS}"), ("seed", """
    SELECT *, CASE WHEN mtd_value >= 25 THEN 'Adequate' WHEN mtd_value >= 15 THEN 'Marginal' WHEN mtd_value >= 10 THEN 'Marginal-low' WHEN mtd_value < 10 THEN 'Insufficient' END AS seeding_class,
           CASE WHEN both_value >= 70 THEN 'Strong' WHEN both_value >= 40 THEN 'Adequate' WHEN both_value >= 20 THEN 'Below average' WHEN both_value < 20 THEN 'Poor' END AS season_class
    FROM wide WHERE both_value IS NOT NULL"""))
_SEED_ROUND = tuple(f"{w}_{c}" for w in ("prev", "mtd", "both") for c in _SC if c != "decile")


def _seeding(spark, sf):
    history, mtd = B.history_and_mtd(spark, sf)
    return WN.seeding_conditions(history, mtd, TY, MM, MD, FIRST)


@query("i17_seeding_conditions", "SELECT * FROM seed", HM, _SEED_ROUND, SEEDING_SQL)
def _(spark, sf):
    return _seeding(spark, sf)


@query("d30_sa4_rollup", """
    SELECT sa4_name, count(*) AS n_sa2, median(prev_value) AS prev_value_median, median(mtd_value) AS mtd_value_median, median(both_value) AS both_value_median,
           median(both_percentile_rank) AS both_percentile_rank_median, count(*) FILTER (seeding_class = 'Adequate') AS n_adequate, count(*) FILTER (seeding_class = 'Marginal') AS n_marginal,
           count(*) FILTER (seeding_class = 'Insufficient') AS n_insufficient, count(*) FILTER (season_class = 'Strong') AS n_strong_season,
           count(*) FILTER (season_class = 'Below average') AS n_below_avg, count(*) FILTER (season_class = 'Poor') AS n_poor FROM seed GROUP BY 1""", HM,
       ("prev_value_median", "mtd_value_median", "both_value_median", "both_percentile_rank_median"), SEEDING_SQL)
def _(spark, sf):
    return WN.class_rollup(_seeding(spark, sf))


DRILL_SQL = (("tot", totals_sql(DRILL[1:], "sa2_code, sa2_name, sa3_name, state_name")),
             ("drill", rank_sql("tot", ("sa2_code", "sa2_name", "sa3_name", "state_name", '"window"'), floor=0.1)),
             ("dw", "SELECT drill.*, weight FROM drill JOIN (SELECT sa2_code, state_name, weight FROM weights) USING (sa2_code, state_name) WHERE weight > 0"))


def _drill(spark, sf):
    history, mtd = _inputs(spark, sf)
    return WN.region_ranks(history, DRILL[1:], TY, FIRST, LAST, ("sa2_code", "sa2_name", "sa3_name", "state_name"), MIN_YEARS, **mtd)


def _share(cond):
    return f"coalesce(sum(weight) FILTER ({cond}), 0) / sum(weight) * 100"


_WM = "sum({c} * weight) FILTER ({c} IS NOT NULL) / nullif(sum(weight) FILTER ({c} IS NOT NULL), 0)"


@query("d29_band_area_share", f"""
    SELECT state_name, sum(weight) AS total_area_ha, count(*) AS n_sa2, avg(percentile_rank) AS unweighted_pct_rank, {_WM.format(c='percentile_rank')} AS area_weighted_pct_rank,
           avg(pct_of_median) AS unweighted_pct_of_median, {_WM.format(c='pct_of_median')} AS area_weighted_pct_of_median, {_share('decile <= 3')} AS dry_share_pct,
           {_share('decile BETWEEN 4 AND 7')} AS mid_share_pct, {_share('decile >= 8')} AS wet_share_pct, sum(weight) FILTER (rn <= 10) / sum(weight) * 100 AS top10_share_pct
    FROM (SELECT *, row_number() OVER (PARTITION BY state_name ORDER BY weight DESC, sa2_code) AS rn FROM dw) GROUP BY 1""", (*HM, "weights"),
       ("unweighted_pct_rank", "area_weighted_pct_rank", "unweighted_pct_of_median", "area_weighted_pct_of_median", "dry_share_pct", "mid_share_pct", "wet_share_pct", "top10_share_pct"), DRILL_SQL)
def _(spark, sf):
    return WN.band_area_share(_drill(spark, sf), B.weights_df(spark, sf))


@query("d30_sa3_rollup", f"""
    SELECT state_name, sa3_name, count(*) AS n_sa2, sum(weight) AS area_ha, {_WM.format(c='percentile_rank')} AS area_weighted_pct_rank, {_WM.format(c='pct_of_median')} AS area_weighted_pct_of_median,
           sum(weight) / (SELECT sum(weight) FROM dw d2 WHERE d2.state_name = dw.state_name) * 100 AS state_area_share_pct FROM dw GROUP BY 1, 2""", (*HM, "weights"),
       ("area_weighted_pct_rank", "area_weighted_pct_of_median", "state_area_share_pct"), DRILL_SQL)
def _(spark, sf):
    return WN.area_rollup(_drill(spark, sf), B.weights_df(spark, sf))


@query("i18_state_drill", """
    SELECT d.*, mid_lat, zone FROM drill d JOIN (SELECT region AS sa2_code, (min(least(y1, y2)) + max(greatest(y1, y2))) / 2 AS mid_lat,
      CASE WHEN (min(least(y1, y2)) + max(greatest(y1, y2))) / 2 > -33 THEN 'north' ELSE 'south' END AS zone FROM edges GROUP BY 1) USING (sa2_code)""", (*HM, "edges"),
       (*RANK_ROUND, "mid_lat"), DRILL_SQL[:2])
def _(spark, sf):
    zones = zone_split(B.edges_df(spark, sf), -33.0).withColumnRenamed("region", "sa2_code")
    return _drill(spark, sf).join(zones, "sa2_code")


@query("b22_dual_window_concern", """
    SELECT sd_code, a.decile_decimal AS early_score, b.decile_decimal AS late_score,
           CASE WHEN a.decile_decimal < 4 AND b.decile_decimal < 4 THEN 'persistent_dry' WHEN a.decile_decimal < 4 AND b.decile_decimal >= 7 THEN 'recovered'
                WHEN a.decile_decimal >= 7 AND b.decile_decimal < 4 THEN 'fading' WHEN a.decile_decimal >= 7 AND b.decile_decimal >= 7 THEN 'solid' ELSE 'mixed' END AS outlook
    FROM (SELECT * FROM rk WHERE "window" = 'mar_may') a JOIN (SELECT * FROM rk WHERE "window" = 'may') b USING (sd_code)""", (*HM, "concordance", "weights"), (),
       MEMBERS + (("tot", totals_sql(CUMULATIVE)), ("ser", weighted_sql("tot", ("sd_code",))), ("rk", rank_sql("ser", ("sd_code", '"window"')))))
def _(spark, sf):
    history, mtd = _inputs(spark, sf)
    r = WN.level_ranks(history, _members(spark, sf), CUMULATIVE, TY, FIRST, LAST, ["sd_code"], MIN_YEARS, **mtd)
    return WN.dual_window(r, ["sd_code"], "mar_may", "may")


@query("b30_east_west_split", f"""
    SELECT sd_code, half, {_WM.replace('weight', 'area').format(c='decile_decimal')} AS area_weighted_score, count(*) AS n_sa2, min(lon) AS lon_min, max(lon) AS lon_max
    FROM (SELECT *, CASE WHEN lon <= median(lon) OVER (PARTITION BY sd_code) THEN 'west' ELSE 'east' END AS half FROM (
      SELECT r.*, area, lon, sd_code FROM ({rank_sql('tot', ('sa2_code', '"window"'))}) r JOIN areas USING (sa2_code)
      JOIN (SELECT region AS sa2_code, avg(x1) AS lon FROM edges WHERE ring = 0 GROUP BY 1) USING (sa2_code)
      JOIN (SELECT sa2_code, sd_code FROM concordance WHERE allocation_ratio = 0.75) USING (sa2_code) WHERE "window" = 'may'))  GROUP BY 1, 2""",
       (*HM, "edges", "concordance", "weights"), ("area_weighted_score", "lon_min", "lon_max"), (AREAS, ("tot", totals_sql(CUMULATIVE))))
def _(spark, sf):
    history, mtd = _inputs(spark, sf)
    r = WN.region_ranks(history, CUMULATIVE, TY, FIRST, LAST, min_years=MIN_YEARS, median_floor=None, **mtd)
    main = B.concordance_df(spark, sf).where("allocation_ratio = 0.75").select("sa2_code", "sd_code")
    lon = ring_centroid(B.edges_df(spark, sf)).select(F.col("region").alias("sa2_code"), "lon")
    return WN.east_west(r.join(main, "sa2_code"), lon, _areas(spark, sf), "sd_code", "may")


@query("d44_ratio_totals", """
    SELECT CASE WHEN grouping(state) = 1 THEN 'AUSTRALIA' ELSE state END AS state, CASE WHEN grouping(sa3_name) = 1 THEN 'ALL' ELSE sa3_name END AS sa3_name, sum(production_t) AS production_t,
           sum(production_t / area_ha_for_weighting * area_ha_for_weighting) / sum(area_ha_for_weighting) FILTER (production_t IS NOT NULL) AS yield_t_ha, min(area_ha) AS min_area_ha, max(area_ha) AS max_area_ha
    FROM crop_context WHERE area_ha_for_weighting > 0 GROUP BY ROLLUP (state, sa3_name)""", ("crop_context",), ("yield_t_ha",))
def _(spark, sf):
    rows = B.crop_context_df(spark, sf).where("area_ha_for_weighting > 0").withColumn("_yield", F.col("production_t") / F.col("area_ha_for_weighting"))
    return WN.level_totals(rows, ["state", "sa3_name"], ["AUSTRALIA", "ALL"], ["production_t"], {"yield_t_ha": ("_yield", "area_ha_for_weighting")}, ["area_ha"], ["area_ha"])


@query("d44_with_total", """
    SELECT coalesce(state, 'AUSTRALIA') AS state, sum(production_t) AS production_t, sum(area_ha) AS area_ha FROM crop_context GROUP BY ROLLUP (state)""", ("crop_context",))
def _(spark, sf):
    return WN.with_total(B.crop_context_df(spark, sf), "state", "AUSTRALIA", ["production_t", "area_ha"])


# --- picks -------------------------------------------------------------------------------

@query("f3_driest_wettest_sd", """
    SELECT state, arg_min(sd_code, decile * 1000000 + pct_of_median) AS driest, arg_max(sd_code, decile * 1000000 + pct_of_median) AS wettest FROM sdr GROUP BY 1""",
       (*HM, "concordance", "weights"), (), SD_REVIEW)
def _(spark, sf):
    return topk.extremes(_sd_rows(spark, sf), ["state"], ["decile", "pct_of_median"], "sd_code")


@query("f4_extremes_of_largest", """
    SELECT sd_code, arg_min(sa2_code, pct_of_median * 1000 + CAST(right(sa2_code, 3) AS INT) / 1000000::DOUBLE) AS driest, min(pct_of_median) AS driest_value,
           CASE WHEN count(*) >= 2 THEN arg_max(sa2_code, pct_of_median * 1000 + CAST(right(sa2_code, 3) AS INT) / 1000000::DOUBLE) END AS wettest, CASE WHEN count(*) >= 2 THEN max(pct_of_median) END AS wettest_value
    FROM (SELECT *, row_number() OVER (PARTITION BY sd_code ORDER BY area DESC, sa2_code) AS rn FROM sa2r) WHERE rn <= 8 GROUP BY 1""", (*HM, "concordance", "weights"),
       ("driest_value", "wettest_value"), SA2_REVIEW)
def _(spark, sf):
    return topk.extremes_of_largest(_sa2_rows(spark, sf), ["sd_code"], "area", "pct_of_median", "sa2_code")


@query("f5_top10_cumulative_share", """
    SELECT state, sa2_code, crop, area, CAST(rank AS INT) AS rank, share_pct, sum(share_pct) OVER (PARTITION BY state ORDER BY rank) AS cumulative_share_pct
    FROM (SELECT state, sa2_code, crop, area_ha_for_weighting AS area, row_number() OVER (PARTITION BY state ORDER BY area_ha_for_weighting DESC NULLS LAST, sa2_code || crop) AS rank,
                 area_ha_for_weighting / nullif(sum(area_ha_for_weighting) OVER (PARTITION BY state), 0) * 100 AS share_pct FROM crop_context) WHERE rank <= 10""",
       ("crop_context",), ("share_pct", "cumulative_share_pct"))
def _(spark, sf):
    c = B.crop_context_df(spark, sf).select("state", "sa2_code", "crop", F.col("area_ha_for_weighting").alias("area"), F.concat("sa2_code", "crop").alias("tie"))
    return topk.with_cumulative_share(c, ["state"], "area", "tie").drop("tie")


CONTEXT = ("ctx", "SELECT *, area_ha / nullif(sum(area_ha) OVER (PARTITION BY station_sa2_5dig16), 0) AS area_share FROM crop_context")


@query("f6_top_crops_per_region", """
    SELECT station_sa2_5dig16, crop, area_share, CAST(rank AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY station_sa2_5dig16 ORDER BY area_share DESC NULLS LAST, crop) AS rank FROM ctx) WHERE rank <= 3""", ("crop_context",), ("area_share",), (CONTEXT,))
def _(spark, sf):
    return D.top_crops(D.with_area_share(B.crop_context_df(spark, sf)), 3).select("station_sa2_5dig16", "crop", "area_share", "rank")


@query("f7_good_middle_bad", """
    SELECT sa2_code, decile_decimal, outlook FROM (
      SELECT sa2_code, decile_decimal, CASE WHEN decile_decimal >= 7 THEN 'good' WHEN decile_decimal >= 4 THEN 'average' ELSE 'bad' END AS outlook,
             row_number() OVER (PARTITION BY CASE WHEN decile_decimal >= 7 THEN 'good' WHEN decile_decimal >= 4 THEN 'average' ELSE 'bad' END
               ORDER BY CASE WHEN decile_decimal >= 7 THEN -decile_decimal WHEN decile_decimal >= 4 THEN abs(decile_decimal - 5) ELSE decile_decimal END, sa2_code) AS rn
      FROM sa2r WHERE area >= 100) WHERE rn <= 8""", (*HM, "concordance", "weights"), (), SA2_REVIEW)
def _(spark, sf):
    return topk.good_middle_bad(_sa2_rows(spark, sf).where("area >= 100"), "decile_decimal", "sa2_code").select("sa2_code", "decile_decimal", "outlook")


# --- joins -------------------------------------------------------------------------------

@query("c1_station_region_join", "SELECT station_id, date, rainfall, sa2_name, state_name FROM obs LEFT JOIN stations USING (station_id)", ("obs", "stations"))
def _(spark, sf):
    st = B.stations_df(spark, sf)
    names = st.unionByName(st).select("station_id", "sa2_name")
    dim = joins.region_names(st.withColumn("sa2_name", F.lit("fallback")), names)
    o = joins.dimension_join(B.obs_df(spark, sf), dim.select("station_id", "sa2_name", "state_name"), "station_id")
    return o.select("station_id", "date", "rainfall", "sa2_name", "state_name")


@query("c5_measure_times_weight", "SELECT sa2_code, state_name, year, month, rainfall_mm * weight AS volume FROM region_month JOIN weights USING (sa2_code, state_name)", ("region_month", "weights"), ("volume",))
def _(spark, sf):
    j = joins.weighted_measure(B.region_month_df(spark, sf), B.weights_df(spark, sf), ["sa2_code", "state_name"], "rainfall_mm", "weight", "volume")
    return j.select("sa2_code", "state_name", "year", "month", "volume")


@query("c7_split_allocation_bridge", """
    SELECT r.sa2_code, year, month, sd_code, allocation_ratio * coalesce(area, 0) AS weight FROM region_month r JOIN concordance c USING (sa2_code) LEFT JOIN areas USING (sa2_code)""",
       ("region_month", "concordance", "weights"), ("weight",), (AREAS,))
def _(spark, sf):
    facts = B.region_month_df(spark, sf).select("sa2_code", "year", "month")
    return joins.bridge(facts, B.concordance_df(spark, sf).select("sa2_code", "sd_code", "allocation_ratio"), _areas(spark, sf)).drop("allocation_ratio")


@query("c8_dominant_assignment", """
    SELECT sa2_code, sd_code, weight FROM (SELECT sa2_code, sd_code, sum(allocation_ratio) AS weight, row_number() OVER (PARTITION BY sa2_code ORDER BY sum(allocation_ratio) DESC, sd_code) AS rn
      FROM concordance GROUP BY 1, 2) WHERE rn = 1""", ("concordance",))
def _(spark, sf):
    return joins.dominant(B.concordance_df(spark, sf), ["sa2_code"], "sd_code", "allocation_ratio")


@query("c9_semi_and_anti", """
    SELECT station_id, 'in_target' AS side FROM stations WHERE sa2_5 IN (SELECT station_sa2_5dig16 FROM crop_context GROUP BY 1 HAVING coalesce(sum(area_ha), 0) >= 1500)
    UNION ALL SELECT station_id, 'outside' FROM stations WHERE sa2_5 NOT IN (SELECT station_sa2_5dig16 FROM crop_context GROUP BY 1 HAVING coalesce(sum(area_ha), 0) >= 1500)""", ("stations", "crop_context"))
def _(spark, sf):
    targets = A.region_areas(B.crop_context_df(spark, sf), min_area=1500.0).select("sa2_5")
    return sets.membership(B.stations_df(spark, sf), targets, "sa2_5").select("station_id", "side")


@query("c10_strict_inner", """
    SELECT count(*) FILTER (b IS NULL) AS only_left, count(*) FILTER (a IS NULL) AS only_right, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS "both"
    FROM (SELECT sa2_code, 1 AS a FROM history WHERE year = 2001 AND month = 4 AND rainfall_mm IS NOT NULL) FULL JOIN (SELECT sa2_code, 1 AS b FROM mtd WHERE rainfall_mm IS NOT NULL) USING (sa2_code)""", HM)
def _(spark, sf):
    a = B.history_df(spark, sf).where("year = 2001 AND month = 4 AND rainfall_mm IS NOT NULL").select("sa2_code", F.col("rainfall_mm").alias("apr"))
    b = B.mtd_df(spark, sf).where("rainfall_mm IS NOT NULL").select("sa2_code", F.col("rainfall_mm").alias("may"))
    return joins.strict_inner(a, b, ["sa2_code"])[1]


@query("c10_strict_inner_rows", """
    SELECT sa2_code, h.rainfall_mm + m.rainfall_mm AS total FROM history h JOIN mtd m USING (sa2_code) WHERE h.year = 2001 AND h.month = 4 AND h.rainfall_mm IS NOT NULL AND m.rainfall_mm IS NOT NULL""", HM)
def _(spark, sf):
    a = B.history_df(spark, sf).where("year = 2001 AND month = 4 AND rainfall_mm IS NOT NULL").select("sa2_code", F.col("rainfall_mm").alias("apr"))
    b = B.mtd_df(spark, sf).where("rainfall_mm IS NOT NULL").select("sa2_code", F.col("rainfall_mm").alias("may"))
    return joins.strict_inner(a, b, ["sa2_code"])[0].select("sa2_code", (F.col("apr") + F.col("may")).alias("total"))


BREAKS = REGION_FEATURES + (AREAS, ("brk_sd", """
    SELECT sd_code AS sd_region, season_year, autumn_break_status AS status, CASE WHEN autumn_break_status IN ('early', 'on_time', 'late') THEN dayofyear(autumn_break_date) END AS break_doy,
           allocation_ratio * coalesce(area, 0) AS weight FROM rf JOIN concordance USING (sa2_code) LEFT JOIN areas USING (sa2_code)"""), ("sdb", """
    SELECT *, CASE WHEN break_doy < 135 THEN 'early' WHEN break_doy <= 166 THEN 'on_time' ELSE 'late' END AS break_status, coverage >= 0.6 AS coverage_ok FROM (
      SELECT sd_region, season_year, sum(weight * break_doy) FILTER (break_doy IS NOT NULL) / sum(weight) FILTER (break_doy IS NOT NULL) AS break_doy,
             sum(weight) FILTER (break_doy IS NOT NULL) / sum(weight) AS coverage, count(break_doy) AS n_sa2_eligible, count(*) AS n_sa2_total
      FROM brk_sd GROUP BY 1, 2 HAVING sum(weight) > 0 AND sum(weight) FILTER (break_doy IS NOT NULL) > 0)"""),
    ("ranked", """SELECT t.*, count(h.break_doy) AS n_history, count(*) FILTER (h.break_doy < t.break_doy) / nullif(count(h.break_doy), 0)::DOUBLE * 100 AS break_percentile, count(h.break_doy) >= 3 AS history_ok
      FROM sdb t LEFT JOIN sdb h ON t.sd_region = h.sd_region AND h.season_year < t.season_year GROUP BY ALL"""))
_BU = ("obs", "stations", "concordance", "weights")


def _sd_breaks(spark, sf):
    feats = A.aggregate_to_region(season_features(B.obs_df(spark, sf), 0.2), _station_map(spark, sf), 0.2)
    return SW.sd_break_rollup(SW.sd_breaks_from_features(feats, B.concordance_df(spark, sf).select("sa2_code", "sd_code", "allocation_ratio"), _areas(spark, sf)))


@query("d21_sd_break_rollup", "SELECT * FROM sdb", _BU, ("break_doy", "coverage"), BREAKS)
def _(spark, sf):
    return _sd_breaks(spark, sf)


@query("e18_break_percentile", "SELECT sd_region, season_year, break_doy, n_history, break_percentile, history_ok FROM ranked", _BU, ("break_doy", "break_percentile"), BREAKS)
def _(spark, sf):
    return SW.break_percentile(_sd_breaks(spark, sf), 3).select("sd_region", "season_year", "break_doy", "n_history", "break_percentile", "history_ok")


@query("c12_as_of_guide", """
    SELECT sd_code, year, commodity, max(source_year) AS source_year, arg_max(optimal_start_doy, source_year) AS optimal_start_doy
    FROM (SELECT DISTINCT sd_code, year FROM concordance JOIN region_month USING (sa2_code)) f JOIN guides g ON f.sd_code = g.sd_region AND g.source_year <= f.year GROUP BY 1, 2, 3""",
       ("concordance", "region_month", "guides"))
def _(spark, sf):
    facts = B.concordance_df(spark, sf).select("sa2_code", "sd_code").join(B.region_month_df(spark, sf).select("sa2_code", "year").distinct(), "sa2_code").select("sd_code", "year").distinct()
    g = B.guides_df(spark, sf).withColumnRenamed("sd_region", "sd_code").select("sd_code", "commodity", "source_year", "optimal_start_doy")
    return joins.as_of_guide(facts, g, ["sd_code"], "year")


@query("i16_sowing_pressure", """
    SELECT 'SWP-' || season_year || '-' || sd_region || '-' || commodity || '-BRK' AS evidence_id, season_year || '/' || lpad(CAST((season_year + 1) % 100 AS VARCHAR), 2, '0') AS season, season_year, state, sd_region, commodity,
           CASE WHEN d <= optimal_end_doy THEN 'low' WHEN d <= latest_viable_doy THEN 'medium' WHEN d > latest_viable_doy + 7 AND break_percentile >= 90 THEN 'extreme' ELSE 'high' END AS pressure_band,
           make_date(season_year, 1, 1) + CAST(d AS INT) - 1 AS break_date, break_status, break_percentile AS break_percentile_vs_history,
           CAST(greatest(0, optimal_end_doy - greatest(d, optimal_start_doy) + 1) AS INT) AS window_overlap_days, CAST(d - latest_viable_doy AS INT) AS days_after_latest_viable,
           source_document AS guide_source_document, source_year AS guide_source_year, CASE WHEN NOT coverage_ok OR NOT history_ok THEN 'low' ELSE confidence END AS window_confidence
    FROM (SELECT r.*, g.* EXCLUDE (sd_region), CAST(round_even(break_doy, 0) AS INT) AS d, row_number() OVER (PARTITION BY r.sd_region, r.season_year, g.commodity ORDER BY g.source_year DESC) AS rn
          FROM ranked r JOIN guides g ON r.sd_region = g.sd_region AND g.season_type = 'winter' AND g.source_year <= r.season_year) WHERE rn = 1 AND d > optimal_start_doy""",
       (*_BU, "guides"), ("break_percentile_vs_history",), BREAKS)
def _(spark, sf):
    rows = SW.sowing_pressure(_sd_breaks(spark, sf), SW.check_windows(B.guides_df(spark, sf)), 3)
    return rows.drop("pressure_direction", "counterparty_commodity", "reason_code", "establishment_risk_flag")


_PAIRS = ("pairs", """SELECT l.id, r.rid FROM (SELECT c_custkey AS id, 'supplier ' || CAST(c_custkey AS VARCHAR) AS nm FROM customer) l
    JOIN (SELECT s_suppkey AS rid, CASE s_suppkey % 3 WHEN 0 THEN 'Supplier ' || s_suppkey WHEN 1 THEN ' SUPPLIER ' || s_suppkey || ' East' ELSE 'Supplier ' || (s_suppkey // 10) || ' Region' END AS nm FROM supplier) r
    ON trim(lower(r.nm)) = l.nm OR starts_with(trim(lower(r.nm)), l.nm || ' ')""")


@query("c16_unique_name_fallback", """
    SELECT min(id) AS id, rid FROM pairs WHERE id IN (SELECT id FROM pairs GROUP BY 1 HAVING count(*) = 1) GROUP BY rid HAVING count(*) = 1""", (), (), (_PAIRS,))
def _(spark, sf):
    k = F.col("s_suppkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("Supplier "), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit(" SUPPLIER "), k.cast("string"), F.lit(" East"))).otherwise(
        F.concat(F.lit("Supplier "), F.floor(k / 10).cast("string"), F.lit(" Region")))
    right = B.table(spark, sf, "supplier").select(k.alias("rid"), name.alias("rname"))
    left = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Supplier "), F.col("c_custkey").cast("string")).alias("lname"))
    return joins.unique_name_match(left, right, "id", "lname", "rid", "rname")


@query("c17_fallback_area", """
    SELECT sa2_code, crop, area_ha, coalesce(area_ha, CASE WHEN crop = 'building' AND n_nationkey % 3 <> 1 THEN est END) AS area_ha_for_weighting,
           area_ha IS NULL AND crop = 'building' AND n_nationkey % 3 <> 1 AS area_is_fallback,
           CASE WHEN area_ha IS NULL AND crop = 'building' AND n_nationkey % 3 <> 1 THEN '2015-16' WHEN area_ha IS NOT NULL THEN '2020-21' ELSE '' END AS area_source_year,
           CASE WHEN area_ha IS NULL AND crop = 'building' AND n_nationkey % 3 <> 1 THEN 'Uses 2015-16 ABS fallback area (2011 SA2 ''Old ' || n_nationkey || ''', ratio=0.7500); 2020-21 building area not published (np)' ELSE '' END AS area_fallback_reason
    FROM crop_context JOIN (SELECT s_nationkey AS n_nationkey, count(*) * 100::DOUBLE AS est FROM supplier GROUP BY 1) USING (n_nationkey)""", ("crop_context",))
def _(spark, sf):
    cur = B.crop_context_df(spark, sf).select("sa2_code", "crop", "area_ha")
    return joins.fallback_area(cur, *_earlier_areas(spark, sf), "building")


def _earlier_areas(spark, sf):
    """Correspondence with earlier regions, and their estimates."""
    r = B.regions_df(spark, sf)
    # two overlaps each: with the own earlier region, and a smaller one with the next
    n = F.explode(F.array(F.struct(F.col("n_nationkey").alias("old"), F.lit(0.75).alias("ratio")), F.struct(((F.col("n_nationkey") + 1) % 25).alias("old"), F.lit(0.25).alias("ratio"))))
    corr = r.select("sa2_code", "n_nationkey", n.alias("o")).select(
        "sa2_code", F.concat(F.lit("old_"), F.col("o.old").cast("string")).alias("region_2011"), F.concat(F.lit("Old "), F.col("o.old").cast("string")).alias("name_2011"), "o.ratio",
        F.when(F.col("n_nationkey") % 3 == 1, "Poor").otherwise("Good").alias("quality"))
    earlier = B.table(spark, sf, "supplier").groupBy("s_nationkey").agg((F.count(F.lit(1)) * 100.0).alias("estimate")).select(
        F.concat(F.lit("old_"), F.col("s_nationkey").cast("string")).alias("region_2011"), "estimate")
    return corr, earlier


@query("c18_universe_by_crops", """
    SELECT sa2_code, crop, count(area_ha) AS n_known FROM (SELECT sa2_code, unnest(['building', 'machinery', 'millet']) AS crop FROM regions) LEFT JOIN (SELECT sa2_code, crop, area_ha FROM crop_context) USING (sa2_code, crop) GROUP BY 1, 2""",
       ("regions", "crop_context"))
def _(spark, sf):
    facts = B.crop_context_df(spark, sf).select("sa2_code", "crop", "area_ha")
    every = sets.with_every(B.regions_df(spark, sf), facts, ["sa2_code"], "crop", ("building", "machinery", "millet"))
    return every.groupBy("sa2_code", "crop").agg(F.count("area_ha").alias("n_known"))


# --- sets --------------------------------------------------------------------------------

@query("g2_append_current_year", """
    SELECT state_name, sa2_code, year, month, rainfall_mm FROM history UNION ALL SELECT state_name, sa2_code, year, month, rainfall_mm FROM mtd""", HM)
def _(spark, sf):
    cols = ["state_name", "sa2_code", "year", "month", "rainfall_mm"]
    history, mtd = B.history_and_mtd(spark, sf)
    return sets.append_current(history, mtd, cols)


@query("g5_key_differences", """
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'both' END AS side
    FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer) b ON a.k = b.k""")
def _(spark, sf):
    return sets.key_differences(B.table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), B.table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), "k")


@query("g6_override_universe", """
    SELECT sa2_code, 'override' AS source, state_name FROM regions WHERE state_name = 'ASIA' AND n_nationkey <> 7 UNION ALL SELECT sa2_code, 'base', state_name FROM regions WHERE state_name <> 'ASIA'""", ("regions",))
def _(spark, sf):
    r = B.regions_df(spark, sf)
    override = r.where("state_name = 'ASIA' AND n_nationkey <> 7").select("sa2_code", F.lit("override").alias("source"), "state_name")
    return sets.override_universe(r.select("sa2_code", F.lit("base").alias("source"), "state_name"), override, "state_name")


@query("g7_tier_union", """
    SELECT station_id, CASE WHEN cropping_area >= 6000 THEN 'active' ELSE 'unverified' END AS tier FROM stations WHERE cropping_area >= 3000""", ("stations",))
def _(spark, sf):
    floors = {"active": 6000, "unverified": 3000}
    return sets.tiers(B.stations_df(spark, sf), "cropping_area", floors, "inactive", keep=list(floors)).select("station_id", "tier")


# --- crop context, coverage, freshness ---------------------------------------------------

@query("d16_broadacre_area", "SELECT * FROM (SELECT station_sa2_5dig16 AS sa2_5, coalesce(sum(area_ha), 0) AS total_area_ha, min(sa2_name) AS sa2_name, min(state) AS state FROM crop_context GROUP BY 1) WHERE total_area_ha >= 1000", ("crop_context",))
def _(spark, sf):
    return A.region_areas(B.crop_context_df(spark, sf), min_area=1000.0)


# stations of two nations carry the code of a region without crops
COVERAGE = (("elsewhere", "SELECT * REPLACE (CASE WHEN sa2_name IN ('NATION_3', 'NATION_8') THEN '99998' ELSE sa2_5 END AS sa2_5) FROM stations"), ("tg", "SELECT station_sa2_5dig16 AS sa2_5, coalesce(sum(area_ha), 0) AS total_area_ha, min(sa2_name) AS sa2_name, min(state) AS state FROM crop_context GROUP BY 1"), ("cov", """
    SELECT tg.sa2_5 AS sa2_code, sa2_name, state, total_area_ha AS broadacre_area_ha, coalesce(n, 0) AS n_stations, coalesce(ids, '') AS station_ids,
           CASE WHEN n > 0 THEN 'internal_bom' WHEN tg.sa2_5 = '41003' THEN 'data_drill_gapfill' ELSE 'unresolved_gap' END AS gap_status
    FROM tg LEFT JOIN (SELECT sa2_5, count(*) AS n, string_agg(station_id, ';' ORDER BY station_id) AS ids FROM elsewhere GROUP BY 1) USING (sa2_5)"""))


def _coverage(spark, sf):
    code = F.when(F.col("sa2_name").isin("NATION_3", "NATION_8"), "99998").otherwise(F.col("sa2_5"))
    st = B.stations_df(spark, sf).withColumn("sa2_5", code)
    gap = B.regions_df(spark, sf).where("sa2_5 = '41003'").select("sa2_5")
    return A.coverage_report(A.region_areas(B.crop_context_df(spark, sf)), st, gap)


@query("d17_coverage_report", "SELECT * FROM cov", ("crop_context", "stations"), (), COVERAGE)
def _(spark, sf):
    return _coverage(spark, sf)


@query("d38_freshness", """
    SELECT sa2_code, sa2_name, state, n_stations, max_obs_date, CASE WHEN max_obs_date IS NOT NULL THEN CAST(greatest(DATE '2001-11-04' - max_obs_date, 0) AS INT) END AS days_behind_cutoff,
           CASE WHEN max_obs_date IS NULL THEN 'no_data' WHEN max_obs_date >= DATE '2001-11-04' THEN 'current' ELSE 'stale' END AS status
    FROM cov LEFT JOIN (SELECT sa2_5, max(date) AS max_obs_date FROM obs JOIN elsewhere USING (station_id) GROUP BY 1) ON sa2_code = sa2_5""",
       ("crop_context", "stations", "obs"), (), COVERAGE)
def _(spark, sf):
    return A.freshness(_coverage(spark, sf), B.obs_df(spark, sf), "2001-11-04")


@query("d38_freshness_verdict", """
    SELECT count(*) AS n_regions, count(*) FILTER (m >= DATE '2001-11-04') AS n_current, CASE WHEN count(*) > 0 AND count(*) = count(*) FILTER (m >= DATE '2001-11-04') THEN 'PASS' ELSE 'FAIL' END AS verdict
    FROM cov LEFT JOIN (SELECT sa2_5, max(date) AS m FROM obs JOIN elsewhere USING (station_id) GROUP BY 1) ON sa2_code = sa2_5""",
       ("crop_context", "stations", "obs"), (), COVERAGE)
def _(spark, sf):
    return A.freshness_verdict(A.freshness(_coverage(spark, sf), B.obs_df(spark, sf), "2001-11-04"))


@query("d18_area_share", "SELECT station_sa2_5dig16, crop, area_ha, area_share FROM ctx", ("crop_context",), ("area_share",), (CONTEXT,))
def _(spark, sf):
    return D.with_area_share(B.crop_context_df(spark, sf)).select("station_sa2_5dig16", "crop", "area_ha", "area_share")


@query("d19_top_crop_by_state", """
    SELECT state, crop AS top_crop, t AS total_area_ha FROM (SELECT state, crop, sum(area_ha) AS t, row_number() OVER (PARTITION BY state ORDER BY sum(area_ha) DESC, crop) AS rn
      FROM crop_context WHERE area_ha IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""", ("crop_context",))
def _(spark, sf):
    return RG.top_crop_by_state(B.crop_context_df(spark, sf))


def _census(spark, sf):
    """Census rows in long form: one row per region and commodity code."""
    c = B.crop_context_df(spark, sf)
    code = lambda m: F.concat(F.upper("crop"), F.lit(f"_{m}"))
    rows = F.array(F.struct(code("A").alias("commodity_code"), F.col("area_ha").alias("estimate")),
                   F.struct(code("P").alias("commodity_code"), F.col("production_t").alias("estimate")))
    return c.select(F.col("sa2_code").alias("region_code"), F.explode(rows).alias("r")).select(
        "region_code", "r.commodity_code", "r.estimate", F.lit("*").alias("rse"))


CENSUS = ("census", "SELECT sa2_code AS region_code, upper(crop) || '_A' AS commodity_code, area_ha AS estimate FROM crop_context UNION ALL SELECT sa2_code, upper(crop) || '_P', production_t FROM crop_context")


@query("d20_census_coverage_outside", "SELECT DISTINCT region_code FROM census WHERE commodity_code = 'BUILDING_A' AND estimate IS NOT NULL AND region_code NOT IN (SELECT sa2_code FROM regions WHERE state_name <> 'ASIA')",
       ("crop_context",), (), (CENSUS,))
def _(spark, sf):
    uni = B.regions_df(spark, sf).where("state_name <> 'ASIA'").select(F.col("sa2_code").alias("main_code"))
    return RG.census_coverage(_census(spark, sf), uni, "BUILDING_A")[1]


@query("d20_census_coverage_count", "SELECT count(DISTINCT region_code) AS n_regions FROM census WHERE commodity_code = 'BUILDING_A' AND estimate IS NOT NULL AND region_code LIKE '1%'", ("crop_context",), (), (CENSUS,))
def _(spark, sf):
    uni = B.regions_df(spark, sf).select(F.col("sa2_code").alias("main_code"))
    return RG.census_coverage(_census(spark, sf), uni, "BUILDING_A", "1")[0]


@query("a8_read_census", "SELECT region_code, commodity_code, estimate FROM census WHERE region_code IN (SELECT sa2_code FROM regions WHERE state_name = 'ASIA') AND commodity_code IN ('BUILDING_A', 'BUILDING_P')",
       ("crop_context",), (), (CENSUS,))
def _(spark, sf):
    r = B.regions_df(spark, sf).where("state_name = 'ASIA'").select(F.col("sa2_code").alias("region_code"))
    codes = _census(spark, sf).select("commodity_code").where("commodity_code IN ('BUILDING_A', 'BUILDING_P')").distinct()
    return read_census(_census(spark, sf).withColumn("year_id", F.lit(1)), 1, r, codes).drop("rse")


@query("i10_build_crop_context", """
    SELECT CASE WHEN n_nationkey % 5 <> 2 THEN sa2_code WHEN n_nationkey % 10 = 2 THEN sa2_code END AS main_code, sa2_name, crop,
           CASE WHEN n_nationkey % 5 <> 2 THEN 'matched' WHEN n_nationkey % 10 = 2 THEN 'matched_via_label' ELSE 'unmatched' END AS boundary_status,
           CASE WHEN n_nationkey % 5 <> 2 OR n_nationkey % 10 = 2 THEN area_ha END AS area_ha, CASE WHEN n_nationkey % 5 <> 2 OR n_nationkey % 10 = 2 THEN production_t END AS production_t,
           CASE WHEN n_nationkey % 5 <> 2 OR n_nationkey % 10 = 2 THEN area_ha / nullif(sum(area_ha) OVER (PARTITION BY sa2_code), 0) END AS area_share,
           CASE WHEN n_nationkey % 5 <> 2 OR n_nationkey % 10 = 2 THEN coalesce(area_ha, CASE WHEN fb THEN est END) END AS area_ha_for_weighting,
           CASE WHEN fb THEN 'Uses 2015-16 ABS fallback area (2011 SA2 ''Old ' || n_nationkey || ''', ratio=0.7500); 2020-21 building area not published (np)' ELSE '' END AS area_fallback_reason,
           CASE WHEN n_nationkey % 5 = 2 AND n_nationkey % 10 <> 2 THEN 'SA2 not in boundary file; no census lookup' WHEN fb THEN 'area suppressed; yield suppressed; area_ha_for_weighting from fallback'
                WHEN area_ha IS NULL THEN 'area suppressed; yield suppressed' ELSE 'yield suppressed' END AS notes
    FROM (SELECT *, area_ha IS NULL AND crop = 'building' AND n_nationkey % 3 <> 1 AND (n_nationkey % 5 <> 2 OR n_nationkey % 10 = 2) AS fb FROM crop_context)
    LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) * 100::DOUBLE AS est FROM supplier GROUP BY 1) USING (n_nationkey) WHERE crop IN ('building', 'machinery')""", ("crop_context",), ("area_share",))
def _(spark, sf):
    n = F.col("n_nationkey")
    uni = B.regions_df(spark, sf).select(
        "sa2_name", F.substring("sa2_code", 1, 1).alias("state_digit"), F.when(n % 5 != 2, F.col("sa2_code")).alias("main_code"), "state_name")
    labels = B.regions_df(spark, sf).select(F.col("sa2_code").alias("region_code"), F.when((n % 5 == 2) & (n % 10 != 2), "elsewhere").otherwise(F.col("sa2_name")).alias("region_label"))
    crops = [(c, f"{c.upper()}_A", f"{c.upper()}_P", f"{c.upper()}_Y") for c in ("building", "machinery")]
    out = RG.build_crop_context(uni, crops, _census(spark, sf), labels, *_earlier_areas(spark, sf), fallback_crop="building")
    return out.select("main_code", "sa2_name", "crop", "boundary_status", "area_ha", "production_t", "area_share", "area_ha_for_weighting", "area_fallback_reason", "notes")


@query("i22_crop_context_for_events", """
    SELECT station_sa2_5dig16, crop, area_share, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY station_sa2_5dig16 ORDER BY area_share DESC NULLS LAST, crop) AS rank FROM ctx)
    WHERE rank <= 5 AND station_sa2_5dig16 IN (SELECT sa2_5 FROM ev JOIN names USING (station_id))""", ("dense_obs", "regions", "crop_context"), ("area_share",),
       EVENTS + (NAMES, CONTEXT))
def _(spark, sf):
    return D.crop_context_for_events(events(spark, sf), _station_names(spark, sf), D.with_area_share(B.crop_context_df(spark, sf))).select("station_sa2_5dig16", "crop", "area_share", "rank")


@query("d37_station_stats", """
    SELECT count(*) AS total_stations, count(DISTINCT state_name) AS n_states, min(cropping_area) AS area_min, max(cropping_area) AS area_max, avg(cropping_area) AS area_mean, median(cropping_area) AS area_median,
           min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max FROM stations""", ("stations",), ("area_mean", "area_median"))
def _(spark, sf):
    return RG.station_stats(B.stations_df(spark, sf))


@query("d37_stats_by_state", """
    SELECT CASE WHEN grouping(state_name) = 1 THEN 'ALL' ELSE state_name END AS state_name, count(*) AS total_stations, count(DISTINCT state_name) AS n_states, min(cropping_area) AS area_min,
           max(cropping_area) AS area_max, avg(cropping_area) AS area_mean, min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max,
           quantile_cont(cropping_area, 0.25) AS area_p25, quantile_cont(cropping_area, 0.5) AS area_p50, quantile_cont(cropping_area, 0.75) AS area_p75
    FROM stations GROUP BY ROLLUP (state_name)""", ("stations",), ("area_mean", "area_p25", "area_p50", "area_p75"))
def _(spark, sf):
    return RG.station_stats_by_state(B.stations_df(spark, sf))


@query("d37_observed_quantiles", """
    SELECT station_id, CAST(year(date) AS INT) AS year, count(*) AS n, quantile_cont(rainfall, 0.1) AS p10, quantile_cont(rainfall, 0.5) AS p50, quantile_cont(rainfall, 0.9) AS p90
    FROM obs WHERE rainfall IS NOT NULL GROUP BY 1, 2""", ("obs",), ("p10", "p50", "p90"))
def _(spark, sf):
    obs = B.obs_df(spark, sf).withColumn("year", F.year("date"))
    q = A.exact_quantiles(obs, "rainfall", (0.1, 0.5, 0.9), ["station_id", "year"])
    return q.select("station_id", "year", "n", *[F.get("quantiles", F.lit(i)).alias(c) for i, c in enumerate(("p10", "p50", "p90"))])


@query("d37_stations_by_state", "SELECT state_name, count(*) AS n FROM stations GROUP BY 1", ("stations",))
def _(spark, sf):
    return B.stations_df(spark, sf).groupBy("state_name").agg(F.count(F.lit(1)).alias("n"))


@query("d42_landuse_area", """
    SELECT p_type, brand, count(p_retailprice) AS feature_count, sum(CAST(round(p_retailprice * 100) AS BIGINT)) / 100::DOUBLE AS area_ha FROM (SELECT *, CASE WHEN p_size % 7 <> 0 THEN p_brand END AS brand FROM part) GROUP BY 1, 2""",
       (), ("area_ha",))
def _(spark, sf):
    p = B.table(spark, sf, "part").withColumn("brand", F.when(F.col("p_size") % 7 != 0, F.col("p_brand")))
    return A.landuse_area(p, ["p_type", "brand"], "p_retailprice")


@query("d42_landuse_conservation", "SELECT sum(p_retailprice) AS total_ha, sum(p_retailprice) AS grouped_ha, 0::DOUBLE AS difference_ha FROM part", (), ("total_ha", "grouped_ha", "difference_ha"))
def _(spark, sf):
    p = B.table(spark, sf, "part").withColumn("brand", F.when(F.col("p_size") % 7 != 0, F.col("p_brand")))
    return A.landuse_conservation(p, A.landuse_area(p, ["p_type", "brand"], "p_retailprice"), "p_retailprice")


# --- analogues ---------------------------------------------------------------------------

AN_SQL = (("sw", WINDOWS_BY_STATE), ("whole", "SELECT * FROM sw WHERE jan_mar IS NOT NULL AND apr_may IS NOT NULL"),
          ("sd", "SELECT state_name, count(*) AS n, stddev_samp(jan_mar) AS a, stddev_samp(apr_may) AS b FROM whole WHERE year < 2001 GROUP BY 1"), ("an", """
    SELECT state_name, year, distance, jun_oct, CAST(rank AS INT) AS rank FROM (SELECT h.state_name, h.year, h.jun_oct, sqrt(pow((h.jan_mar - t.jan_mar) / CASE WHEN coalesce(a, 0) = 0 THEN 1 ELSE a END, 2) + pow((h.apr_may - t.apr_may) / CASE WHEN coalesce(b, 0) = 0 THEN 1 ELSE b END, 2)) AS distance,
        row_number() OVER (PARTITION BY h.state_name ORDER BY sqrt(pow((h.jan_mar - t.jan_mar) / a, 2) + pow((h.apr_may - t.apr_may) / b, 2)), h.year) AS rank
      FROM whole h JOIN sd USING (state_name) JOIN (SELECT * FROM whole WHERE year = 2001) t ON t.state_name = h.state_name WHERE h.year < 2001 AND n >= 3) WHERE rank <= 3"""),
    ("pw", """SELECT state, crop_season, area, production, CASE WHEN area > 0 THEN production / area END AS y FROM (SELECT state, crop_season, max(value_normalized) FILTER (metric = 'Area') AS area,
        max(value_normalized) FILTER (metric = 'Production') AS production FROM production GROUP BY 1, 2)"""),
    ("base", "SELECT state AS state_name, area AS base_area FROM pw WHERE crop_season = 2000 AND area IS NOT NULL"))
_AU = ("region_month", "weights", "production")


def _analogues(spark, sf):
    return AN.select_analogues(state_windows(spark, sf), TY, ["jan_mar", "apr_may"])


@query("i12_select_analogues", "SELECT state_name, year, distance, rank FROM an", _AU, ("distance",), AN_SQL)
def _(spark, sf):
    return _analogues(spark, sf).select("state_name", "year", "distance", "rank")


@query("f8_nearest_analogues", "SELECT state_name, year, rank FROM an WHERE rank <= 2", _AU, (), AN_SQL)
def _(spark, sf):
    return _analogues(spark, sf).where("rank <= 2").select("state_name", "year", "rank")


@query("i13_implied_production", """
    SELECT an.state_name, string_agg(CAST(year AS VARCHAR), ',' ORDER BY rank) AS analogue_years, avg(y) AS mean_yield, base_area, avg(y) * base_area / 1e6 AS implied_production_mt
    FROM an LEFT JOIN pw ON an.state_name = pw.state AND an.year = pw.crop_season JOIN base USING (state_name) GROUP BY 1, 4""", _AU, ("mean_yield", "implied_production_mt"), AN_SQL)
def _(spark, sf):
    return AN.implied_production(_analogues(spark, sf), B.production_df(spark, sf), 2000)


@query("i14_production_dispersion", """
    SELECT an.state_name, min(jun_oct) AS later_low_mm, max(jun_oct) AS later_high_mm, base_area, arg_min(y, jun_oct) * base_area / 1e6 AS production_low_mt, avg(y) * base_area / 1e6 AS production_mid_mt,
           arg_max(y, jun_oct) * base_area / 1e6 AS production_high_mt
    FROM an LEFT JOIN pw ON an.state_name = pw.state AND an.year = pw.crop_season AND y IS NOT NULL JOIN base USING (state_name) GROUP BY 1, 4""", _AU,
       ("later_low_mm", "later_high_mm", "production_low_mt", "production_mid_mt", "production_high_mt"), AN_SQL)
def _(spark, sf):
    return AN.production_dispersion(_analogues(spark, sf), B.production_df(spark, sf), 2000)


@query("i15_scenario_production", """
    SELECT state_name, long_run_median, above AS mean_above_mt, below AS mean_below_mt, simple AS mean_simple_mt, lo AS low_mt, hi AS high_mt, coalesce(0.3 * above + 0.7 * below, above, below) AS central_mt
    FROM (SELECT an.state_name, long_run_median, avg(p) FILTER (jun_oct >= long_run_median) AS above, avg(p) FILTER (NOT jun_oct >= long_run_median) AS below, avg(p) AS simple, min(p) AS lo, max(p) AS hi
          FROM (SELECT an.*, y * base_area / 1e6 AS p FROM an JOIN pw ON an.state_name = pw.state AND an.year = pw.crop_season AND y IS NOT NULL JOIN base USING (state_name)) an
          JOIN (SELECT state_name, median(jun_oct) AS long_run_median FROM sw WHERE year < 2001 GROUP BY 1) USING (state_name) GROUP BY 1, 2)""", _AU,
       ("long_run_median", "mean_above_mt", "mean_below_mt", "mean_simple_mt", "low_mt", "high_mt", "central_mt"), AN_SQL)
def _(spark, sf):
    return AN.scenario_production(_analogues(spark, sf), state_windows(spark, sf), B.production_df(spark, sf), 2000, TY)


@query("i15_complete_window_by_state", """
    SELECT year, state_name, sum(jun_aug * weight) FILTER (weight > 0) / nullif(sum(weight) FILTER (weight > 0 AND jun_aug IS NOT NULL), 0) AS jun_aug
    FROM (SELECT year, sa2_code, state_name, weight, CASE WHEN count(rainfall_mm) FILTER (month BETWEEN 6 AND 8) = 3 THEN sum(rainfall_mm) FILTER (month BETWEEN 6 AND 8) END AS jun_aug
          FROM region_month JOIN (SELECT sa2_code, state_name, weight FROM weights) USING (sa2_code, state_name) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2""", ("region_month", "weights"), ("jun_aug",))
def _(spark, sf):
    return AN.complete_window_by_state(B.region_month_df(spark, sf), B.weights_df(spark, sf), "jun_aug", 6, 8)
