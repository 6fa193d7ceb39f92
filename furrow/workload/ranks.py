"""Queries over monthly region rainfall: ranks, deciles, climatology and season features."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import scalar as S
from furrow.operators import aggregates as A
from furrow.operators import joins, ranking, sets
from furrow.operators.topk import both_ends
from furrow.operators.timeseries import season_features
from furrow.plans import seasons
from furrow.session import stored
from furrow.sources.readers import read_region_history
from furrow.workload import bind as B
from furrow.workload.daily import _BREAK, _SLICE, _STATUS
from furrow.workload.registry import query
from furrow.workload.scalars import conf

LABEL = ("CASE WHEN {d} = 1 THEN 'very low' WHEN {d} <= 3 THEN 'below normal' WHEN {d} <= 7 THEN 'near normal' WHEN {d} <= 9 THEN 'above normal' "
         "WHEN {d} = 10 THEN 'very high' END")
DECILE = "CAST(greatest(1, least(10, ceil(({b} + 1) / {n}::DOUBLE * 10))) AS INT)"
SCORE = "CAST(round_even(greatest(1, least(10, ({b} + 1) / {n}::DOUBLE * 10)), 1) AS DOUBLE)"
MIN_HISTORY = 4


# --- rank conventions --------------------------------------------------------------------

_PAIR = """SELECT t.sa2_code, t.month, t.rainfall_mm, count(h.rainfall_mm) AS n, count(*) FILTER (h.rainfall_mm < t.rainfall_mm) AS b
  FROM region_month t LEFT JOIN region_month h ON t.sa2_code = h.sa2_code AND t.month = h.month AND h.year BETWEEN 1995 AND 2000 AND h.rainfall_mm IS NOT NULL
  WHERE t.year = 2001 AND t.rainfall_mm IS NOT NULL GROUP BY 1, 2, 3"""


def _pairwise(spark, sf):
    rm = B.region_month_df(spark, sf).select("sa2_code", "month", "year", "rainfall_mm")
    target = rm.where("year = 2001 AND rainfall_mm IS NOT NULL").drop("year")
    return ranking.pairwise_rank(target, rm.where("year BETWEEN 1995 AND 2000").drop("year"), ["sa2_code", "month"], "rainfall_mm")


@query("e7_percentile_rank", f"SELECT sa2_code, month, n AS n_hist_years, b AS below, b / n::DOUBLE * 100 AS percentile_rank FROM ({_PAIR}) WHERE n > 0", ("region_month",), ("percentile_rank",))
def _(spark, sf):
    return _pairwise(spark, sf).where("n_hist_years > 0").select("sa2_code", "month", "n_hist_years", "below", "percentile_rank")


@query("e8_decile_rank", f"SELECT sa2_code, month, {DECILE.format(b='b', n='n')} AS decile FROM ({_PAIR}) WHERE n > 0", ("region_month",))
def _(spark, sf):
    return _pairwise(spark, sf).where("n_hist_years > 0").select("sa2_code", "month", "decile")


@query("e9_decile_score", f"SELECT sa2_code, month, {SCORE.format(b='b', n='n')} AS decile_decimal FROM ({_PAIR}) WHERE n > 0", ("region_month",))
def _(spark, sf):
    return _pairwise(spark, sf).where("n_hist_years > 0").select("sa2_code", "month", "decile_decimal")


def _loo(cond: str) -> str:
    """Self-join form of the leave-one-year-out climatology."""
    return f"""SELECT sa2_code, year, month, rainfall_mm, n AS historical_year_count, flag AS climatology_quality_flag,
      CASE WHEN flag = 'ok' THEN med END AS historical_median_mm, CASE WHEN flag = 'ok' THEN mean END AS historical_mean_mm,
      CASE WHEN flag = 'ok' THEN rainfall_mm - med END AS anomaly_mm, CASE WHEN flag = 'ok' THEN (rainfall_mm - med) / nullif(med, 0) * 100 END AS anomaly_pct,
      CASE WHEN flag = 'ok' THEN {DECILE.format(b='below', n='nullif(n, 0)')} END AS rainfall_decile,
      CASE WHEN flag = 'ok' THEN {LABEL.format(d=DECILE.format(b='below', n='nullif(n, 0)'))} END AS rainfall_decile_label
    FROM (SELECT *, CASE WHEN is_partial_month THEN 'partial_month_no_decile' WHEN rainfall_mm IS NULL THEN 'null_rainfall'
            WHEN n < {MIN_HISTORY} THEN 'insufficient_history(' || n || ')' ELSE 'ok' END AS flag
          FROM (SELECT t.sa2_code, t.year, t.month, t.rainfall_mm, t.is_partial_month, count(h.rainfall_mm) AS n, median(h.rainfall_mm) AS med,
                       avg(h.rainfall_mm) AS mean, count(*) FILTER (h.rainfall_mm < t.rainfall_mm) AS below
                FROM region_month t LEFT JOIN region_month h ON t.state_name = h.state_name AND t.sa2_code = h.sa2_code AND t.month = h.month AND {cond}
                     AND NOT h.is_partial_month AND h.rainfall_mm IS NOT NULL
                GROUP BY 1, 2, 3, 4, 5))"""


_LOO_COLS = ("sa2_code", "year", "month", "rainfall_mm", "historical_year_count", "climatology_quality_flag", "historical_median_mm", "historical_mean_mm",
             "anomaly_mm", "anomaly_pct", "rainfall_decile", "rainfall_decile_label")
_LOO_ROUND = ("historical_median_mm", "historical_mean_mm", "anomaly_mm", "anomaly_pct")


def _loo_df(spark, sf, baseline):
    return ranking.leave_year_out(B.region_month_df(spark, sf), ["state_name", "sa2_code", "month"], min_history=MIN_HISTORY, baseline=baseline).select(*_LOO_COLS)


@query("e10_deciles_other_years", _loo("h.year <> t.year"), ("region_month",), _LOO_ROUND)
def _(spark, sf):
    return _loo_df(spark, sf, "others")


@query("e10_deciles_prior_years", _loo("h.year < t.year"), ("region_month",), _LOO_ROUND)
def _(spark, sf):
    return _loo_df(spark, sf, "prior")


@query("c13_baseline_year_range", _loo("h.year <> t.year AND h.year BETWEEN 1995 AND 1999"), ("region_month",), _LOO_ROUND)
def _(spark, sf):
    return _loo_df(spark, sf, (1995, 1999))


_WD = """
  uni AS (SELECT state_name, sum(weight) AS universe_area, count(*) AS n_universe FROM weights WHERE weight IS NOT NULL GROUP BY 1),
  r AS (SELECT h.*, weight FROM region_month h JOIN weights w ON h.sa2_code = w.sa2_code AND h.state_name = w.state_name WHERE weight IS NOT NULL),
  t AS (SELECT state_name, year, month, sum(rainfall_mm * weight) / nullif(sum(weight) FILTER (rainfall_mm IS NOT NULL), 0) AS tot,
               sum(weight) FILTER (rainfall_mm IS NOT NULL) AS weighting_area, count(rainfall_mm) AS n_weighted, count(*) - count(rainfall_mm) AS n_missing,
               bool_or(is_partial_month) AS is_partial_month FROM r GROUP BY 1, 2, 3),
  h AS (SELECT a.state_name, a.year, a.month, b.year AS hy, sum(b.rainfall_mm * b.weight) / nullif(sum(b.weight), 0) AS ht
        FROM r a JOIN r b ON a.state_name = b.state_name AND a.month = b.month AND a.sa2_code = b.sa2_code AND a.year <> b.year
        WHERE a.rainfall_mm IS NOT NULL AND b.rainfall_mm IS NOT NULL AND NOT b.is_partial_month GROUP BY 1, 2, 3, 4),
  j AS (SELECT t.*, universe_area, weighting_area / nullif(universe_area, 0) AS share, n_universe, count(ht) AS n, median(ht) AS med, avg(ht) AS mean,
               count(*) FILTER (ht < tot) AS below FROM t JOIN uni USING (state_name) LEFT JOIN h USING (state_name, year, month) GROUP BY ALL),
  f AS (SELECT *, CASE WHEN tot IS NULL THEN 'null_weighted_rainfall' WHEN is_partial_month THEN 'partial_month' WHEN share < 0.8 THEN 'low_coverage'
               WHEN n < 4 THEN 'insufficient_history' ELSE 'ok' END AS flag FROM j)"""
_WD_EXTRA = tuple((part.split(" AS (", 1)[0].strip(), part.split(" AS (", 1)[1].rstrip()[:-1])
                  for part in re.split(r",\n  (?=\w+ AS \()", _WD.strip()))


@query("e11_weighted_deciles", f"""
    SELECT state_name, year, month, tot AS rainfall_mm_wt, weighting_area, share AS weighting_area_share, n_universe, n_weighted, n_missing, is_partial_month, flag AS climatology_quality_flag,
           CASE WHEN flag IN ('ok', 'insufficient_history') THEN n ELSE 0 END AS historical_year_count, CASE WHEN flag = 'ok' THEN med END AS historical_median_mm_wt,
           CASE WHEN flag = 'ok' THEN mean END AS historical_mean_mm_wt, CASE WHEN flag = 'ok' THEN tot - med END AS anomaly_mm_wt,
           CASE WHEN flag = 'ok' THEN {DECILE.format(b='below', n='nullif(n, 0)')} END AS rainfall_decile FROM f""",
       ("region_month", "weights"), ("rainfall_mm_wt", "weighting_area_share", "historical_median_mm_wt", "historical_mean_mm_wt", "anomaly_mm_wt"), _WD_EXTRA)
def _(spark, sf):
    d = ranking.weighted_deciles(B.region_month_df(spark, sf), B.weights_df(spark, sf), min_history=MIN_HISTORY)
    return d.select("state_name", "year", "month", "rainfall_mm_wt", "weighting_area", "weighting_area_share", "n_universe", "n_weighted", "n_missing", "is_partial_month",
                    "climatology_quality_flag", "historical_year_count", "historical_median_mm_wt", "historical_mean_mm_wt", "anomaly_mm_wt", "rainfall_decile")


@query("e12_cell_percentile", """
    SELECT cell_id, target_mm, n_valid, CASE WHEN n_valid > 0 AND target_mm IS NOT NULL THEN least(100, 100 * (below + 1) / n_valid::DOUBLE) END AS percentile
    FROM (SELECT cell_id, max(t) AS target_mm, count(mm) FILTER (year BETWEEN 1995 AND 2000) AS n_valid, count(*) FILTER (year BETWEEN 1995 AND 2000 AND mm < t) AS below
          FROM (SELECT *, max(CASE WHEN year = 2001 THEN mm END) OVER (PARTITION BY cell_id) AS t FROM grid_month WHERE month = 5) WHERE year BETWEEN 1995 AND 2001 GROUP BY 1)""",
       ("grid_month",), ("percentile",))
def _(spark, sf):
    return ranking.cell_percentiles(B.grid_month_df(spark, sf), 5, 2001, 1995, 2000)


@query("e13_grid_decile_class", """
    SELECT cell_id, target_mm, n_years, below / n_years::DOUBLE * 100 AS percentile, CASE WHEN below = n_years THEN 6 WHEN below = 0 THEN 0 WHEN below / n_years::DOUBLE * 100 >= 90 THEN 5
           WHEN below / n_years::DOUBLE * 100 >= 70 THEN 4 WHEN below / n_years::DOUBLE * 100 >= 30 THEN 3 WHEN below / n_years::DOUBLE * 100 >= 10 THEN 2 ELSE 1 END AS decile_class
    FROM (SELECT cell_id, max(t) AS target_mm, CAST(count(mm) FILTER (year <= 2000) AS INT) AS n_years, count(*) FILTER (year <= 2000 AND mm < t) AS below
          FROM (SELECT *, max(CASE WHEN year = 2001 THEN mm END) OVER (PARTITION BY cell_id) AS t FROM grid_month WHERE month = 6) GROUP BY 1)
    WHERE target_mm IS NOT NULL AND n_years = 6""", ("grid_month",), ("percentile",))
def _(spark, sf):
    return ranking.grid_decile_class(B.grid_month_df(spark, sf), 6, 2001, 1995, 2000)


@query("d27_climatology", """
    SELECT sa2_code, month, quantile_cont(rainfall_mm, 0.1) AS p10, quantile_cont(rainfall_mm, 0.25) AS p25, quantile_cont(rainfall_mm, 0.5) AS p50, quantile_cont(rainfall_mm, 0.75) AS p75,
           quantile_cont(rainfall_mm, 0.9) AS p90, min(rainfall_mm) AS min, max(rainfall_mm) AS max, count(rainfall_mm) AS n_years FROM region_month WHERE year <= 2000 GROUP BY 1, 2""",
       ("region_month",), ("p10", "p25", "p50", "p75", "p90"))
def _(spark, sf):
    return ranking.climatology(B.region_month_df(spark, sf).where("year <= 2000"), ["sa2_code", "month"], "rainfall_mm")


@query("d45_latest_complete_year", "SELECT max(year) AS latest_complete_year FROM (SELECT year FROM region_month GROUP BY 1 HAVING count(DISTINCT month) = 12)", ("region_month",))
def _(spark, sf):
    return A.latest_complete_year(B.region_month_df(spark, sf))


# --- weighted means ----------------------------------------------------------------------

@query("d5_weighted_mean", """
    SELECT state_name, year, month, sum(rainfall_mm * weight) FILTER (weight > 0) / nullif(sum(weight) FILTER (weight > 0 AND rainfall_mm IS NOT NULL), 0) AS mean_mm
    FROM region_month JOIN weights USING (sa2_code, state_name) GROUP BY 1, 2, 3""", ("region_month", "weights"), ("mean_mm",))
def _(spark, sf):
    j = B.region_month_df(spark, sf).join(B.weights_df(spark, sf).select("sa2_code", "state_name", "weight"), ["sa2_code", "state_name"])
    return j.groupBy("state_name", "year", "month").agg(A.weighted_mean("rainfall_mm", "weight").alias("mean_mm"))


@query("d6_area_weighted", """
    SELECT state_name, year, sum(rainfall_mm * weight) / sum(weight) AS rainfall_mm FROM region_month JOIN weights USING (sa2_code, state_name)
    WHERE weight > 0 AND rainfall_mm IS NOT NULL GROUP BY 1, 2""", ("region_month", "weights"), ("rainfall_mm",))
def _(spark, sf):
    return A.area_weighted(B.region_month_df(spark, sf), B.weights_df(spark, sf), "rainfall_mm", ["state_name", "year"])


WINDOWS_BY_STATE = """SELECT year, state_name, """ + ", ".join(
    f"sum({n} * weight) FILTER (weight > 0) / nullif(sum(weight) FILTER (weight > 0 AND {n} IS NOT NULL), 0) AS {n}" for n in P.ANALOGUE_WINDOWS) + """
  FROM (SELECT year, state_name, sa2_5, weight, """ + ", ".join(
    f"sum(rainfall_mm) FILTER (month BETWEEN {lo} AND {hi}) AS {n}" for n, (lo, hi) in P.ANALOGUE_WINDOWS.items()) + """
        FROM region_month JOIN weights USING (sa2_5, state_name) WHERE NOT is_partial_month OR year = 2001 GROUP BY 1, 2, 3, 4) GROUP BY 1, 2"""


def state_windows(spark, sf):
    w = B.weights_df(spark, sf).drop("sa2_code")
    return A.window_by_state(B.region_month_df(spark, sf), w, 2001)


@query("d7_window_by_state", WINDOWS_BY_STATE, ("region_month", "weights"), tuple(P.ANALOGUE_WINDOWS))
def _(spark, sf):
    return state_windows(spark, sf)


@query("c20_windows_in_one_pass", f"SELECT year, state_name, jan_mar + apr_may AS jan_may FROM ({WINDOWS_BY_STATE})", ("region_month", "weights"), ("jan_may",))
def _(spark, sf):
    return state_windows(spark, sf).select("year", "state_name", (F.col("jan_mar") + F.col("apr_may")).alias("jan_may"))


# --- season features ---------------------------------------------------------------------

MIN_COV = 0.2


def _wt(lo, hi, name):
    v, n = f"count(rainfall) FILTER (m BETWEEN {lo} AND {hi})", f"count(*) FILTER (m BETWEEN {lo} AND {hi})"
    return f"CASE WHEN {v} > 0 AND {v} / {n}::DOUBLE >= {MIN_COV} THEN sum(rainfall) FILTER (m BETWEEN {lo} AND {hi}) END AS {name}"


def _elapsed(a, b):
    s, e = f"make_date(y, {a[0]}, {a[1]})", f"make_date(y, {b[0]}, {b[1]})"
    return f"CASE WHEN fin >= {s} THEN greatest(least({e}, fin) - {s} + 1, 1) ELSE 1 END"


_MONTHS = [f"monthly_rainfall_{a}_mm" for a in P.MONTH_ABBR]
_TOTALS = [*_MONTHS, *P.SEASON_WINDOWS]
FLAG = ("CASE WHEN season_coverage_ratio < {c} THEN 'insufficient_season' WHEN sowing_window_coverage_ratio < {c} THEN 'insufficient_sowing_window' "
        "WHEN in_crop_coverage_ratio < {c} THEN 'partial' WHEN is_in_progress THEN 'complete_to_date' ELSE 'complete' END")


def station_features_sql(src: str) -> tuple:
    clean = f"SELECT station_id, date, CASE WHEN rainfall_quality = 999 THEN NULL ELSE rainfall END AS rainfall, rainfall_quality FROM {src}"
    agg = "SELECT station_id, y, " + ", ".join(
        [_wt(m, m, n) for m, n in enumerate(_MONTHS, 1)] + [_wt(lo, hi, n) for n, (lo, hi) in P.SEASON_WINDOWS.items()]
    ) + (", count(*) AS n, count(*) FILTER (m BETWEEN 4 AND 6) AS ns, count(*) FILTER (m BETWEEN 5 AND 10) AS nc, least(max(date), make_date(y, 12, 31)) AS fin, "
         f"CASE WHEN count(rainfall_quality) = 0 THEN 0.5 ELSE avg(CASE WHEN rainfall_quality IS NULL THEN 0 ELSE {conf('rainfall_quality')} END) END AS data_quality_score "
         "FROM (SELECT *, CAST(year(date) AS INT) AS y, month(date) AS m FROM clean) GROUP BY 1, 2")
    cov = f"""SELECT *, n / greatest(fin - make_date(y, 1, 1) + 1, 1)::DOUBLE AS season_coverage_ratio, ns / ({_elapsed((4, 1), (6, 30))})::DOUBLE AS sowing_window_coverage_ratio,
              nc / ({_elapsed((5, 1), (10, 31))})::DOUBLE AS in_crop_coverage_ratio, fin < make_date(y, 12, 31) AS is_in_progress FROM agg"""
    brk = f"SELECT *, {_STATUS} AS autumn_break_status FROM ({_BREAK.format(src=_SLICE.format(src='clean'))})"
    feat = f"""SELECT cov.station_id, y AS season_year, {', '.join(_TOTALS)}, autumn_break_date, autumn_break_7d_mm, autumn_break_status, dry_spell_days_7d_lt_5mm, dry_spell_days_14d_lt_10mm,
               data_quality_score, season_coverage_ratio, sowing_window_coverage_ratio, in_crop_coverage_ratio, is_in_progress, {FLAG.format(c=MIN_COV)} AS feature_quality_flag
               FROM cov JOIN brk ON cov.station_id = brk.station_id AND y = season_year WHERE season_coverage_ratio >= {MIN_COV * 0.5}"""
    return (("clean", clean), ("agg", agg), ("cov", cov), ("brk", brk), ("feat", feat))


_F_ROUND = ("data_quality_score", "season_coverage_ratio", "sowing_window_coverage_ratio", "in_crop_coverage_ratio")


@query("d8_season_features_station", "SELECT * FROM feat", ("obs",), _F_ROUND, station_features_sql("obs"))
def _(spark, sf):
    return season_features(B.obs_df(spark, sf), MIN_COV)


_NUM = [*_TOTALS, "autumn_break_7d_mm", "dry_spell_days_7d_lt_5mm", "dry_spell_days_14d_lt_10mm", "data_quality_score", "season_coverage_ratio",
        "sowing_window_coverage_ratio", "in_crop_coverage_ratio"]
REGION_FEATURES = station_features_sql("obs") + (("rf0", f"""
    SELECT season_year, sa2_code, count(*) AS station_count, string_agg(station_id, '|' ORDER BY station_id) AS contributing_station_ids, min(state_name) AS state_name, min(sa2_name) AS sa2_name,
           {', '.join(f'avg({c}) AS {c}' for c in _NUM)}, min(autumn_break_date) AS autumn_break_date, bool_or(is_in_progress) AS is_in_progress
    FROM feat JOIN stations USING (station_id) GROUP BY 1, 2"""), ("modes", """
    SELECT season_year, sa2_code, autumn_break_status FROM (SELECT *, row_number() OVER (PARTITION BY season_year, sa2_code ORDER BY n DESC, autumn_break_status) AS rn
      FROM (SELECT season_year, sa2_code, autumn_break_status, count(*) AS n FROM feat JOIN stations USING (station_id) GROUP BY 1, 2, 3)) WHERE rn = 1"""),
    ("rf", f"SELECT * EXCLUDE (is_in_progress), {FLAG.format(c=MIN_COV)} AS feature_quality_flag FROM rf0 JOIN modes USING (season_year, sa2_code)"))


def _station_map(spark, sf):
    return B.stations_df(spark, sf).select("station_id", "sa2_code", "sa2_name", "state_name")


@query("d11_aggregate_to_region", "SELECT * FROM rf", ("obs", "stations"), tuple(_NUM), REGION_FEATURES)
def _(spark, sf):
    return A.aggregate_to_region(season_features(B.obs_df(spark, sf), MIN_COV), _station_map(spark, sf), MIN_COV)


def _gate(lo, length, as_of=11):
    el = max(0, min(length, as_of - lo + 1))
    return f"coalesce(count(rainfall_mm) FILTER (month BETWEEN {lo} AND {lo + length - 1}) / nullif(CASE WHEN year < 2001 THEN {length} WHEN year = 2001 THEN {el} ELSE 0 END, 0)::DOUBLE, 0)"


_DAYS = "CASE WHEN is_partial_month AND partial_month_through_day IS NOT NULL THEN partial_month_through_day ELSE day(last_day(make_date(year, month, 1))) END"
MONTHLY_FEATURES = (("mf0", "SELECT state_name, sa2_code, sa2_name, year AS season_year, " + ", ".join(
    [f"max(rainfall_mm) FILTER (month = {m}) AS {n}" for m, n in enumerate(_MONTHS, 1)]
    + [f"sum(rainfall_mm) FILTER (month BETWEEN {lo} AND {hi}) AS {n}" for n, (lo, hi) in P.SEASON_WINDOWS.items()]) + f""",
    max(partial_month_through_day) FILTER (is_partial_month) AS partial_through_day, {_gate(1, 12)} AS g1, {_gate(4, 3)} AS g2, {_gate(5, 6)} AS g3,
    coalesce(sum({_DAYS}) FILTER (rainfall_mm IS NOT NULL), 0) / dayofyear(make_date(year, 12, 31))::DOUBLE AS season_coverage_ratio,
    coalesce(sum({_DAYS}) FILTER (rainfall_mm IS NOT NULL AND month BETWEEN 4 AND 6), 0) / 91::DOUBLE AS sowing_window_coverage_ratio,
    coalesce(sum({_DAYS}) FILTER (rainfall_mm IS NOT NULL AND month BETWEEN 5 AND 10), 0) / 184::DOUBLE AS in_crop_coverage_ratio
    FROM region_month GROUP BY 1, 2, 3, 4"""),
    ("mf", """SELECT * EXCLUDE (g1, g2, g3), CASE WHEN g1 < 0.8 THEN 'insufficient_season' WHEN g2 < 0.8 THEN 'insufficient_sowing_window' WHEN g3 < 0.8 THEN 'partial'
        WHEN partial_through_day IS NOT NULL THEN 'complete_to_date' ELSE 'complete' END AS feature_quality_flag, left(sa2_code, 1) || right(sa2_code, 4) AS sa2_5,
        'canonical_monthly' AS monthly_features_source, 'monthly_only' AS daily_features_status, 'not_assessed' AS autumn_break_status FROM mf0"""))
_M_ROUND = ("season_coverage_ratio", "sowing_window_coverage_ratio", "in_crop_coverage_ratio")
_WIDE = ["state_name", "sa2_code", "season_year", *_TOTALS]


@query("d9_season_features_monthly", f"SELECT {', '.join(_WIDE)} FROM mf", ("region_month",), (), MONTHLY_FEATURES)
def _(spark, sf):
    return A.season_features_monthly(B.region_month_df(spark, sf), 2001, 11).select(*_WIDE)


@query("d10_coverage_ratios", "SELECT sa2_code, season_year, season_coverage_ratio, sowing_window_coverage_ratio, in_crop_coverage_ratio, feature_quality_flag FROM mf",
       ("region_month",), _M_ROUND, MONTHLY_FEATURES)
def _(spark, sf):
    return A.season_features_monthly(B.region_month_df(spark, sf), 2001, 11).select(
        "sa2_code", "season_year", *_M_ROUND, "feature_quality_flag")


_OVER = [*P.DAILY_DERIVED, "data_quality_score"]
_HYBRID = """SELECT mf.sa2_code, mf.season_year, mf.feature_quality_flag, mf.rainfall_total_apr_oct_mm, rf.autumn_break_date, rf.autumn_break_7d_mm,
    coalesce(rf.autumn_break_status, mf.autumn_break_status) AS autumn_break_status, rf.dry_spell_days_7d_lt_5mm, rf.dry_spell_days_14d_lt_10mm, rf.data_quality_score,
    CASE WHEN rf.sa2_code IS NOT NULL THEN 'station_daily' ELSE mf.daily_features_status END AS daily_features_status
  FROM mf LEFT JOIN rf ON mf.season_year = rf.season_year AND mf.sa2_5 = left(rf.sa2_code, 1) || right(rf.sa2_code, 4)"""
_HCOLS = ("sa2_code", "season_year", "feature_quality_flag", "rainfall_total_apr_oct_mm", *_OVER, "daily_features_status")


def _hybrid(spark, sf):
    return seasons.build_season_features("hybrid", history=B.region_month_df(spark, sf), obs=B.obs_df(spark, sf),
                                         station_map=_station_map(spark, sf), as_of=(2001, 11), min_coverage=MIN_COV)


@query("c11_overlay_daily_on_monthly", _HYBRID, ("region_month", "obs", "stations"),
       ("autumn_break_7d_mm", "dry_spell_days_7d_lt_5mm", "dry_spell_days_14d_lt_10mm", "data_quality_score"), MONTHLY_FEATURES + REGION_FEATURES)
def _(spark, sf):
    base = A.season_features_monthly(B.region_month_df(spark, sf), 2001, 11)
    daily = A.aggregate_to_region(season_features(B.obs_df(spark, sf), MIN_COV), _station_map(spark, sf), MIN_COV)
    daily = daily.withColumn("sa2_5", S.code9_to_5("sa2_code"))
    return joins.overlay(base, daily, ["season_year", "sa2_5"], _OVER).select(*_HCOLS)


@query("i9_build_season_features_stations", "SELECT season_year, sa2_code, station_count, rainfall_total_apr_oct_mm, autumn_break_date, autumn_break_status, feature_quality_flag, 'station_daily' AS daily_features_status FROM rf",
       ("obs", "stations"), ("rainfall_total_apr_oct_mm",), REGION_FEATURES)
def _(spark, sf):
    f = seasons.build_season_features("stations", obs=B.obs_df(spark, sf), station_map=_station_map(spark, sf), min_coverage=MIN_COV)
    return f.select("season_year", "sa2_code", "station_count", "rainfall_total_apr_oct_mm", "autumn_break_date", "autumn_break_status", "feature_quality_flag", "daily_features_status")


@query("i9_build_season_features_hybrid", """
    SELECT mf.sa2_code, mf.season_year, mf.monthly_features_source, CASE WHEN rf.sa2_code IS NOT NULL THEN 'station_daily' ELSE mf.daily_features_status END AS daily_features_status,
           coalesce(rf.autumn_break_status, mf.autumn_break_status) AS autumn_break_status, 'silo_patched_point' AS source_dataset, '1' AS pipeline_version
    FROM mf LEFT JOIN rf ON mf.season_year = rf.season_year AND mf.sa2_5 = left(rf.sa2_code, 1) || right(rf.sa2_code, 4)""",
       ("region_month", "obs", "stations"), (), MONTHLY_FEATURES + REGION_FEATURES)
def _(spark, sf):
    return _hybrid(spark, sf).select("sa2_code", "season_year", "monthly_features_source", "daily_features_status", "autumn_break_status", "source_dataset", "pipeline_version")


@query("a5_read_region_history", """
    SELECT sa2_code, month, rainfall_mm, is_partial_month, partial_month_through_day FROM region_month WHERE year = 2001""", ("region_month",))
def _(spark, sf):
    rows = B.region_month_df(spark, sf).withColumn("is_partial_month", F.when(F.col("is_partial_month"), True))
    return read_region_history(rows, 2001).select("sa2_code", "month", "rainfall_mm", "is_partial_month", "partial_month_through_day")


# --- crop join and summary ---------------------------------------------------------------

def _features(spark, sf, months=None):
    """Season features of every state and season."""
    return A.season_features_monthly(B.region_month_df(spark, sf) if months is None else months, 2001, 11)


JOINED = (("feats", "SELECT * FROM mf"),
          ("joined", f"""SELECT c.sa2_code AS abs_sa2_code, c.station_sa2_5dig16, c.sa2_name, c.state, c.crop, c.area_ha_for_weighting, c.area_is_fallback, f.season_year,
             coalesce(f.feature_quality_flag, 'no_data') AS rainfall_feature_quality_flag, {', '.join('f.' + n for n in P.SEASON_WINDOWS)}
             FROM (SELECT * FROM crop_context WHERE n_nationkey <> 13) c LEFT JOIN feats f ON c.station_sa2_5dig16 = f.sa2_5
             UNION ALL SELECT sa2_code, '99999', sa2_name, state, crop, area_ha_for_weighting, area_is_fallback, NULL, 'no_data', {', '.join('NULL' for _ in P.SEASON_WINDOWS)}
             FROM crop_context WHERE n_nationkey = 13"""))


def _joined(spark, sf, months=None):
    crops = B.crop_context_df(spark, sf)
    # one region carries a code the rainfall side does not know
    crops = crops.withColumn("station_sa2_5dig16", F.when(F.col("n_nationkey") == 13, "99999").otherwise(F.col("station_sa2_5dig16")))
    return seasons.join_crop_context(_features(spark, sf, months), crops.drop("n_nationkey"))


@query("c6_crop_led_join", "SELECT abs_sa2_code, crop, season_year, rainfall_feature_quality_flag, rainfall_total_apr_oct_mm FROM joined", ("region_month", "crop_context"), (), MONTHLY_FEATURES + JOINED)
def _(spark, sf):
    return _joined(spark, sf).select("abs_sa2_code", "crop", "season_year", "rainfall_feature_quality_flag", "rainfall_total_apr_oct_mm")


@query("d43_join_coverage", """
    SELECT coalesce(state, 'ALL') AS state, count(*) AS n_rows, count(DISTINCT abs_sa2_code) AS n_sa2, count(DISTINCT CASE WHEN rainfall_feature_quality_flag <> 'no_data' THEN abs_sa2_code END) AS n_matched,
           count(DISTINCT CASE WHEN rainfall_feature_quality_flag = 'no_data' THEN abs_sa2_code END) AS n_no_data FROM joined GROUP BY ROLLUP (state)""",
       ("region_month", "crop_context"), (), MONTHLY_FEATURES + JOINED)
def _(spark, sf):
    return A.join_coverage(_joined(spark, sf))


_SUMM = (("rep", """SELECT * FROM joined WHERE crop = 'building' AND rainfall_feature_quality_flag <> 'no_data'
    UNION ALL SELECT j.* REPLACE (s.season_year AS season_year) FROM joined j JOIN (SELECT DISTINCT state, season_year FROM joined WHERE crop = 'building' AND season_year IS NOT NULL) s USING (state)
    WHERE crop = 'building' AND rainfall_feature_quality_flag = 'no_data'"""),
         ("tag", "SELECT *, rainfall_feature_quality_flag IN ('complete', 'complete_to_date') AS comp, area_ha_for_weighting AS w FROM rep"))
_METRICS = tuple(P.SEASON_WINDOWS)


@query("g3_replicate_no_data_rows", "SELECT state, season_year, abs_sa2_code, rainfall_feature_quality_flag FROM rep", ("region_month", "crop_context"), (), MONTHLY_FEATURES + JOINED + _SUMM)
def _(spark, sf):
    j = _joined(spark, sf).where("crop = 'building'")
    return sets.replicate_into_seasons(j, "rainfall_feature_quality_flag", "season_year", ["state"]).select("state", "season_year", "abs_sa2_code", "rainfall_feature_quality_flag")


SUMMARY_SQL = f"""SELECT state, CAST(season_year AS INT) AS season_year, count(*) AS n_sa2s_universe, count(*) FILTER (comp) AS n_sa2s_complete, count(*) FILTER (comp AND w IS NOT NULL) AS n_sa2s_eligible,
    count(*) FILTER (rainfall_feature_quality_flag = 'insufficient_season') AS n_sa2s_insufficient_season, count(*) FILTER (rainfall_feature_quality_flag = 'no_data') AS n_sa2s_no_data,
    count(*) FILTER (comp AND w IS NULL) AS n_sa2s_complete_no_area,
    coalesce(sum(w) FILTER (comp), 0) / CASE WHEN sum(w) > 0 THEN sum(w) END AS coverage_share, CASE WHEN sum(w) > 0 THEN sum(w) END AS mapped_area_ha,
    {', '.join(f"sum({m} * w) FILTER (comp AND w > 0) / nullif(sum(w) FILTER (comp AND w > 0 AND {m} IS NOT NULL), 0) AS {m}_wt" for m in _METRICS)},
    coalesce(string_agg(sa2_name, '; ' ORDER BY sa2_name) FILTER (comp AND w IS NOT NULL), '') AS eligible_sa2s,
    coalesce(string_agg(sa2_name, '; ' ORDER BY sa2_name) FILTER (rainfall_feature_quality_flag = 'no_data'), '') AS excluded_no_data_sa2s,
    coalesce(string_agg(sa2_name, '; ' ORDER BY sa2_name) FILTER (comp AND w IS NOT NULL AND area_is_fallback), '') AS fallback_area_sa2s,
    coalesce('Uses 2015-16 ABS fallback area for ' || string_agg(sa2_name, '; ' ORDER BY sa2_name) FILTER (comp AND w IS NOT NULL AND area_is_fallback)
             || ' because 2020-21 building area was not published.', '') AS area_fallback_caveat
  FROM tag GROUP BY 1, 2"""
_SUMM_COLS = ("state", "season_year", "n_sa2s_universe", "n_sa2s_complete", "n_sa2s_eligible", "n_sa2s_insufficient_season", "n_sa2s_no_data", "n_sa2s_complete_no_area", "coverage_share",
              "mapped_area_ha", *[f"{m}_wt" for m in _METRICS], "eligible_sa2s", "excluded_no_data_sa2s", "fallback_area_sa2s", "area_fallback_caveat")
_SUMM_ROUND = ("coverage_share", *[f"{m}_wt" for m in _METRICS])


def _summary(spark, sf, months=None):
    return seasons.weighted_summary(_joined(spark, sf, months), crop="building", metrics=_METRICS)


@query("d22_weighted_summary", SUMMARY_SQL, ("region_month", "crop_context"), _SUMM_ROUND, MONTHLY_FEATURES + JOINED + _SUMM)
def _(spark, sf):
    return _summary(spark, sf).select(*_SUMM_COLS)


@query("i11_weighted_rainfall_summary", f"SELECT state, season_year, coverage_share, rainfall_total_apr_oct_mm_wt, 'building' AS crop FROM ({SUMMARY_SQL})",
       ("region_month", "crop_context"), ("coverage_share", "rainfall_total_apr_oct_mm_wt"), MONTHLY_FEATURES + JOINED + _SUMM)
def _(spark, sf):
    return _summary(spark, sf).select("state", "season_year", "coverage_share", "rainfall_total_apr_oct_mm_wt", "crop")


@query("d23_weighted_monthly_total", "SELECT state_name, year, month, tot AS rainfall_mm_wt, share AS weighting_area_share, n_missing FROM j", ("region_month", "weights"),
       ("rainfall_mm_wt", "weighting_area_share"), _WD_EXTRA)
def _(spark, sf):
    return ranking.weighted_deciles(B.region_month_df(spark, sf), B.weights_df(spark, sf)).select(
        "state_name", "year", "month", "rainfall_mm_wt", "weighting_area_share", "n_missing")


@query("i20_weekly_outlook", f"""
    SELECT f.state_name AS state, month, CASE WHEN month <= 3 THEN 'pre-seeding' WHEN month <= 10 THEN 'growing season' ELSE 'harvest' END AS period, tot AS rainfall_mm_wt,
           CASE WHEN flag = 'ok' THEN med END AS median_mm, CASE WHEN flag = 'ok' THEN {DECILE.format(b='below', n='nullif(n, 0)')} END AS decile,
           CASE WHEN flag = 'ok' THEN tot - med END AS diff_from_median_mm, n_sa2s_eligible, coverage_share, pre_seeding_rain_mm_wt
    FROM f LEFT JOIN (SELECT * FROM ({SUMMARY_SQL}) WHERE season_year = 2001) s ON f.state_name = s.state WHERE year = 2001 AND month <= 11""",
       ("region_month", "crop_context", "weights"), ("rainfall_mm_wt", "median_mm", "diff_from_median_mm", "coverage_share", "pre_seeding_rain_mm_wt"), MONTHLY_FEATURES + JOINED + _SUMM + _WD_EXTRA)
def _(spark, sf):
    months = stored(B.region_month_df(spark, sf), "region-month")
    return seasons.weekly_outlook(_summary(spark, sf, months), months, B.weights_df(spark, sf), 2001, 11, MIN_HISTORY).drop("label")


@query("f2_driest_and_wettest", """
    SELECT state_name, sa2_name, month, anomaly_mm, side, CAST(rank AS INT) AS rank FROM (
      SELECT state_name, sa2_name, month, anomaly_mm, 'driest' AS side, row_number() OVER (PARTITION BY state_name ORDER BY anomaly_mm, sa2_name, month) AS rank FROM an
      UNION ALL SELECT state_name, sa2_name, month, anomaly_mm, 'wettest', row_number() OVER (PARTITION BY state_name ORDER BY anomaly_mm DESC, sa2_name, month) FROM an) WHERE rank <= 8""",
       ("region_month",), (), (("an", """SELECT t.state_name, t.sa2_name, t.month, t.rainfall_mm - median(h.rainfall_mm) AS anomaly_mm FROM region_month t JOIN region_month h
         ON t.sa2_code = h.sa2_code AND t.month = h.month AND t.year <> h.year AND NOT h.is_partial_month WHERE t.year = 2001 AND NOT t.is_partial_month AND t.rainfall_mm IS NOT NULL
         GROUP BY t.state_name, t.sa2_name, t.month, t.rainfall_mm HAVING count(h.rainfall_mm) >= 4"""),))
def _(spark, sf):
    d = ranking.leave_year_out(B.region_month_df(spark, sf), ["state_name", "sa2_code", "month"], min_history=MIN_HISTORY)
    d = d.where("year = 2001 AND anomaly_mm IS NOT NULL").select("state_name", "sa2_name", "month", "anomaly_mm")
    return both_ends(d, ["state_name"], ["anomaly_mm", "sa2_name", "month"], 8)
