"""Queries over daily observations: series operators, events, quality and digest tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import scalar as S
from furrow.operators import aggregates as A
from furrow.operators import sets
from furrow.operators import timeseries as TS
from furrow.operators.topk import business_order, first_n, top_k
from furrow.plans import digest as D
from furrow.plans import events as E
from furrow.plans import quality as Q
from furrow.workload import bind as B
from furrow.workload.registry import query
from furrow.workload.scalars import FROST_LIGHT, FROST_SEVERITY, SEASON, STAGE, conf

COMPLETE = "SELECT * FROM dense_obs WHERE min_temp IS NOT NULL AND max_temp IS NOT NULL AND rainfall IS NOT NULL"


def _w(n):
    return f"(PARTITION BY station_id ORDER BY date RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)"


def rolled(src: str, days=(3, 7, 14)) -> str:
    cols = ", ".join(
        f"CASE WHEN count(*) OVER {_w(n)} >= {n} AND count(rainfall) OVER {_w(n)} >= {n * 0.8} THEN sum(rainfall) OVER {_w(n)} END AS total_{n}d"
        for n in days)
    return f"SELECT *, {cols} FROM {src}"


_STAGED = f"SELECT *, {STAGE} AS stage FROM ({rolled('complete')})"


def _ev(kind, severity, value, threshold, stage, q, cond, window="NULL", role="NULL", crop="NULL", mult="NULL", flower="NULL", since="NULL"):
    return (f"SELECT station_id, date, '{kind}' AS event_type, {severity} AS severity, CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold, "
            f"{stage} AS crop_stage, {conf(q)} AS confidence, {q} AS data_quality, CAST({window} AS INT) AS accumulation_window, CAST({role} AS VARCHAR) AS rainfall_role, "
            f"CAST({crop} AS VARCHAR) AS crop_type, CAST({mult} AS DOUBLE) AS phenology_risk_multiplier, CAST({flower} AS BOOLEAN) AS flowering_window_active, "
            f"CAST({since} AS INT) AS days_since_flowering_start FROM staged WHERE {cond}")


_FS = FROST_SEVERITY.format(t="min_temp", s="stage")
_LIGHT = FROST_LIGHT.format(s="stage")
_MULT = ("greatest(0.1::DOUBLE, least(3::DOUBLE, CASE stage WHEN 'flowering' THEN 2.5 WHEN 'grain_fill' THEN 2.0 ELSE 1.0 END::DOUBLE"
         " * CASE WHEN month(date) IN (9, 10) THEN 1.3 ELSE 1 END::DOUBLE * CASE WHEN month(date) = 9 AND day(date) <= 8 THEN 1.2 ELSE 1 END::DOUBLE))")
_SINCE = f"CASE WHEN date >= make_date({SEASON}, 9, 1) THEN CAST(date - make_date({SEASON}, 9, 1) AS INT) END"
FROST = _ev("frost", _FS, "min_temp", f"CASE ({_FS}) WHEN 'severe' THEN {_LIGHT} - 4 WHEN 'moderate' THEN {_LIGHT} - 2 ELSE {_LIGHT} END", "stage",
            "min_temp_quality", f"stage IN ('tillering', 'flowering', 'grain_fill') AND ({_FS}) IS NOT NULL",
            mult=_MULT, flower="month(date) IN (9, 10)", since=_SINCE)
HEAT = _ev("heat", "CASE WHEN max_temp >= 35 THEN 'severe' ELSE 'stress' END", "max_temp", "CASE WHEN max_temp >= 35 THEN 35 ELSE 32 END", "stage",
           "max_temp_quality", "stage = 'grain_fill' AND max_temp >= 32")
HARVEST = " UNION ALL ".join([
    _ev("rainfall", "'moderate'", "rainfall", "10", "'harvest'", "rainfall_quality", "stage = 'harvest' AND rainfall >= 10", "1"),
    _ev("rainfall", "'high'", "total_3d", "15", "'harvest'", "rainfall_quality", "stage = 'harvest' AND total_3d >= 15", "3")])
_CROPS = (("canola", "3, 4", 15, 10, 7), ("wheat_barley", "4, 5", 25, 15, 10), ("lupins", "4, 5, 6", 20, 12, 8))
SEEDING = " UNION ALL ".join(
    _ev("seeding_rain", f"CASE WHEN total_7d >= {a} THEN 'adequate' WHEN total_7d >= {m} THEN 'marginal' WHEN total_7d >= {lo} THEN 'marginal_low' ELSE 'inadequate' END",
        "total_7d", f"CASE WHEN total_7d >= {a} THEN {a} WHEN total_7d >= {m} THEN {m} ELSE {lo} END", "'seeding'", "rainfall_quality",
        f"month(date) IN ({months}) AND (total_7d >= {lo} OR (month(date) >= 5 AND total_7d < {lo}))", "7", "'beneficial'", f"'{c}'")
    for c, months, a, m, lo in _CROPS)
DEVELOPMENT = " UNION ALL ".join(
    _ev("development_rain", f"'{s}'", f"total_{n}d", str(t), "stage", "rainfall_quality", f"month(date) IN (7, 8, 9, 10) AND total_{n}d < {t}", str(n), "'beneficial'")
    for n, t, s in ((7, 5, "dry_spell"), (14, 10, "moisture_stress")))
BASE = (("complete", COMPLETE), ("staged", _STAGED))
EVENTS = BASE + (("ev", " UNION ALL ".join([FROST, HEAT, HARVEST, SEEDING, DEVELOPMENT])),)


def events(spark, sf):
    return E.detect_events(B.dense_obs_df(spark, sf))


def _station_names(spark, sf):
    return B.regions_df(spark, sf).select(S.zfill("n_nationkey", 6).alias("station_id"), "sa2_name", "sa3_name", "sa4_name", "state_name", "sa2_5")


NAMES = ("names", "SELECT lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS station_id, sa2_name, sa3_name, sa4_name, state_name, sa2_5 FROM regions")

# --- series ------------------------------------------------------------------------------


@query("e1_rolling_totals_3_7_14", f"SELECT station_id, date, total_3d, total_7d, total_14d FROM ({rolled('dense_obs')})", ("dense_obs",))
def _(spark, sf):
    return TS.rolling_totals(B.dense_obs_df(spark, sf)).select("station_id", "date", "total_3d", "total_7d", "total_14d")


@query("e1_rolling_total_station", f"SELECT station_id, date, total_3d FROM ({rolled('obs', (3,))})", ("obs",))
def _(spark, sf):
    return TS.rolling_totals(B.obs_df(spark, sf), (3,)).select("station_id", "date", "total_3d")


@query("e2_trailing_windows", f"""
    SELECT station_id, date, sum(rainfall) OVER {_w(7)} AS any7, CASE WHEN count(rainfall) OVER {_w(14)} >= 14 THEN sum(rainfall) OVER {_w(14)} END AS full14
    FROM dense_obs""", ("dense_obs",))
def _(spark, sf):
    o = B.dense_obs_df(spark, sf).select("station_id", "date", "rainfall")
    o = TS.rolling_totals(o, (7,), min_periods=1).withColumnRenamed("total_7d", "any7")
    return TS.rolling_totals(o, (14,), min_periods=14).select("station_id", "date", "any7", F.col("total_14d").alias("full14"))


_SLICE = """SELECT station_id, date, year(date) AS y, month(date) AS m, rainfall,
    sum(rainfall) FILTER (month(date) BETWEEN 4 AND 6) OVER w7 AS sow7,
    sum(rainfall) FILTER (month(date) BETWEEN 4 AND 10) OVER w7 AS s7, count(rainfall) FILTER (month(date) BETWEEN 4 AND 10) OVER w7 AS c7,
    sum(rainfall) FILTER (month(date) BETWEEN 4 AND 10) OVER w14 AS s14, count(rainfall) FILTER (month(date) BETWEEN 4 AND 10) OVER w14 AS c14
  FROM {src} WINDOW w7 AS (PARTITION BY station_id, year(date) ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
       w14 AS (PARTITION BY station_id, year(date) ORDER BY date RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND CURRENT ROW)"""
_BREAK = """SELECT station_id, CAST(y AS INT) AS season_year,
    min(date) FILTER (m BETWEEN 4 AND 6 AND (rainfall >= 10 OR sow7 >= 25)) AS autumn_break_date,
    arg_min(sow7, date) FILTER (m BETWEEN 4 AND 6 AND (rainfall >= 10 OR sow7 >= 25)) AS autumn_break_7d_mm,
    CASE WHEN count(rainfall) FILTER (m BETWEEN 4 AND 10) > 0 THEN CAST(count(*) FILTER (m BETWEEN 4 AND 10 AND c7 >= 7 AND s7 < 5) AS DOUBLE) END AS dry_spell_days_7d_lt_5mm,
    CASE WHEN count(rainfall) FILTER (m BETWEEN 4 AND 10) > 0 THEN CAST(count(*) FILTER (m BETWEEN 4 AND 10 AND c14 >= 14 AND s14 < 10) AS DOUBLE) END AS dry_spell_days_14d_lt_10mm
  FROM ({src}) GROUP BY 1, 2"""
_STATUS = """coalesce(CASE WHEN autumn_break_date < make_date(season_year, 5, 15) THEN 'early' WHEN autumn_break_date <= make_date(season_year, 6, 15) THEN 'on_time'
    WHEN autumn_break_date IS NOT NULL THEN 'late' END, 'absent')"""


def break_sql(src: str) -> str:
    return _BREAK.format(src=_SLICE.format(src=src))


@query("e3_autumn_break", f"SELECT station_id, season_year, autumn_break_date, autumn_break_7d_mm, {_STATUS} AS autumn_break_status FROM ({break_sql('dense_obs')})", ("dense_obs",))
def _(spark, sf):
    return TS.autumn_break(B.dense_obs_df(spark, sf))


@query("e4_dry_spell_days", f"SELECT station_id, season_year, dry_spell_days_7d_lt_5mm, dry_spell_days_14d_lt_10mm FROM ({break_sql('dense_obs')})", ("dense_obs",))
def _(spark, sf):
    return TS.dry_spell_days(B.dense_obs_df(spark, sf))


_RUNS = """SELECT *, row_number() OVER (PARTITION BY station_id, run ORDER BY date) AS run_position, count(*) OVER (PARTITION BY station_id, run) AS run_length
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY station_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS run
        FROM (SELECT *, CASE WHEN date - lag(date) OVER (PARTITION BY station_id ORDER BY date) = 1 THEN 0 ELSE 1 END AS fresh FROM {src}))"""


@query("e5_consecutive_runs", f"""
    SELECT station_id, date, CAST(run_position AS INT) AS run_position, run_length, CASE WHEN run_length > 1 THEN station_id || '_seq_' || CAST(run AS BIGINT) END AS sequence_id
    FROM ({_RUNS.format(src="(SELECT station_id, date FROM obs WHERE min_temp <= 2)")})""", ("obs",))
def _(spark, sf):
    cold = B.obs_df(spark, sf).where("min_temp <= 2").select("station_id", "date")
    return TS.consecutive_runs(cold)


@query("e6_date_gaps", """
    SELECT station_id, prev AS gap_start, date AS gap_end, CAST(date - prev - 1 AS INT) AS gap_days
    FROM (SELECT station_id, date, lag(date) OVER (PARTITION BY station_id ORDER BY date) AS prev FROM obs) WHERE date - prev > 1""", ("obs",))
def _(spark, sf):
    return TS.date_gaps(B.obs_df(spark, sf))


# --- events ------------------------------------------------------------------------------

RUN_EVENTS = EVENTS + (("runs", _RUNS.format(src=f"({FROST})")), ("numbered", """SELECT ev.*, CAST(r.run_position AS INT) AS consecutive_night,
    CASE WHEN r.run_length > 1 THEN r.station_id || '_seq_' || CAST(r.run AS BIGINT) END AS sequence_id, '2026-01-01 06:00:00' AS detected_at
  FROM ev LEFT JOIN runs r ON ev.event_type = 'frost' AND ev.station_id = r.station_id AND ev.date = r.date"""))


def _stamped(ev):
    return ev.withColumn("detected_at", F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss"))


@query("i1_detect_events", "SELECT * FROM numbered", ("dense_obs",), ("phenology_risk_multiplier",), RUN_EVENTS)
def _(spark, sf):
    return _stamped(E.detect_events(B.dense_obs_df(spark, sf), detected_at="2026-01-01 06:00:00"))


@query("i1_detect_events_range", "SELECT * FROM numbered WHERE date BETWEEN DATE '1998-08-03' AND DATE '1999-02-28'", ("dense_obs",), ("phenology_risk_multiplier",), RUN_EVENTS)
def _(spark, sf):
    return _stamped(E.detect_events(B.dense_obs_df(spark, sf), "1998-08-03", "1999-02-28", detected_at="2026-01-01 06:00:00"))


@query("i1_frost_runs", f"""
    SELECT station_id, date, severity, CAST(run_position AS INT) AS run_position, run_length, CASE WHEN run_length > 1 THEN station_id || '_seq_' || CAST(run AS BIGINT) END AS sequence_id
    FROM ({_RUNS.format(src='frost')})""", ("dense_obs",), (), BASE + (("frost", FROST),))
def _(spark, sf):
    return E.frost_events(E.complete_rows(B.dense_obs_df(spark, sf))).select("station_id", "date", "severity", "run_position", "run_length", "sequence_id")


_COLS = "station_id, date, event_type, severity, value, threshold, crop_stage, confidence, data_quality, accumulation_window, crop_type"


@query("i2_seeding_events", f"SELECT {_COLS} FROM ({SEEDING})", ("dense_obs",), (), BASE)
def _(spark, sf):
    return E.seeding_events(B.dense_obs_df(spark, sf)).select(*_COLS.split(", "))


@query("i3_development_events", f"SELECT {_COLS} FROM ({DEVELOPMENT})", ("dense_obs",), (), BASE)
def _(spark, sf):
    return E.development_events(B.dense_obs_df(spark, sf)).select(*_COLS.split(", "))


@query("i4_harvest_rain_events", f"SELECT {_COLS} FROM ({HARVEST})", ("dense_obs",), (), BASE)
def _(spark, sf):
    return E.harvest_rain_events(B.dense_obs_df(spark, sf)).select(*_COLS.split(", "))


_FLAT = f"""SELECT station_id, date, 'frost' AS event_type, CASE WHEN min_temp < -2 THEN 'severe' WHEN min_temp < 0 THEN 'moderate' ELSE 'light' END AS severity, min_temp AS value,
    CASE WHEN min_temp < -2 THEN -2 WHEN min_temp < 0 THEN 0 ELSE 2 END::DOUBLE AS threshold, {conf('min_temp_quality')} AS confidence, min_temp_quality AS data_quality FROM obs WHERE min_temp <= 2
  UNION ALL SELECT station_id, date, 'heat', CASE WHEN max_temp > 35 THEN 'very_hot' ELSE 'hot' END, max_temp, CASE WHEN max_temp > 35 THEN 35 ELSE 32 END::DOUBLE,
    {conf('max_temp_quality')}, max_temp_quality FROM obs WHERE max_temp > 32"""


@query("i1_flat_threshold_events", _FLAT, ("obs",))
def _(spark, sf):
    return E.flat_threshold_events(B.obs_df(spark, sf))


@query("g1_union_sparse", f"""
    SELECT station_id, date, event_type, severity, crop_type, phenology_risk_multiplier FROM ({FROST})
    UNION ALL SELECT station_id, date, event_type, severity, crop_type, NULL FROM ({SEEDING})""", ("dense_obs",), ("phenology_risk_multiplier",), BASE)
def _(spark, sf):
    o = B.dense_obs_df(spark, sf)
    frost = E.frost_events(E.complete_rows(o)).select("station_id", "date", "event_type", "severity", "phenology_risk_multiplier")
    seed = E.seeding_events(o).select("station_id", "date", "event_type", "severity", "crop_type")
    return sets.union_sparse(frost, seed)


@query("g4_keep_first", """
    SELECT l_suppkey, day, l_orderkey, l_linenumber FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber,
      row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE) ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber")
    return sets.keep_last(li, ["l_suppkey", "day"], [F.asc("l_orderkey"), F.asc("l_linenumber")])


# --- aggregates and quality --------------------------------------------------------------

@query("d1_daily_summary", """
    SELECT date, count(*) AS n_stations, avg(min_temp) AS avg_min_temp, avg(max_temp) AS avg_max_temp, avg(rainfall) AS avg_rainfall, min(min_temp) AS lowest_temp,
           max(max_temp) AS highest_temp, max(rainfall) AS max_rainfall, count(*) FILTER (min_temp < 2) AS frost_count, count(*) FILTER (max_temp > 32) AS heat_count,
           count(*) FILTER (rainfall > 10) AS rain_count FROM obs GROUP BY 1""", ("obs",), ("avg_min_temp", "avg_max_temp", "avg_rainfall"))
def _(spark, sf):
    return A.daily_summary(B.obs_df(spark, sf))


@query("d2_coverage_summary", """
    SELECT date, count(*) AS n_stations, count(min_temp) AS min_temp_count, count(min_temp) * 100.0 / count(*) AS min_temp_pct, count(max_temp) AS max_temp_count,
           count(max_temp) * 100.0 / count(*) AS max_temp_pct, count(rainfall) AS rainfall_count, count(rainfall) * 100.0 / count(*) AS rainfall_pct
    FROM obs WHERE date >= DATE '2000-01-01' GROUP BY 1""", ("obs",), ("min_temp_pct", "max_temp_pct", "rainfall_pct"))
def _(spark, sf):
    return A.coverage_summary(B.obs_df(spark, sf), "2000-01-01")


@query("d3_station_monthly", """
    SELECT station_id, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, sum(rainfall) AS monthly_total_mm, count(*) AS day_count
    FROM obs WHERE rainfall IS NOT NULL GROUP BY 1, 2, 3""", ("obs",))
def _(spark, sf):
    return A.station_monthly(B.obs_df(spark, sf))


@query("d4_region_monthly_mean", """
    SELECT sa2_code, sa2_name, year, month, avg(monthly_total_mm) AS rainfall_mm, count(*) AS station_count, year = 2001 AND month = 11 AS is_partial_month,
           CASE WHEN year = 2001 AND month = 11 THEN 'partial_month' ELSE 'ok' END AS quality_flag
    FROM (SELECT station_id, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, sum(rainfall) AS monthly_total_mm FROM obs WHERE rainfall IS NOT NULL GROUP BY 1, 2, 3)
    JOIN stations USING (station_id) GROUP BY 1, 2, 3, 4""", ("obs", "stations"), ("rainfall_mm",))
def _(spark, sf):
    st = B.stations_df(spark, sf).select("station_id", "sa2_code", "sa2_name")
    return A.region_monthly_mean(A.station_monthly(B.obs_df(spark, sf)), st, 2001, 11)


def _ratio_sql(v):
    q = f"{v}_quality"
    c = lambda cond: f"count(*) FILTER ({cond}) / count(*)::DOUBLE"
    return (f"{c(q + ' = 0')} AS {v}_observed_ratio, {c(q + ' IN (15, 23, 25, 75)')} AS {v}_interpolated_ratio, {c(q + ' = 35')} AS {v}_synthetic_ratio, "
            f"{c(q + ' = 999')} AS {v}_missing_ratio, {c(q + ' = 0')} + {c(q + ' IN (15, 23, 25, 75)')} AS {v}_completeness")


RATIOS = ("ratios", "SELECT station_id, count(*) AS record_count, " + ", ".join(_ratio_sql(v) for v in A.MEASURES) + " FROM obs GROUP BY 1")
_RCOLS = tuple(f"{v}_{k}" for v in A.MEASURES for k in ("observed_ratio", "interpolated_ratio", "synthetic_ratio", "missing_ratio", "completeness"))


def _score(v, w):
    return (f"{v}_completeness * CASE WHEN {v}_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END::DOUBLE * CASE WHEN {v}_interpolated_ratio > 0.8 THEN 0.3 ELSE 1 END::DOUBLE "
            f"* CASE WHEN {v}_observed_ratio < 0.3 THEN 0.5 ELSE 1 END::DOUBLE * {w}")


_SCORE = "least(1, (" + " + ".join(_score(v, P.VARIABLE_WEIGHTS[v]) for v in A.MEASURES) + "))"
_ISSUES = ("list_filter([" + ", ".join(
    f"CASE WHEN {v}_completeness < 0.8 THEN 'low_completeness_{v}' END, CASE WHEN {v}_synthetic_ratio > 0.2 THEN 'high_synthetic_{v}' END, "
    f"CASE WHEN {v}_interpolated_ratio > 0.8 THEN 'high_interpolation_{v}' END, CASE WHEN {v}_observed_ratio < 0.3 THEN 'low_observed_data_{v}' END"
    for v in A.MEASURES) + "], lambda x: x IS NOT NULL)")
SCORED = (RATIOS, ("scored", f"SELECT *, {_SCORE} AS confidence_score, {_ISSUES} AS issues FROM ratios"))


@query("d12_quality_ratios", "SELECT * FROM ratios", ("obs",), _RCOLS, (RATIOS,))
def _(spark, sf):
    return A.quality_ratios(B.obs_df(spark, sf))


@query("d13_confidence_score", """
    SELECT station_id, confidence_score, CASE WHEN confidence_score >= 0.8 THEN 'high' WHEN confidence_score >= 0.5 THEN 'medium' ELSE 'poor' END AS overall_quality,
           array_to_string(issues, ',') AS issues FROM scored""", ("obs",), ("confidence_score",), SCORED)
def _(spark, sf):
    s = A.confidence_score(A.quality_ratios(B.obs_df(spark, sf)))
    return s.select("station_id", "confidence_score", "overall_quality", F.array_join("issues", ",").alias("issues"))


@query("d14_auto_exclude", "SELECT station_id, count(*) AS n FROM obs WHERE station_id IN (SELECT station_id FROM scored WHERE confidence_score >= 0.8) GROUP BY 1", ("obs",), (), SCORED)
def _(spark, sf):
    return Q.auto_exclude(B.obs_df(spark, sf), 0.8).groupBy("station_id").agg(F.count(F.lit(1)).alias("n"))


@query("d15_quality_score", f"""
    SELECT station_id, CAST(year(date) AS INT) AS year, avg(CASE WHEN rainfall_quality IS NULL THEN 0 ELSE {conf('rainfall_quality')} END) AS data_quality_score
    FROM obs GROUP BY 1, 2""", ("obs",), ("data_quality_score",))
def _(spark, sf):
    return A.quality_score(B.obs_df(spark, sf).withColumn("year", F.year("date")), ["station_id", "year"])


@query("i5_quality_report", """
    SELECT s.station_id, record_count, confidence_score, first_date, last_date, coalesce(n_gaps, 0) AS n_gaps, CAST(coalesce(missing_days, 0) AS BIGINT) AS missing_days,
           array_to_string(CASE WHEN n_gaps > 0 THEN list_append(issues, 'date_gaps') ELSE issues END, ',') AS issues
    FROM scored s JOIN (SELECT station_id, min(date) AS first_date, max(date) AS last_date FROM obs GROUP BY 1) r USING (station_id)
    LEFT JOIN (SELECT station_id, count(*) AS n_gaps, sum(gap) AS missing_days FROM (SELECT station_id, date - lag(date) OVER (PARTITION BY station_id ORDER BY date) - 1 AS gap FROM obs)
               WHERE gap > 0 GROUP BY 1) g USING (station_id)""", ("obs",), ("confidence_score",), SCORED)
def _(spark, sf):
    r = Q.quality_report(B.obs_df(spark, sf))
    return r.select("station_id", "record_count", "confidence_score", "first_date", "last_date", "n_gaps", "missing_days", F.array_join("issues", ",").alias("issues"))


# --- digest tables -----------------------------------------------------------------------

_TYPES = ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}_events" for t in D.EVENT_TYPES)


@query("d31_daily_event_counts", f"SELECT date, count(*) AS total_events, {_TYPES}, count(DISTINCT station_id) AS stations_affected FROM ev GROUP BY 1", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.daily_counts(events(spark, sf))


@query("d31_season_event_counts", """
    SELECT season, event_type, n_events, n_stations, n_in_flowering, n_events * 100.0 / sum(n_events) OVER (PARTITION BY season) AS share_pct
    FROM (SELECT CAST(year(date) AS INT) AS season, event_type, count(*) AS n_events, count(DISTINCT station_id) AS n_stations, count(*) FILTER (flowering_window_active) AS n_in_flowering
          FROM ev GROUP BY 1, 2)""", ("dense_obs",), ("share_pct",), EVENTS)
def _(spark, sf):
    return D.season_counts(events(spark, sf))


@query("d31_severity_split", "SELECT event_type, severity, count(*) AS n_events, count(DISTINCT station_id) AS n_stations, avg(value) AS avg_value FROM ev GROUP BY 1, 2", ("dense_obs",), ("avg_value",), EVENTS)
def _(spark, sf):
    return D.severity_split(events(spark, sf))


@query("d31_region_severity", """
    SELECT state_name, sa2_name, event_type, severity, count(*) AS n_events, count(DISTINCT station_id) AS n_stations, avg(confidence) AS avg_confidence
    FROM ev LEFT JOIN names USING (station_id) GROUP BY 1, 2, 3, 4""", ("dense_obs", "regions"), ("avg_confidence",), EVENTS + (NAMES,))
def _(spark, sf):
    return D.region_severity(events(spark, sf), _station_names(spark, sf))


@query("d32_monthly_event_matrix", "SELECT CAST(month(date) AS INT) AS month, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in D.EVENT_TYPES)
       + ", count(*) AS total FROM ev WHERE year(date) = 1998 GROUP BY ROLLUP (CAST(month(date) AS INT))", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.monthly_matrix(E.detect_events(B.dense_obs_df(spark, sf), "1998-01-01", "1998-12-31"), 1998)


@query("d33_peak_events", """
    SELECT event_type, station_id, date, severity, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type
      ORDER BY CASE WHEN event_type = 'frost' THEN value ELSE -value END, station_id, date) AS rn FROM ev WHERE event_type IN ('frost', 'heat', 'rainfall')) WHERE rn = 1""",
       ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.peak_events(events(spark, sf))


@query("d33_most_stressed_station", """
    SELECT station_id, count(*) AS n_events FROM ev WHERE event_type = 'development_rain' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.most_stressed_station(events(spark, sf))


@query("d34_seeding_region_summary", """
    SELECT crop_type, sa2_name, arg_min(severity, CASE severity WHEN 'adequate' THEN 0 WHEN 'marginal' THEN 1 WHEN 'marginal_low' THEN 2 ELSE 3 END) AS best_severity,
           max(value) AS max_value, count(DISTINCT station_id) AS n_stations FROM ev JOIN names USING (station_id) WHERE event_type = 'seeding_rain' GROUP BY 1, 2""",
       ("dense_obs", "regions"), (), EVENTS + (NAMES,))
def _(spark, sf):
    return D.seeding_regions(events(spark, sf).join(_station_names(spark, sf), "station_id"))


_DRYS = "event_type = 'seeding_rain' AND severity = 'inadequate'"
_DRYD = "event_type = 'development_rain' AND severity IN ('dry_spell', 'moisture_stress')"


@query("d35_moisture_status", f"""
    SELECT date, a AS seeding_dry_stations, b AS seeding_adequate, c AS development_dry_stations, h AS harvest_events,
           CASE WHEN m < 4 THEN 'Pre-season' WHEN m > 6 THEN 'Complete' WHEN s = 0 THEN 'No data' WHEN a > 0 THEN 'DRY SPELL' WHEN b > 0 THEN 'Adequate' ELSE 'Monitoring' END AS seeding_status,
           CASE WHEN m < 7 THEN 'Pre-season' WHEN m > 10 THEN 'Complete' WHEN d = 0 THEN 'No data' WHEN c > 0 THEN 'DRY SPELL' ELSE 'Monitoring' END AS development_status,
           CASE WHEN m IN (11, 12, 1) THEN 'Active' WHEN m < 11 THEN 'Pre-season' ELSE 'Complete' END AS harvest_status
    FROM (SELECT date, month(date) AS m, count(DISTINCT station_id) FILTER ({_DRYS}) AS a, count(*) FILTER (event_type = 'seeding_rain' AND severity = 'adequate') AS b,
                 count(*) FILTER (event_type = 'seeding_rain') AS s, count(DISTINCT station_id) FILTER ({_DRYD}) AS c, count(*) FILTER (event_type = 'development_rain') AS d,
                 count(*) FILTER (event_type = 'rainfall') AS h FROM ev GROUP BY date)""", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.moisture_status(events(spark, sf))


@query("d35_stressed_stations", f"""
    SELECT date, station_id, value, accumulation_window, CAST(rank AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY date ORDER BY station_id) AS rank FROM (
        SELECT date, station_id, min(value) AS value, arg_min(accumulation_window, value * 1000 + accumulation_window) AS accumulation_window
        FROM ev WHERE ({_DRYS}) OR ({_DRYD}) GROUP BY 1, 2)) WHERE rank <= 5""", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.stressed_stations(events(spark, sf))


@query("d36_event_quality", """
    SELECT event_type, count(*) AS n_events, avg(CASE WHEN confidence >= 0.9 THEN 1.0 ELSE 0 END) AS high_confidence_share,
           avg(CASE WHEN data_quality = 0 THEN 1.0 ELSE 0 END) AS perfect_quality_share, max(data_quality) AS worst_code FROM ev GROUP BY 1""", ("dense_obs",),
       ("high_confidence_share", "perfect_quality_share"), EVENTS)
def _(spark, sf):
    return D.event_quality(events(spark, sf))


@query("f1_top_stations", "SELECT station_id, count(*) AS n_events FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    return D.top_stations(events(spark, sf))


@query("f9_business_order", """
    SELECT state_name, n, CASE state_name WHEN 'EUROPE' THEN 0 WHEN 'ASIA' THEN 1 WHEN 'AFRICA' THEN 2 ELSE 3 END AS sort_order
    FROM (SELECT state_name, count(*) AS n FROM stations GROUP BY 1)""", ("stations",))
def _(spark, sf):
    s = B.stations_df(spark, sf).groupBy("state_name").agg(F.count(F.lit(1)).alias("n"))
    return business_order(s, "state_name", ("EUROPE", "ASIA", "AFRICA"))


@query("f10_capped_points", "SELECT point_id, lat, lon FROM points ORDER BY lat, lon, point_id LIMIT 50", ("points",))
def _(spark, sf):
    return first_n(B.points_df(spark, sf), ["lat", "lon", "point_id"], 50)


@query("i20_daily_digest", f"""
    SELECT date, state_name, count(*) AS total_events, {_TYPES}, count(DISTINCT station_id) AS stations_affected, max(value) FILTER (event_type = 'rainfall') AS wettest
    FROM ev JOIN names USING (station_id) GROUP BY 1, 2""", ("dense_obs", "regions"), (), EVENTS + (NAMES,))
def _(spark, sf):
    return D.daily_digest(events(spark, sf), _station_names(spark, sf))


_SEASON = ("sev", "SELECT *, CAST(month(date) AS INT) AS month FROM ev WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")


@query("i20_season_summary", """
    SELECT 'month' AS section, NULL::INT AS rank, month, event_type, NULL::VARCHAR AS station_id, NULL::DATE AS date, NULL::VARCHAR AS severity, NULL::DOUBLE AS value, count(*) AS n_events FROM sev GROUP BY CUBE (month, event_type)
    UNION ALL SELECT 'peak', NULL, NULL, event_type, station_id, date, severity, value, NULL FROM (SELECT *, row_number() OVER (PARTITION BY event_type
      ORDER BY CASE WHEN event_type = 'frost' THEN value ELSE -value END, station_id, date) AS rn FROM sev WHERE event_type IN ('frost', 'heat', 'rainfall')) WHERE rn = 1
    UNION ALL SELECT * FROM (SELECT 'stressed', NULL, NULL, NULL, station_id, NULL, NULL, NULL, count(*) FROM sev WHERE event_type = 'development_rain' GROUP BY station_id ORDER BY count(*) DESC, station_id LIMIT 1)
    UNION ALL SELECT 'top', CAST(rank AS INT), NULL, NULL, station_id, NULL, NULL, NULL, n FROM (
      SELECT station_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, station_id) AS rank FROM sev GROUP BY station_id) WHERE rank <= 5""",
       ("dense_obs",), (), EVENTS + (_SEASON,))
def _(spark, sf):
    return D.season_summary(E.detect_events(B.dense_obs_df(spark, sf), "1998-01-01", "1998-12-31"), 1998)


@query("f2_top_events_per_state", """
    SELECT state_name, station_id, n_events, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY state_name ORDER BY n_events DESC, station_id) AS rank
      FROM (SELECT state_name, station_id, count(*) AS n_events FROM ev JOIN names USING (station_id) GROUP BY 1, 2)) WHERE rank <= 3""",
       ("dense_obs", "regions"), (), EVENTS + (NAMES,))
def _(spark, sf):
    n = events(spark, sf).join(_station_names(spark, sf), "station_id").groupBy("state_name", "station_id").agg(F.count(F.lit(1)).alias("n_events"))
    return top_k(n, ["state_name"], [F.desc("n_events"), F.asc("station_id")], 3)
