"""Queries over the expression library and the SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from furrow.functions import scalar as S
from furrow.functions import sql as Q
from furrow.operators import ranking, spatial
from furrow.plans import events as E
from furrow.plans import quality, regions, sowing
from furrow.operators.topk import seeded_sample
from furrow.workload import bind as B
from furrow.workload.registry import query

_CONF = ("CASE {c} WHEN 0 THEN 1.0::DOUBLE WHEN 15 THEN 0.8 WHEN 25 THEN 0.7 WHEN 35 THEN 0.3 WHEN 75 THEN 0.6 "
         "WHEN 999 THEN 0.0 ELSE 0.5 END")


def conf(c: str) -> str:
    return _CONF.format(c=c)


SEASON = "(CAST(year(date) AS INT) - CASE WHEN month(date) < 5 THEN 1 ELSE 0 END)"
DATE_STAGE = (
    "CASE WHEN month(date) < 5 THEN 'post_harvest' WHEN date <= make_date(year(date), 7, 31) THEN 'planting' "
    "WHEN date <= make_date(year(date), 9, 1) THEN 'vegetative' WHEN date <= make_date(year(date), 10, 31) THEN 'flowering' "
    "WHEN date <= make_date(year(date), 11, 1) THEN 'grain_filling' ELSE 'harvest' END")
STAGE = (
    "CASE WHEN month(date) < 5 THEN 'maturity' WHEN date <= make_date(year(date), 7, 31) THEN 'planting' "
    "WHEN date <= make_date(year(date), 9, 1) THEN 'tillering' WHEN date <= make_date(year(date), 10, 31) THEN 'flowering' "
    "WHEN date <= make_date(year(date), 11, 1) THEN 'grain_fill' ELSE 'harvest' END")
FROST_LIGHT = "CASE {s} WHEN 'flowering' THEN 1.0 WHEN 'grain_fill' THEN 0.0 ELSE 2.0 END::DOUBLE"
FROST_SEVERITY = ("CASE WHEN {t} <= " + FROST_LIGHT + " - 4 THEN 'severe' WHEN {t} <= " + FROST_LIGHT +
                  " - 2 THEN 'moderate' WHEN {t} <= " + FROST_LIGHT + " THEN 'light' END")


@query("b1_norm_station_id", """
    SELECT c_custkey AS k, CASE WHEN raw LIKE 'DD!_%' ESCAPE '!' THEN raw WHEN length(raw) < 6 THEN lpad(raw, 6, '0') ELSE raw END AS station_id
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'DD_' || c_custkey || '_1' WHEN c_custkey % 7 = 0 THEN '9000000' || c_custkey
          ELSE CAST(c_custkey AS VARCHAR) END AS raw FROM customer)""")
def _(spark, sf):
    k = F.col("c_custkey")
    raw = F.when(k % 5 == 0, F.concat(F.lit("DD_"), k.cast("string"), F.lit("_1"))).when(
        k % 7 == 0, F.concat(F.lit("9000000"), k.cast("string"))).otherwise(k.cast("string"))
    return B.table(spark, sf, "customer").select(k.alias("k"), S.norm_station_id(raw).alias("station_id"))


@query("b2_norm_region_code", """
    SELECT c_custkey AS k, coalesce(CAST(CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS BIGINT) AS VARCHAR), '') AS code
    FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey || '.0' WHEN 1 THEN ' ' || c_custkey WHEN 2 THEN 'x' || c_custkey END AS raw FROM customer)""")
def _(spark, sf):
    k = F.col("c_custkey").cast("string")
    m = F.col("c_custkey") % 4
    raw = F.when(m == 0, F.concat(k, F.lit(".0"))).when(m == 1, F.concat(F.lit(" "), k)).when(m == 2, F.concat(F.lit("x"), k))
    return B.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), S.norm_region_code(raw).alias("code"))


@query("b3_code9_to_5", "SELECT station_id, left(sa2_code, 1) || right(sa2_code, 4) AS code5 FROM stations", ("stations",))
def _(spark, sf):
    return B.stations_df(spark, sf).select("station_id", S.code9_to_5("sa2_code").alias("code5"))


@query("b4_parse_point_id", """
    SELECT c_custkey AS k, CASE WHEN c_custkey % 6 <> 0 THEN CAST(-c_custkey % 40 AS DOUBLE) END AS lat,
           CASE WHEN c_custkey % 6 <> 0 AND c_custkey % 9 <> 1 THEN CAST(c_custkey % 150 AS DOUBLE) + 0.5 END AS lon FROM customer""")
def _(spark, sf):
    k = F.col("c_custkey")
    lon = F.when(k % 9 == 1, F.lit("bad")).otherwise(F.concat((k % 150).cast("string"), F.lit(".5")))
    raw = F.when(k % 6 == 0, k.cast("string")).otherwise(F.concat(F.lit("DD_"), (-k % 40).cast("string"), F.lit("_"), lon))
    return B.table(spark, sf, "customer").select(k.alias("k"), (S.point_lat(raw) + 0.0).alias("lat"), S.point_lon(raw).alias("lon"))


@query("b5_frost_severity", f"""
    SELECT station_id, date, {STAGE} AS stage, {FROST_SEVERITY.format(t='min_temp', s='(' + STAGE + ')')} AS severity
    FROM obs""", ("obs",))
def _(spark, sf):
    o = B.obs_df(spark, sf).withColumn("stage", S.crop_stage("date"))
    return o.select("station_id", "date", "stage", S.frost_severity("min_temp", "stage").alias("severity"))


@query("b6_flat_severities", """
    SELECT station_id, date, CASE WHEN min_temp < -2 THEN 'severe' WHEN min_temp < 0 THEN 'moderate' WHEN min_temp <= 2 THEN 'light' END AS frost,
           CASE WHEN max_temp > 35 THEN 'very_hot' WHEN max_temp > 32 THEN 'hot' END AS heat FROM obs""", ("obs",))
def _(spark, sf):
    return B.obs_df(spark, sf).select("station_id", "date", S.frost_severity_flat("min_temp").alias("frost"),
                                      S.heat_severity_flat("max_temp").alias("heat"))


@query("b7_heat_severity", f"""
    SELECT station_id, date, CASE WHEN max_temp >= 35 THEN 'severe' ELSE 'stress' END AS severity
    FROM obs WHERE ({STAGE}) = 'grain_fill' AND max_temp >= 32""", ("obs",))
def _(spark, sf):
    o = E.with_stage(B.obs_df(spark, sf)).where("heat_critical")
    return o.select("station_id", "date", S.heat_severity("max_temp").alias("severity")).where("severity is not null")


@query("b8_quality_confidence", f"SELECT station_id, date, {conf('rainfall_quality')} AS confidence FROM obs", ("obs",))
def _(spark, sf):
    return B.obs_df(spark, sf).select("station_id", "date", S.quality_confidence("rainfall_quality").alias("confidence"))


@query("b9_quality_filter", """
    SELECT station_id, date, CASE WHEN min_temp_quality IN (999, 35) THEN NULL ELSE min_temp END AS min_temp,
           CASE WHEN max_temp_quality IN (999, 35) THEN NULL ELSE max_temp END AS max_temp,
           CASE WHEN rainfall_quality IN (999, 35) THEN NULL ELSE rainfall END AS rainfall,
           CASE WHEN rainfall_quality IN (999, 35, 15, 25, 75) THEN NULL ELSE rainfall END AS rainfall_observed FROM obs""", ("obs",))
def _(spark, sf):
    o = B.obs_df(spark, sf)
    strict = S.quality_filtered("rainfall", "rainfall_quality", accept_interpolated=False)
    return quality.filter_values(o.withColumn("rainfall_observed", strict)).select(
        "station_id", "date", "min_temp", "max_temp", "rainfall", "rainfall_observed")


@query("b10_risk_flags", """
    SELECT station_id, date, CASE WHEN min_temp < 2 THEN 1 ELSE 0 END AS frost_risk, CASE WHEN max_temp > 32 THEN 1 ELSE 0 END AS heat_risk,
           CASE WHEN rainfall > 10 THEN 1 ELSE 0 END AS rain_risk FROM obs""", ("obs",))
def _(spark, sf):
    return B.obs_df(spark, sf).select("station_id", "date", S.frost_flag("min_temp").alias("frost_risk"),
                                      S.heat_flag("max_temp").alias("heat_risk"), S.rain_flag("rainfall").alias("rain_risk"))


@query("b11_nodata_mask", """
    SELECT cell_id, date, CASE WHEN v >= 0 THEN v END AS mm,
           CASE WHEN v IS NULL OR v < -32000 THEN 'nodata' WHEN v < 0 THEN 'negative_sum' ELSE 'ok' END AS flag
    FROM (SELECT cell_id, date, CASE day % 9 WHEN 0 THEN -32767 WHEN 1 THEN -5 ELSE mm END AS v FROM grid_daily)""", ("grid_daily",))
def _(spark, sf):
    v = F.when(F.col("day") % 9 == 0, -32767.0).when(F.col("day") % 9 == 1, -5.0).otherwise(F.col("mm"))
    return B.grid_daily_df(spark, sf).withColumn("v", v).select(
        "cell_id", "date", S.nodata_masked("v").alias("mm"), S.nodata_flag("v").alias("flag"))


@query("b12_station_select", """
    SELECT station_id, name, cropping_area FROM stations WHERE state_name IN ('ASIA', 'EUROPE', 'AFRICA') AND cropping_area >= 2000
      AND latitude BETWEEN -42 AND -15 AND longitude BETWEEN 113 AND 150""", ("stations",))
def _(spark, sf):
    s = regions.station_select(B.stations_df(spark, sf), ["ASIA", "EUROPE", "AFRICA"], None, 2000, (-42.0, -15.0, 113.0, 150.0))
    return s.select("station_id", "name", "cropping_area")


@query("b12_station_sample", "SELECT station_id, name FROM stations ORDER BY md5(station_id || ':42'), station_id LIMIT 20", ("stations",))
def _(spark, sf):
    return seeded_sample(B.stations_df(spark, sf).select("station_id", "name"), "station_id", 20, 42)


@query("b13_season_and_stage", f"""
    SELECT DISTINCT date, {SEASON} AS season_year, {DATE_STAGE} AS stage, make_date({SEASON}, 9, 1) AS flowering_start,
           make_date({SEASON}, 11, 1) AS harvest_start FROM obs""", ("obs",))
def _(spark, sf):
    d = B.obs_df(spark, sf).select("date").distinct()
    return d.select("date", S.season_year("date").alias("season_year"), S.date_stage("date").alias("stage"),
                    S.season_day("date", 9, 1).alias("flowering_start"), S.season_day("date", 11, 1).alias("harvest_start"))


@query("b14_stage_info", f"""
    SELECT DISTINCT date, {STAGE} AS stage, ({STAGE}) IN ('tillering', 'flowering', 'grain_fill') AS frost_critical,
           ({STAGE}) = 'grain_fill' AS heat_critical, ({STAGE}) = 'harvest' AS rain_critical,
           month(date) IN (9, 10) AS flowering_active,
           CASE WHEN date >= make_date({SEASON}, 9, 1) THEN CAST(date - make_date({SEASON}, 9, 1) AS INT) END AS days_since_flowering,
           CASE WHEN date < make_date({SEASON}, 11, 1) THEN CAST(make_date({SEASON}, 11, 1) - date AS INT) ELSE 0 END AS days_until_harvest,
           CASE CAST(month(date) AS INT) WHEN 1 THEN 'harvest' WHEN 4 THEN 'planting' WHEN 5 THEN 'planting' WHEN 6 THEN 'planting' WHEN 7 THEN 'emergence'
             WHEN 8 THEN 'tillering' WHEN 9 THEN 'stem_elongation' WHEN 10 THEN 'flowering' WHEN 11 THEN 'grain_fill' WHEN 12 THEN 'maturity' END AS month_stage
    FROM obs""", ("obs",))
def _(spark, sf):
    d = E.with_stage(B.obs_df(spark, sf).select("date").distinct())
    return d.select("date", F.col("crop_stage").alias("stage"), "frost_critical", "heat_critical", "rain_critical",
                    S.flowering_active("date").alias("flowering_active"), S.days_since_flowering("date").alias("days_since_flowering"),
                    S.days_until_harvest("date").alias("days_until_harvest"), S.month_stage("date").alias("month_stage"))


@query("b15_phenology_multiplier", f"""
    SELECT DISTINCT date, greatest(0.1::DOUBLE, least(3.0::DOUBLE,
        CASE {STAGE} WHEN 'tillering' THEN 1.0 WHEN 'flowering' THEN 2.5 WHEN 'grain_fill' THEN 2.0 WHEN 'maturity' THEN 0.5 WHEN 'harvest' THEN 0.2 ELSE 1.0 END::DOUBLE
        * CASE WHEN month(date) IN (9, 10) THEN 1.3 ELSE 1 END::DOUBLE * CASE WHEN month(date) = 9 AND day(date) <= 8 THEN 1.2 ELSE 1 END::DOUBLE)) AS frost,
        CASE {STAGE} WHEN 'tillering' THEN 0.8 WHEN 'flowering' THEN 1.5 WHEN 'grain_fill' THEN 2.0 WHEN 'maturity' THEN 1.2 ELSE 1.0 END::DOUBLE AS heat,
        CASE {STAGE} WHEN 'tillering' THEN 0.6 WHEN 'flowering' THEN 0.7 WHEN 'grain_fill' THEN 0.8 WHEN 'maturity' THEN 1.5 WHEN 'harvest' THEN 2.0 ELSE 1.0 END::DOUBLE AS rainfall
    FROM obs""", ("obs",), ("frost", "heat", "rainfall"))
def _(spark, sf):
    d = B.obs_df(spark, sf).select("date").distinct().withColumn("stage", S.crop_stage("date"))
    return d.select("date", S.phenology_multiplier("stage", "frost", S.flowering_active("date"), S.days_since_flowering("date")).alias("frost"),
                    S.phenology_multiplier("stage", "heat").alias("heat"), S.phenology_multiplier("stage", "rainfall").alias("rainfall"))


@query("b16_risk_score", f"""
    SELECT station_id, date, 'frost' AS event_type, least(100, CASE WHEN min_temp < -2 THEN 90 WHEN min_temp < 0 THEN 70 ELSE 50 END * {conf('min_temp_quality')}) AS risk_score
    FROM obs WHERE min_temp <= 2
    UNION ALL SELECT station_id, date, 'heat', least(100, 45 * {conf('max_temp_quality')}) FROM obs WHERE max_temp > 32""", ("obs",), ("risk_score",))
def _(spark, sf):
    ev = E.flat_threshold_events(B.obs_df(spark, sf))
    return ev.select("station_id", "date", "event_type", S.risk_score("event_type", "severity", "confidence").alias("risk_score"))


@query("b17_decile_classes", """
    SELECT sa2_code, year, month, d, CASE WHEN d = 1 THEN 'very low' WHEN d <= 3 THEN 'below normal' WHEN d <= 7 THEN 'near normal' WHEN d <= 9 THEN 'above normal' ELSE 'very high' END AS label,
           CASE WHEN d <= 3 THEN 'Dry (D1-D3)' WHEN d <= 7 THEN 'Mid (D4-D7)' ELSE 'Wet (D8-D10)' END AS band,
           CASE WHEN d <= 3 THEN 'dry' WHEN d <= 6 THEN 'mid' ELSE 'wet' END AS tone
    FROM (SELECT *, CAST(ntile(10) OVER (PARTITION BY sa2_code ORDER BY rainfall_mm, year, month) AS INT) AS d FROM region_month WHERE rainfall_mm IS NOT NULL)""", ("region_month",))
def _(spark, sf):
    d = F.ntile(10).over(W.partitionBy("sa2_code").orderBy("rainfall_mm", "year", "month"))
    rows = B.region_month_df(spark, sf).where("rainfall_mm is not null").withColumn("d", d)
    return rows.select("sa2_code", "year", "month", "d", S.decile_label("d").alias("label"), S.band3("d").alias("band"), S.dry_mid_wet("d").alias("tone"))


_PCT = "(l_partkey * 37 + l_linenumber * 11) % 1011 / 10::DOUBLE"


@query("b18_decile_tier7", f"""
    SELECT tier, count(*) AS n FROM (SELECT CASE WHEN p >= 100 THEN 'highest' WHEN p <= 0 THEN 'lowest' WHEN p >= 90 THEN 'd10' WHEN p >= 70 THEN 'd89'
      WHEN p >= 30 THEN 'd47' WHEN p >= 10 THEN 'd23' ELSE 'd1' END AS tier FROM (SELECT {_PCT} AS p FROM lineitem)) GROUP BY 1""")
def _(spark, sf):
    p = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 11) % 1011 / 10.0
    return B.table(spark, sf, "lineitem").groupBy(S.decile_tier7(p).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("b19_pct_bin10", f"""
    SELECT bin, count(*) AS n FROM (SELECT CAST(least(9, greatest(0, ceil(p / 10) - 1)) AS INT) AS bin FROM (SELECT {_PCT} AS p FROM lineitem)) GROUP BY 1""")
def _(spark, sf):
    p = (F.col("l_partkey") * 37 + F.col("l_linenumber") * 11) % 1011 / 10.0
    return B.table(spark, sf, "lineitem").groupBy(S.pct_bin10(p).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("b20_break_status", """
    SELECT DISTINCT date, CASE WHEN date < make_date(year(date), 5, 15) THEN 'early' WHEN date <= make_date(year(date), 6, 15) THEN 'on_time' ELSE 'late' END AS by_date,
           CASE WHEN dayofyear(date) < 135 THEN 'early' WHEN dayofyear(date) <= 166 THEN 'on_time' ELSE 'late' END AS by_doy FROM obs""", ("obs",))
def _(spark, sf):
    d = B.obs_df(spark, sf).select("date").distinct()
    return d.select("date", S.break_status_date("date").alias("by_date"), S.break_status_doy(F.dayofyear("date")).alias("by_doy"))


@query("b21_seeding_and_season_class", """
    SELECT station_id, date, CASE WHEN rainfall >= 25 THEN 'Adequate' WHEN rainfall >= 15 THEN 'Marginal' WHEN rainfall >= 10 THEN 'Marginal-low' WHEN rainfall < 10 THEN 'Insufficient' END AS seeding,
           CASE WHEN rainfall >= 70 THEN 'Strong' WHEN rainfall >= 40 THEN 'Adequate' WHEN rainfall >= 20 THEN 'Below average' WHEN rainfall < 20 THEN 'Poor' END AS season FROM obs""", ("obs",))
def _(spark, sf):
    return B.obs_df(spark, sf).select("station_id", "date", S.seeding_class("rainfall").alias("seeding"), S.season_class("rainfall").alias("season"))


@query("b22_dual_window_class", """
    SELECT l_orderkey, l_linenumber, CASE WHEN a < 4 AND b < 4 THEN 'persistent_dry' WHEN a < 4 AND b >= 7 THEN 'recovered' WHEN a >= 7 AND b < 4 THEN 'fading'
           WHEN a >= 7 AND b >= 7 THEN 'solid' ELSE 'mixed' END AS outlook
    FROM (SELECT l_orderkey, l_linenumber, l_quantity / 5 AS a, l_partkey % 101 / 10 AS b FROM lineitem)""")
def _(spark, sf):
    return B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.dual_window_class(
        F.col("l_quantity") / 5, F.col("l_partkey") % 101 / 10).alias("outlook"))


@query("b23_feature_quality_flag", """
    SELECT l_orderkey, l_linenumber, CASE WHEN s < 0.8 THEN 'insufficient_season' WHEN w < 0.8 THEN 'insufficient_sowing_window' WHEN c < 0.8 THEN 'partial'
           WHEN p THEN 'complete_to_date' ELSE 'complete' END AS flag
    FROM (SELECT l_orderkey, l_linenumber, l_quantity / 50 + 0.4 AS s, (l_partkey % 10) / 10 + 0.5 AS w, (l_suppkey % 10) / 10 + 0.5 AS c, l_linenumber % 2 = 0 AS p FROM lineitem)""")
def _(spark, sf):
    s, w = F.col("l_quantity") / 50 + 0.4, F.col("l_partkey") % 10 / 10 + 0.5
    c, p = F.col("l_suppkey") % 10 / 10 + 0.5, F.col("l_linenumber") % 2 == 0
    return B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.feature_quality_flag(s, w, c, p).alias("flag"))


@query("b24_sowing_band", """
    SELECT o_orderkey, CASE WHEN d <= 150 THEN 'low' WHEN d <= 157 THEN 'medium' WHEN d > 164 AND p >= 90 THEN 'extreme' ELSE 'high' END AS band
    FROM (SELECT o_orderkey, CAST(dayofyear(o_orderdate) AS INT) AS d, o_custkey % 100 AS p FROM orders) WHERE d > 127""")
def _(spark, sf):
    band = S.sowing_band(F.dayofyear("o_orderdate"), F.lit(127), F.lit(150), F.lit(157), F.col("o_custkey") % 100)
    return B.table(spark, sf, "orders").select("o_orderkey", band.alias("band")).where("band is not null")


@query("b25_season_label_and_doy", """
    SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y, CAST(dayofyear(o_orderdate) AS INT) AS doy,
           year(o_orderdate) || '/' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS season, CAST(o_orderdate AS DATE) AS day FROM orders""")
def _(spark, sf):
    o = B.table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), F.dayofyear("o_orderdate").alias("doy")).distinct()
    return o.select("y", "doy", S.season_label("y").alias("season"), S.doy_to_date("doy", "y").alias("day"))


_SDS = {f"{s}0{i}": f"SD_{s}_{i}" for s in range(1, 5) for i in range(3) if (s, i) != (4, 2)}
_DROPPED = {"402": "pastoral", "500": "pastoral", "501": "pastoral", "502": "pastoral"}


@query("b26_resolve_region", """
    SELECT sa2_code, sd_code, 'SD_' || left(sd_code, 1) || '_' || right(sd_code, 1) AS sd_region FROM concordance
    WHERE sd_state_code = left(sa2_code, 1) AND sd_code IN ('100','101','102') AND sd_state_code = '1'""", ("concordance",))
def _(spark, sf):
    kept, _ = sowing.resolve_region(B.concordance_df(spark, sf), _SDS, _DROPPED, "1")
    return kept.where(F.col("sd_state_code") == F.substring("sa2_code", 1, 1)).select("sa2_code", "sd_code", "sd_region")


@query("b26_resolve_region_rejects", """
    SELECT sa2_code, sd_code, 'interstate edge overlap: SD resides in state ' || sd_state_code AS rationale FROM concordance
    WHERE sd_state_code <> '1'""", ("concordance",))
def _(spark, sf):
    _, dropped = sowing.resolve_region(B.concordance_df(spark, sf), _SDS, _DROPPED, "1")
    return dropped.select("sa2_code", "sd_code", "rationale")


_COMMODITY = {"automobile": "wheat_incl_durum", "building": "barley", "furniture": "canola", "household": "lupins", "machinery": "oats"}


@query("b27_resolve_commodity", """
    SELECT sa2_code, crop, CASE crop WHEN 'automobile' THEN 'wheat_incl_durum' WHEN 'building' THEN 'barley' WHEN 'furniture' THEN 'canola'
           WHEN 'household' THEN 'lupins' WHEN 'machinery' THEN 'oats' END AS commodity FROM crop_context""", ("crop_context",))
def _(spark, sf):
    return sowing.resolve_commodity(B.crop_context_df(spark, sf), _COMMODITY).select("sa2_code", "crop", "commodity")


@query("b28_validate_windows", """
    SELECT sd_region, commodity, source_year, array_to_string(list_filter([
             CASE WHEN optimal_end_doy > optimal_start_doy + 9 + CAST(sd_region AS INT) % 3 THEN 'doy_order' END,
             CASE WHEN commodity = 'machinery' THEN 'rainfall_regime' END], lambda x: x IS NOT NULL), ',') AS errors
    FROM guides WHERE optimal_end_doy > optimal_start_doy + 9 + CAST(sd_region AS INT) % 3 OR commodity = 'machinery'""", ("guides",))
def _(spark, sf):
    g = B.guides_df(spark, sf)
    g = g.withColumn("latest_viable_doy", F.col("optimal_start_doy") + 9 + F.col("sd_region").cast("int") % 3)
    g = g.withColumn("rainfall_regime", F.when(F.col("commodity") == "machinery", "odd").otherwise(F.col("rainfall_regime")))
    bad = sowing.window_violations(g, B.concordance_df(spark, sf).select(F.col("sd_code").alias("sd_region")))
    return bad.select("sd_region", "commodity", "source_year", F.array_join("errors", ",").alias("errors"))


@query("b29_assert_region_known", "SELECT sd_region, count(*) AS n_guides FROM guides GROUP BY 1", ("guides",))
def _(spark, sf):
    ref = B.concordance_df(spark, sf).select(F.col("sd_code").alias("region_code"), F.lit("sd").alias("region_level"),
                                             F.col("sd_state_code").alias("state"))
    g = sowing.assert_region_known(B.guides_df(spark, sf), ref)
    return g.groupBy("sd_region").agg(F.count(F.lit(1)).alias("n_guides"))


@query("b30_zone_split", """
    SELECT region, (min(least(y1, y2)) + max(greatest(y1, y2))) / 2 AS mid_lat,
           CASE WHEN (min(least(y1, y2)) + max(greatest(y1, y2))) / 2 > -33 THEN 'north' ELSE 'south' END AS zone
    FROM edges GROUP BY 1""", ("edges",), ("mid_lat",))
def _(spark, sf):
    return spatial.zone_split(B.edges_df(spark, sf), -33.0)


@query("b31_crop_lookup", "SELECT sa2_code, crop, area_ha, production_t FROM crop_context WHERE station_sa2_5dig16 = '31002'", ("crop_context",))
def _(spark, sf):
    return regions.crop_lookup(B.crop_context_df(spark, sf), "31002").select("sa2_code", "crop", "area_ha", "production_t")


@query("b32_ring_centroid", "SELECT region, avg(y1) AS lat, avg(x1) AS lon FROM edges WHERE ring = 0 GROUP BY 1", ("edges",), ("lat", "lon"))
def _(spark, sf):
    return spatial.ring_centroid(B.edges_df(spark, sf))


@query("b33_pct_of_median", """
    SELECT sa2_code, year, month, rainfall_mm / nullif(m, 0) * 100 AS pct, rainfall_mm / greatest(m, 0.1::DOUBLE) * 100 AS pct_floored
    FROM (SELECT *, median(to_day_mm) OVER (PARTITION BY sa2_code, year) AS m FROM region_month)""", ("region_month",), ("pct", "pct_floored"))
def _(spark, sf):
    rows = B.region_month_df(spark, sf)
    med = ranking.climatology(rows, ["sa2_code", "year"], "to_day_mm", (0.5,)).select("sa2_code", "year", "p50")
    return rows.join(med, ["sa2_code", "year"]).select(
        "sa2_code", "year", "month", S.pct_of_median("rainfall_mm", "p50").alias("pct"), S.pct_of_median("rainfall_mm", "p50", 0.1).alias("pct_floored"))


@query("h_string_functions", """
    SELECT doc_id, lower(trim(source)) AS source, split_part(text, '.', 1) AS first_sentence, contains(text, 'the') AS has_the,
           len(regexp_extract_all(text, '[0-9]+')) AS n_numbers, regexp_matches(text, '^[A-Z]') AS starts_upper, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS code
    FROM documents""")
def _(spark, sf):
    return B.table(spark, sf, "documents").select(
        "doc_id", F.lower(F.trim("source")).alias("source"), F.split("text", r"\.")[0].alias("first_sentence"), F.contains("text", F.lit("the")).alias("has_the"),
        F.size(F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))).alias("n_numbers"), F.col("text").rlike("^[A-Z]").alias("starts_upper"), S.zfill("doc_id", 8).alias("code"))


@query("h_date_functions", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(weekofyear(o_orderdate) AS INT) AS iso_week, CAST(dayofyear(o_orderdate) AS INT) AS doy,
           CAST(day(last_day(o_orderdate)) AS INT) AS month_days, CAST(dayofyear(make_date(year(o_orderdate), 12, 31)) AS INT) AS year_days, CAST(o_orderdate AS DATE) - 13 AS window_start
    FROM orders""")
def _(spark, sf):
    o = B.table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("d", "yyyyMMdd")).when(
        F.col("o_orderkey") % 3 == 1, F.date_format("d", "dd/MM/yyyy")).otherwise(F.date_format("d", "yyyy-MM-dd"))
    y = F.year("d")
    return o.select("o_orderkey", S.parse_date_mixed(text).alias("day"), F.weekofyear("d").alias("iso_week"), F.dayofyear("d").alias("doy"),
                    S.days_in_month(y, F.month("d")).alias("month_days"), S.days_in_year(y).alias("year_days"), F.date_sub("d", 13).alias("window_start"))


@query("h_json_map_null_functions", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(nullif(event_type, 'error'), 'none') AS kind,
           '{"k":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS back FROM events""")
def _(spark, sf):
    p = F.from_json("props", "k bigint")
    return B.table(spark, sf, "events").select("event_id", p["k"].alias("k"), F.coalesce(F.nullif("event_type", F.lit("error")), F.lit("none")).alias("kind"),
                                               F.to_json(p).alias("back"))


@query("h_math_functions", """
    SELECT l_suppkey, sqrt(sum(pow(l_quantity - 25, 2))) AS distance, stddev_samp(l_quantity) AS sd, median(l_quantity) AS med, avg(l_quantity) AS mean,
           (max(l_quantity) - avg(l_quantity)) / nullif(stddev_samp(l_quantity), 0) AS z_max, CAST(greatest(1, least(10, ceil(avg(l_quantity) / 5))) AS INT) AS clamped, round_even(avg(l_quantity) * 0 + 2.5, 0) AS half_even
    FROM lineitem GROUP BY 1""", (), ("distance", "sd", "med", "mean", "z_max", "half_even"))
def _(spark, sf):
    q = F.col("l_quantity")
    return B.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sqrt(F.sum(F.pow(q - 25, 2))).alias("distance"), F.stddev_samp(q).alias("sd"), F.median(q).alias("med"), F.avg(q).alias("mean"),
        ((F.max(q) - F.avg(q)) / F.nullif(F.stddev_samp(q), F.lit(0.0))).alias("z_max"),
        F.greatest(F.lit(1), F.least(F.lit(10), F.ceil(F.avg(q) / 5))).cast("int").alias("clamped"), F.bround(F.avg(q) * 0 + 2.5, 0).alias("half_even"))


@query("h_array_functions", """
    SELECT ids.state_name, n_ids, station_id FROM (SELECT state_name, count(DISTINCT station_id) AS n_ids FROM stations GROUP BY 1) ids JOIN stations USING (state_name)""", ("stations",))
def _(spark, sf):
    ids = B.stations_df(spark, sf).groupBy("state_name").agg(F.array_join(F.array_sort(F.collect_set("station_id")), "|").alias("ids"))
    parts = F.split("ids", r"\|")
    return ids.select("state_name", F.size(parts).cast("bigint").alias("n_ids"), F.explode(parts).alias("station_id"))


@query("k_sql_functions", f"""
    SELECT station_id, date, {conf('rainfall_quality')} AS confidence,
           CASE WHEN date < make_date(year(date), 5, 15) THEN 'early' WHEN date <= make_date(year(date), 6, 15) THEN 'on_time' ELSE 'late' END AS status,
           CAST(greatest(1, least(10, ceil((day(date) + 1) / 31::DOUBLE * 10))) AS INT) AS decile,
           CAST(round_even(greatest(1, least(10, (day(date) + 1) / 31::DOUBLE * 10)), 1) AS DOUBLE) AS score
    FROM obs""", ("obs",))
def _(spark, sf):
    Q.register(spark)
    return B.obs_df(spark, sf).selectExpr(
        "station_id", "date", "quality_confidence(rainfall_quality) AS confidence", "break_status(date) AS status",
        "decile_rank(CAST(day(date) AS BIGINT), 31L) AS decile", "decile_score(CAST(day(date) AS BIGINT), 31L) AS score")
