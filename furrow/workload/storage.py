"""Queries over sources, sinks, report texts and streams; outputs are written and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from furrow import params as P
from furrow.plans import events as E
from furrow.plans import quality as Q
from furrow.plans import vintage as V
from furrow.session import scratch_path
from furrow.sources import readers, sinks
from furrow.streaming import jobs as J
from furrow.workload import bind as B
from furrow.workload.daily import EVENTS, NAMES, SCORED, _FLAT, _station_names
from furrow.workload.registry import query

_OBS = "station_id, date, min_temp, max_temp, rainfall, min_temp_quality, max_temp_quality, rainfall_quality"


@query("a1_read_observations_csv", f"SELECT {_OBS} FROM obs", ("obs",))
def _(spark, sf):
    path = scratch_path(spark, "obs-csv")
    B.obs_df(spark, sf).write.csv(path, header=True)
    return readers.read_observations(spark, path)


@query("a2_scan_weather_window", """
    SELECT station_id, date, min_temp AS min_temperature, max_temp AS max_temperature, rainfall, min_temp_quality AS min_temperature_quality, max_temp_quality AS max_temperature_quality, rainfall_quality
    FROM obs WHERE date BETWEEN DATE '1999-06-01' AND DATE '1999-06-14' AND rainfall IS NOT NULL""", ("obs",))
def _(spark, sf):
    return readers.scan_weather(B.obs_df(spark, sf), "1999-06-14", 14)


@query("a3_station_range", "SELECT station_id, date, rainfall FROM obs WHERE station_id = '000042' AND date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'", ("obs",))
def _(spark, sf):
    return readers.station_range(B.obs_df(spark, sf), "000042", "1998-01-01", "1998-12-31").select("station_id", "date", "rainfall")


@query("a4_read_crop_context", "SELECT sa2_code, station_sa2_5dig16, crop, area_ha, production_t FROM crop_context", ("crop_context",))
def _(spark, sf):
    path = scratch_path(spark, "crops-csv")
    B.crop_context_df(spark, sf).select("sa2_code", "station_sa2_5dig16", "crop", "area_ha", "production_t").write.csv(path, header=True)
    return readers.read_crop_context(spark, path)


@query("a7_read_regions_geojson", "SELECT region, ring, count(*) AS n_edges, min(x1) AS min_x, max(x2) AS max_x, min(y1) AS min_y, max(y2) AS max_y FROM edges GROUP BY 1, 2", ("edges",),
       ("min_x", "max_x", "min_y", "max_y"))
def _(spark, sf):
    n = F.col("n_nationkey")
    cx, cy = F.lit(116.5125) + F.floor(n / 5) * 8.0, F.lit(-40.5125) + (n % 5) * 6.5

    def ring(k):
        starts = [(a, b) for r, a, b, _, _ in B.OUTLINE if r == k]
        closed = starts + starts[:1]
        return F.array(*[F.array(cx + a, cy + b) for a, b in closed])

    poly = F.array(ring(0), ring(1))
    multi = F.array(F.array(ring(0)), F.array(ring(1)))
    text = F.when(n % 2 == 0, F.to_json(poly)).otherwise(F.to_json(multi))
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"sa2_code":"'), F.col("sa2_code"), F.lit('","sa2_name":"'), F.col("sa2_name"),
        F.lit('"},"geometry":{"type":"'), F.when(n % 2 == 0, "Polygon").otherwise("MultiPolygon"), F.lit('","coordinates":'), text, F.lit("}}"))
    docs = B.regions_df(spark, sf).groupBy("state_name").agg(F.array_join(F.collect_list(feature), ",").alias("f")).select(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))
    path = scratch_path(spark, "geojson")
    docs.write.text(path)
    _, edges = readers.read_regions(spark, path, multi_line=False)
    return edges.groupBy("region", "ring").agg(F.count(F.lit(1)).alias("n_edges"), F.min("x1").alias("min_x"), F.max("x2").alias("max_x"), F.min("y1").alias("min_y"), F.max("y2").alias("max_y"))


def _raw(spark, sf):
    o = B.obs_df(spark, sf)
    good = o.select(F.col("station_id").cast("int").cast("string").alias("station_id"), F.date_format("date", "yyyy-MM-dd").alias("YYYY-MM-DD"),
                    F.col("rainfall").alias("daily_rain"), F.col("rainfall_quality").alias("daily_rain_source"), F.col("min_temp"), F.col("min_temp_quality").alias("min_temp_source"))
    notes = good.groupBy("station_id").agg(F.count(F.lit(1)).alias("n")).select(
        "station_id", F.lit("data fetched on request").alias("YYYY-MM-DD"), F.col("n").cast("double").alias("daily_rain"), F.lit(0).alias("daily_rain_source"),
        F.lit(None).cast("double").alias("min_temp"), F.lit(0).alias("min_temp_source"))
    return good.unionByName(notes)


@query("a9_normalise_raw", """
    SELECT station_id, date, rainfall, rainfall_quality, 'silo_api' AS rainfall_source, min_temp, min_temp_quality, 'silo_api' AS min_temp_source, CAST(NULL AS DOUBLE) AS max_temp, 999 AS max_temp_quality, 'missing' AS max_temp_source
    FROM obs""", ("obs",))
def _(spark, sf):
    return Q.normalise_raw(_raw(spark, sf))


@query("a10_validate_feed", """
    SELECT count(*) + (SELECT count(DISTINCT station_id) FROM obs) AS record_count, count(*) FILTER (rainfall_quality = 0) + (SELECT count(DISTINCT station_id) FROM obs) AS daily_rain_observed,
           count(*) FILTER (rainfall_quality = 15) AS daily_rain_interpolated, count(*) FILTER (rainfall_quality = 35) AS daily_rain_synthetic, 'max_temp' AS missing,
           count(*) FILTER (min_temp_quality = 0) + (SELECT count(DISTINCT station_id) FROM obs) AS min_temp_observed, count(*) FILTER (min_temp_quality = 15) AS min_temp_interpolated,
           count(*) FILTER (min_temp_quality = 35) AS min_temp_synthetic FROM obs""", ("obs",))
def _(spark, sf):
    missing, counts = Q.validate_feed(_raw(spark, sf))
    return counts.withColumn("missing", F.lit(",".join(missing)))


@query("i6_ingest_batch", """
    SELECT station_id, date, CASE WHEN rainfall_quality IN (999, 35) THEN NULL ELSE rainfall END AS rainfall, CASE WHEN min_temp_quality IN (999, 35) THEN NULL ELSE min_temp END AS min_temp
    FROM obs WHERE station_id IN (SELECT station_id FROM (SELECT station_id, rainfall_completeness * CASE WHEN rainfall_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END * CASE WHEN rainfall_observed_ratio < 0.3 THEN 0.5 ELSE 1 END * 0.4
      + min_temp_completeness * CASE WHEN min_temp_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END * CASE WHEN min_temp_observed_ratio < 0.3 THEN 0.5 ELSE 1 END * 0.3 AS score FROM ratios) WHERE score >= 0.5)""", ("obs",), (), SCORED[:1])
def _(spark, sf):
    return Q.ingest_batch(_raw(spark, sf), 0.5).select("station_id", "date", "rainfall", "min_temp")


@query("i6_ingest_to_table", """
    SELECT station_id, date, CASE WHEN rainfall_quality IN (999, 35) THEN NULL ELSE rainfall END AS rainfall, CASE WHEN min_temp_quality IN (999, 35) THEN NULL ELSE min_temp END AS min_temp, kept AS accepted
    FROM (SELECT *, station_id IN (SELECT station_id FROM (SELECT station_id, rainfall_completeness * CASE WHEN rainfall_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END * CASE WHEN rainfall_observed_ratio < 0.3 THEN 0.5 ELSE 1 END * 0.4
      + min_temp_completeness * CASE WHEN min_temp_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END * CASE WHEN min_temp_observed_ratio < 0.3 THEN 0.5 ELSE 1 END * 0.3 AS score FROM ratios) WHERE score >= 0.5) AS kept FROM obs) WHERE kept
    UNION ALL SELECT 'rejected', NULL, (SELECT count(*) FROM obs) - max(n), NULL, false FROM (SELECT count(*) AS n FROM obs WHERE station_id IN (SELECT station_id FROM (SELECT station_id, rainfall_completeness * CASE WHEN rainfall_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END * CASE WHEN rainfall_observed_ratio < 0.3 THEN 0.5 ELSE 1 END * 0.4
      + min_temp_completeness * CASE WHEN min_temp_synthetic_ratio > 0.2 THEN 0.7 ELSE 1 END * CASE WHEN min_temp_observed_ratio < 0.3 THEN 0.5 ELSE 1 END * 0.3 AS score FROM ratios) WHERE score >= 0.5))""", ("obs",), (), SCORED[:1])
def _(spark, sf):
    path = scratch_path(spark, "ingest")
    for run in ("r1", "r1"):  # the second run changes nothing
        Q.ingest(_raw(spark, sf), f"{path}/table", f"{path}/quarantine", f"{path}/runs", run, "2026-01-01 00:00:00", 0.5)
    kept = spark.read.parquet(f"{path}/table").select("station_id", "date", "rainfall", "min_temp", F.lit(True).alias("accepted"))
    rejected = spark.read.parquet(f"{path}/quarantine").agg(F.count(F.lit(1)).cast("double").alias("rainfall")).select(
        F.lit("rejected").alias("station_id"), F.lit(None).cast("date").alias("date"), "rainfall", F.lit(None).cast("double").alias("min_temp"), F.lit(False).alias("accepted"))
    return kept.unionByName(rejected)


def _at(text):
    return F.lit(text).cast("timestamp")


@query("a11_upsert_last_wins", """
    SELECT station_id, date, CASE WHEN date >= DATE '2001-01-01' AND CAST(station_id AS INT) % 2 = 0 THEN rainfall * 2 ELSE rainfall END AS rainfall FROM obs""", ("obs",))
def _(spark, sf):
    path = scratch_path(spark, "upsert")
    o = B.obs_df(spark, sf).select("station_id", "date", "rainfall")
    sinks.upsert(o.withColumn("ingested_at", _at("2001-12-01 00:00:00")), path)
    newer = o.where((F.col("date") >= "2001-01-01") & (F.col("station_id").cast("int") % 2 == 0))
    sinks.upsert(newer.withColumn("rainfall", F.col("rainfall") * 2).withColumn("ingested_at", _at("2001-12-02 00:00:00")), path)
    stale = o.where(F.col("date") >= "2001-01-01").withColumn("rainfall", F.lit(-1.0)).withColumn("ingested_at", _at("2001-11-01 00:00:00"))
    sinks.upsert(stale, path)
    return spark.read.parquet(path).select("station_id", "date", "rainfall")


@query("a12_replace_date", """
    SELECT station_id, date, CASE WHEN date = DATE '2001-11-01' THEN rainfall + 1 ELSE rainfall END AS rainfall FROM obs""", ("obs",))
def _(spark, sf):
    path = scratch_path(spark, "replace")
    o = B.obs_df(spark, sf).select("station_id", "date", "rainfall")
    sinks.replace_dates(o, path)
    again = o.where("date = DATE '2001-11-01'").withColumn("rainfall", F.col("rainfall") + 1)
    sinks.replace_dates(again, path)
    sinks.replace_dates(again, path)
    return spark.read.parquet(path).select("station_id", "date", "rainfall")


@query("a13_write_by_type", "SELECT event_type, count(*) AS n, count(DISTINCT date) AS n_dates FROM ev WHERE NOT (date BETWEEN DATE '1999-08-01' AND DATE '1999-08-31' AND event_type = 'frost') GROUP BY 1", ("dense_obs",), (), EVENTS)
def _(spark, sf):
    path = scratch_path(spark, "events")
    ev = E.detect_events(B.dense_obs_df(spark, sf))
    sinks.write_by_type(ev, path)
    august = [dt.date(1999, 8, d) for d in range(1, 32)]
    sinks.write_by_type(ev.where(F.col("date").isin(august) & (F.col("event_type") != "frost")), path, august)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("date").alias("n_dates"))


@query("a14_write_latest_and_archive", """
    SELECT 'latest' AS copy, count(*) AS n FROM stations WHERE state_name <> 'ASIA' UNION ALL SELECT '2026-01-01', count(*) FROM stations UNION ALL SELECT '2026-01-08', count(*) FROM stations WHERE state_name <> 'ASIA'""", ("stations",))
def _(spark, sf):
    path = scratch_path(spark, "snap")
    st = B.stations_df(spark, sf)
    sinks.write_latest_and_archive(st, path, "2026-01-01")
    sinks.write_latest_and_archive(st.where("state_name <> 'ASIA'"), path, "2026-01-08")
    n = F.count(F.lit(1)).alias("n")
    latest = spark.read.parquet(f"{path}/latest").agg(n).select(F.lit("latest").alias("copy"), "n")
    return latest.unionByName(spark.read.parquet(f"{path}/archive").groupBy(F.col("snapshot_date").cast("string").alias("copy")).agg(n))


@query("a15_log_and_purge_runs", """
    SELECT CAST(date AS VARCHAR) AS run_id, CAST(count(DISTINCT station_id) AS INT) AS stations, count(*) AS records FROM obs WHERE date >= DATE '2001-10-20' GROUP BY 1""", ("obs",))
def _(spark, sf):
    path = scratch_path(spark, "runs")
    d = F.col("date")
    runs = B.obs_df(spark, sf).groupBy("date").agg(
        F.countDistinct("station_id").cast("int").alias("stations"), F.count(F.lit(1)).alias("records")).select(
        d.cast("string").alias("run_id"), d.cast("timestamp").alias("started_at"), d.cast("timestamp").alias("finished_at"), "stations", "records",
        F.lit(1.0).alias("success_rate"), F.lit("success").alias("status"))
    sinks.log_run(runs.where("run_id < '2001-10-25'"), path)
    sinks.log_run(runs.where("run_id >= '2001-10-25'"), path)
    sinks.purge_runs(spark, path, "2001-10-20 00:00:00")
    return spark.read.parquet(path).select("run_id", "stations", "records")


@query("a16_export_flat", """
    SELECT station_id, date, CASE WHEN min_temp < 2 THEN 1 ELSE 0 END AS frost_risk, CASE WHEN max_temp > 32 THEN 1 ELSE 0 END AS heat_risk, CASE WHEN rainfall > 10 THEN 1 ELSE 0 END AS rain_risk
    FROM obs WHERE date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'""", ("obs",))
def _(spark, sf):
    path = scratch_path(spark, "flat")
    sinks.export_flat(B.obs_df(spark, sf), "2001-06-01", "2001-06-30", path)
    schema = "station_id string, date date, min_temp double, max_temp double, rainfall double, frost_risk int, heat_risk int, rain_risk int"
    return spark.read.schema(schema).csv(path, header=True).select("station_id", "date", "frost_risk", "heat_risk", "rain_risk")


_SCORE = ("least(100, CASE event_type WHEN 'frost' THEN CASE severity WHEN 'severe' THEN 90 WHEN 'moderate' THEN 70 ELSE 50 END WHEN 'heat' THEN 45 "
          "WHEN 'rainfall' THEN CASE severity WHEN 'high' THEN 80 ELSE 40 END ELSE 0 END * confidence)")


@query("a17_export_events", f"""
    SELECT station_id, station_name, state_name, date, event_type, severity, {_SCORE} AS risk_score FROM ev LEFT JOIN (SELECT station_id, sa2_name AS station_name, state_name FROM names) USING (station_id)
    WHERE date = DATE '1999-08-20'""", ("dense_obs", "regions"), ("risk_score",), EVENTS + (NAMES,))
def _(spark, sf):
    path = scratch_path(spark, "export")
    dim = _station_names(spark, sf).select("station_id", F.col("sa2_name").alias("name"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), "state_name")
    ev = E.detect_events(B.dense_obs_df(spark, sf))
    sinks.export_events(ev, dim, "1999-08-20", path)
    return spark.read.parquet(f"{path}/risk_events_latest").select("station_id", "station_name", "state_name", "date", "event_type", "severity", "risk_score")


@query("c19_bi_enrichment", f"""
    SELECT station_id, name AS station_name, latitude, longitude, state_name, date, event_type, severity, least(100, CASE WHEN event_type = 'frost' THEN CASE severity WHEN 'severe' THEN 90 WHEN 'moderate' THEN 70 ELSE 50 END ELSE 45 END * confidence) AS risk_score
    FROM fe LEFT JOIN stations USING (station_id)""", ("obs", "stations"), ("risk_score", "latitude", "longitude"), (("fe", _FLAT),))
def _(spark, sf):
    ev = E.flat_threshold_events(B.obs_df(spark, sf))
    return sinks.export_table(ev, B.stations_df(spark, sf)).select("station_id", "station_name", "latitude", "longitude", "state_name", "date", "event_type", "severity", "risk_score")


@query("a18_write_dimension", "SELECT station_id, name, cropping_area FROM stations", ("stations",))
def _(spark, sf):
    path = scratch_path(spark, "dim")
    st = B.stations_df(spark, sf)
    sinks.write_dimension(st.where("state_name = 'ASIA'"), path)
    sinks.write_dimension(st, path)
    return spark.read.parquet(path).select("station_id", "name", "cropping_area")


# --- report audit ------------------------------------------------------------------------

_B = "regexp_extract(markdown, '(?s)```vintage[ \\t]*\\n(.*?)\\n```', 1)"


def _fld(name):
    """A field of one line, without its comment and quotes."""
    return f"""nullif(trim(regexp_replace(regexp_replace(regexp_extract(block, '(?m)^{name}:[ \\t]*(.*)$', 1), '[ \\t]+#.*$', ''), '^"(.*)"$', '\\1')), '')"""


_ITEMS = """list_transform(list_filter(list_concat(string_split(regexp_extract(block, '(?m)^inputs:[ \\t]*\\[(.*)\\]', 1), ','),
  regexp_extract_all(regexp_extract(block, '(?s)\\ninputs:((?:\\n[ \\t]+[-#][^\\n]*)+)', 1), '(?m)^[ \\t]+- (.*)$', 1)), lambda v: trim(v) <> ''), lambda v: trim(replace(v, '''', '')))"""
_FIRST = "TRY_CAST(coverage_month || '-01' AS DATE)"
_AFTER = f"'(?:through day |' || strftime({_FIRST}, '%B') || ' 1[–-]|(?:Data|Coverage) through ' || coverage_month || '-)([0-9]{{1,2}})\\b'"
_COUNT = f"'\\b([0-9]{{1,2}}) of ' || day(last_day({_FIRST})) || ' days\\b'"
VINTAGE = (("blk", f"SELECT report_id, regexp_matches(markdown, '(?s)```vintage[ \\t]*\\n.*?\\n```') AS has_block, {_B} AS block, regexp_replace(markdown, '(?s)```vintage[ \\t]*\\n(.*?)\\n```', '') AS prose FROM reports"),
           ("fld", "SELECT report_id, has_block, prose, " + ", ".join(f"{_fld(f)} AS {f}" for f in (*P.VINTAGE_REQUIRED, "decile_method")) + f", {_ITEMS} AS inputs FROM blk"),
           ("cl", f"""SELECT *, TRY_CAST(through_day AS INT) AS td, list_distinct(list_transform(list_concat(
               regexp_extract_all(prose, coalesce({_AFTER}, '(?:through day )([0-9]{{1,2}})\\b'), 1), regexp_extract_all(prose, coalesce({_COUNT}, '(never)^'), 1)),
               lambda d: CAST(d AS INT))) AS claims FROM fld"""),
           ("schema_bad", "SELECT report_id, unnest(list_filter([" + ", ".join(f"CASE WHEN {f} IS NULL THEN 'missing required field ''{f}''' END" for f in P.VINTAGE_REQUIRED) + """,
               CASE WHEN status NOT IN ('frozen', 'live') THEN 'bad status ' || status END, CASE WHEN decile_method NOT IN ('rank_ceil_v1', 'ratio_div10_v0') THEN 'unknown decile_method ' || decile_method END,
               CASE WHEN status = 'live' AND len(inputs) = 0 THEN 'live report must list ''inputs''' END], lambda x: x IS NOT NULL)) AS finding FROM cl WHERE has_block"""),
           ("good", "SELECT * FROM cl WHERE has_block AND report_id NOT IN (SELECT report_id FROM schema_bad)"),
           ("cur", "SELECT 'monthly' AS input, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS coverage_month, max(partial_month_through_day) AS now FROM mtd GROUP BY ALL"),
           ("named", "SELECT report_id, coverage_month, td, unnest(inputs) AS input FROM good WHERE status = 'live'"))


@query("i21_vintage_audit", """
    SELECT report_id, 'missing vintage block' AS finding FROM cl WHERE NOT has_block UNION ALL SELECT * FROM schema_bad
    UNION ALL SELECT report_id, 'prose coverage-day ' || c || ' does not match through_day ' || td FROM (SELECT report_id, td, unnest(claims) AS c FROM good) WHERE c <> td
    UNION ALL SELECT report_id, 'prose contains ''' || tok || '''' FROM (SELECT *, unnest(['÷ 10', '÷10', '/ 10']) AS tok FROM good) WHERE decile_method = 'rank_ceil_v1' AND contains(prose, tok)
    UNION ALL SELECT report_id, 'live decile_method differs from current' FROM good WHERE status = 'live' AND decile_method <> 'rank_ceil_v1'
    UNION ALL SELECT report_id, 'live baseline_years differ from current' FROM good WHERE status = 'live' AND baseline_years <> '[2005, 2025]'
    UNION ALL SELECT report_id, CASE WHEN now IS NULL THEN 'cannot determine current through_day in ' || input ELSE 'live through_day ' || td || ' differs from current ' || now || ' in ' || input END
      FROM named LEFT JOIN cur USING (input, coverage_month) WHERE now IS NULL OR now <> td""", ("reports", "mtd"), (), VINTAGE)
def _(spark, sf):
    current = V.current_through_days(B.mtd_df(spark, sf), "monthly")
    return V.audit(B.reports_df(spark, sf), current)


@query("i21_vintage_blocks", "SELECT report_id, has_block, status, coverage_month, td AS through_day, decile_method, coalesce(array_to_string(inputs, ','), '') AS inputs, array_to_string(list_sort(claims), ',') AS claims FROM cl", ("reports",), (), VINTAGE[:3])
def _(spark, sf):
    r = V.parse_blocks(B.reports_df(spark, sf)).withColumn("claims", F.array_join(F.transform(V.coverage_days(), lambda d: d.cast("string")), ","))
    return r.select("report_id", "has_block", "status", "coverage_month", "through_day", "decile_method", F.coalesce(F.array_join("inputs", ","), F.lit("")).alias("inputs"), "claims")


# --- streams -----------------------------------------------------------------------------

_DAYS = ("days", "SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(ts AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1, 2")


def _readings(spark, sf):
    path = f"{sf}/events.parquet"
    s = J.read_stream(spark, path + "*", spark.read.parquet(path).schema)
    return s.select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").cast("timestamp").alias("event_time"), "value", "event_type")


@query("j1_stream_ingest", "SELECT station_id, d AS date, v AS value FROM days", (), ("value",), (_DAYS,))
def _(spark, sf):
    path = f"{sf}/events.parquet"
    daily = spark.read.parquet(path).groupBy(F.col("user_id").cast("string").alias("station_id"), F.to_date("ts").alias("date")).agg(F.sum("value").alias("value"))
    landing = scratch_path(spark, "landing")
    stamped = daily.withColumn("event_time", F.col("date").cast("timestamp")).withColumn("ingested_at", F.col("event_time"))
    stamped.unionByName(stamped).write.parquet(landing)
    table = scratch_path(spark, "table")
    stream = J.deduplicated(J.read_stream(spark, landing, stamped.schema))
    J.start_ingest(stream, table, scratch_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(table).select("station_id", "date", "value")


@query("j2_stream_threshold_events", """
    SELECT CAST(user_id AS VARCHAR) AS station_id, event_id, 'frost' AS event_type, CASE WHEN t < -2 THEN 'severe' WHEN t < 0 THEN 'moderate' ELSE 'light' END AS severity
    FROM (SELECT *, value / 10 - 5 AS t FROM events) WHERE t <= 2
    UNION ALL SELECT CAST(user_id AS VARCHAR), event_id, 'heat', CASE WHEN value / 10 > 35 THEN 'very_hot' ELSE 'hot' END FROM events WHERE value / 10 > 32""")
def _(spark, sf):
    path = f"{sf}/events.parquet"
    s = J.read_stream(spark, path + "*", spark.read.parquet(path).schema).select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("station_id"), F.col("ts").alias("event_time"),
        (F.col("value") / 10 - 5).alias("min_temp"), (F.col("value") / 10).alias("max_temp"))
    out = J.run_to_files(J.threshold_events(s), "thresholds")
    ids = F.split("station_id", "/")
    return out.select(ids[0].alias("station_id"), ids[1].cast("bigint").alias("event_id"), "event_type", "severity")


@query("j3_stream_rolling_totals", f"""
    SELECT station_id, CAST(w AS DATE) + 6 AS date, count(*) AS n_rows, CASE WHEN count(*) >= 7 THEN sum(v) END AS total
    FROM (SELECT *, unnest(generate_series(d - INTERVAL 6 DAY, d::TIMESTAMP, INTERVAL 1 DAY)) AS w FROM days) WHERE w + INTERVAL 7 DAY <= (SELECT max(d) FROM days) - INTERVAL 2 DAY GROUP BY station_id, w""",
       (), ("total",), (_DAYS,))
def _(spark, sf):
    path = f"{sf}/events.parquet"
    daily = spark.read.parquet(path).groupBy(F.col("user_id").cast("string").alias("station_id"), F.to_date("ts").alias("d")).agg(F.sum("value").alias("value"))
    landing = scratch_path(spark, "daily")
    daily.select("station_id", F.col("d").cast("timestamp").alias("event_time"), "value").write.parquet(landing)
    s = J.read_stream(spark, landing, spark.read.parquet(landing).schema)
    return J.run_to_files(J.rolling(s, 7), "rolling")


@query("j4_stream_daily_summary", "SELECT CAST(ts AS DATE) AS date, count(*) AS n_rows, count(value) AS n_valid, avg(value) AS avg_value, max(value) AS max_value FROM events GROUP BY 1", (), ("avg_value",))
def _(spark, sf):
    return J.run_to_files(J.daily_summary(_readings(spark, sf)), "summary", "update", ("date",))


@query("j5_stream_runs", f"""
    SELECT station_id, min(d) AS run_start, max(d) AS run_end, CAST(count(*) AS INT) AS run_length
    FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY station_id ORDER BY d) AS INT) AS grp FROM days) GROUP BY station_id, grp
    HAVING max(d) + INTERVAL 25 HOUR <= (SELECT max(d) FROM days) - INTERVAL 2 DAY""", (), (), (_DAYS,))
def _(spark, sf):
    return J.run_to_files(J.runs(_readings(spark, sf)), "runs")


@query("j5_stream_run_positions", """
    SELECT station_id, d AS date, CAST(row_number() OVER (PARTITION BY station_id, grp ORDER BY d) AS INT) AS run_position, count(*) OVER (PARTITION BY station_id, grp) AS run_length
    FROM (SELECT *, d - CAST(row_number() OVER (PARTITION BY station_id ORDER BY d) AS INT) AS grp FROM days)""", (), (), (_DAYS,))
def _(spark, sf):
    path = f"{sf}/events.parquet"
    nights = spark.read.parquet(path).select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").cast("timestamp").alias("event_time"))
    low, high = nights.agg(F.min(F.to_date("event_time")), F.max(F.to_date("event_time"))).first()
    landing, out, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "positions"), scratch_path(spark, "ckpt")
    # three deliveries in order of time: runs that are open at the end of one go on in the next
    third = (high - low) // 3
    for k in range(3):
        part = F.least(F.floor(F.datediff("event_time", F.lit(low)) / max(third.days, 1)), F.lit(2))
        nights.where(part == k).write.mode("append").parquet(landing)
        stream = J.run_positions(J.read_stream(spark, landing, nights.schema))
        J.append_updates(stream, out, checkpoint)
    return J.latest_versions(stream, out, ("station_id", "date"))


@query("j6_late_data_replaces_date", """
    SELECT station_id, d AS date, CASE WHEN d = (SELECT max(d) FROM days) THEN v * 2 WHEN d = (SELECT min(d) FROM days) THEN v + 1 ELSE v END AS value FROM days
    WHERE d <> (SELECT min(d) FROM days) OR CAST(station_id AS BIGINT) % 2 = 0""", (), ("value",), (_DAYS,))
def _(spark, sf):
    path = f"{sf}/events.parquet"
    daily = spark.read.parquet(path).groupBy(F.col("user_id").cast("string").alias("station_id"), F.to_date("ts").alias("date")).agg(F.sum("value").alias("value"))
    landing, table, ledger = scratch_path(spark, "landing"), scratch_path(spark, "late"), scratch_path(spark, "ledger")
    low, high = daily.agg(F.min("date"), F.max("date")).first()
    all_days = daily.withColumn("ingested_at", _at("2026-01-01 00:00:00"))
    newest = daily.where(F.col("date") == F.lit(high)).withColumn("value", F.col("value") * 2).withColumn("ingested_at", _at("2026-01-02 00:00:00"))
    # far behind the watermark, and for half of the stations only: the other half leaves that date
    oldest = daily.where((F.col("date") == F.lit(low)) & (F.col("station_id").cast("bigint") % 2 == 0)).withColumn("value", F.col("value") + 1).withColumn("ingested_at", _at("2026-01-03 00:00:00"))
    for batch in (all_days, newest, oldest):
        batch.coalesce(1).write.mode("append").parquet(landing)
        stream = J.read_stream(spark, landing, all_days.schema, max_files=1)
        # a new checkpoint each time: batches that the ledger knows are replayed and change nothing
        J.start_late_data(stream, table, ledger, scratch_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(table).select("station_id", "date", "value")


@query("j7_stream_freshness", "SELECT event_type AS region, max(CAST(ts AS DATE)) AS max_obs_date FROM events GROUP BY 1")
def _(spark, sf):
    return J.run_to_files(J.freshness(_readings(spark, sf).withColumnRenamed("event_type", "region")), "fresh", "complete")
