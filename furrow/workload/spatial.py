"""Queries over grid cells, points and polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.functions.scalar import code9_to_5
from furrow.operators import spatial as SP
from furrow.plans import events as E
from furrow.plans import regions as RG
from furrow.sources.readers import complete_years, off_grid, read_grid
from furrow.workload import bind as B
from furrow.workload.registry import query

GRID = (B.GRID_LAT0, B.GRID_LON0, B.GRID_RES, B.GRID_COLS)


def inside_sql(points: str, pid: str) -> str:
    """Even-odd test of every point against every polygon, edge by edge."""
    return f"""SELECT {pid}, region FROM {points} p JOIN edges e ON (e.y1 > p.lat) <> (e.y2 > p.lat)
        AND p.lon < e.x1 + (p.lat - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) GROUP BY 1, 2 HAVING count(*) % 2 = 1"""


_CELLS = ("cells", f"SELECT cell_id, CAST({B.GRID_LAT0} AS DOUBLE) + CAST(cell_id // {B.GRID_COLS} AS DOUBLE) * CAST({B.GRID_RES} AS DOUBLE) AS lat, "
          f"CAST({B.GRID_LON0} AS DOUBLE) + CAST(cell_id % {B.GRID_COLS} AS DOUBLE) * CAST({B.GRID_RES} AS DOUBLE) AS lon, frac FROM cropfrac")
_NEAR = """SELECT point_id, station_id, sqrt(pow(p.lat - latitude, 2) + pow(p.lon - longitude, 2)) AS d,
    row_number() OVER (PARTITION BY point_id ORDER BY sqrt(pow(p.lat - latitude, 2) + pow(p.lon - longitude, 2)), station_id) AS rn FROM points p, stations"""


@query("c3_nearest_station", f"SELECT point_id, station_id, d AS distance FROM ({_NEAR}) WHERE rn = 1", ("points", "stations"), ("distance",))
def _(spark, sf):
    return SP.nearest_site(B.points_df(spark, sf), B.stations_df(spark, sf), "station_id")


@query("c4_far_from_stations", """
    SELECT point_id FROM points p WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE sqrt(pow(p.lat - latitude, 2) + pow(p.lon - longitude, 2)) <= 2.0)""", ("points", "stations"))
def _(spark, sf):
    return SP.far_from(B.points_df(spark, sf), B.stations_df(spark, sf), 2.0).select("point_id")


_EVP = """SELECT station_id, date, event_type FROM (
    SELECT CASE WHEN c_custkey % 2 = 0 THEN 'DD_' || CAST(c_custkey % 30 - 40 AS VARCHAR) || '.5_' || CAST(115 + c_custkey % 35 AS VARCHAR) || '.25' ELSE lpad(CAST(c_custkey % 120 AS VARCHAR), 6, '0') END AS station_id,
           DATE '2001-01-01' + CAST(c_custkey % 200 AS INT) AS date, lower(c_mktsegment) AS event_type FROM customer)"""


@query("c2_events_to_regions", f"""
    SELECT e.station_id, date, event_type, coalesce(s.sa2_name, n.sa2_name, '') AS sa2_name, coalesce(s.sa3_name, n.sa3_name, '') AS sa3_name
    FROM evp e LEFT JOIN stations s ON e.station_id = s.station_id
    LEFT JOIN (SELECT id, sa2_name, sa3_name FROM (SELECT id, s.sa2_name, s.sa3_name, row_number() OVER (PARTITION BY id ORDER BY
        sqrt(pow(CAST(split_part(id, '_', 2) AS DOUBLE) - latitude, 2) + pow(CAST(split_part(id, '_', 3) AS DOUBLE) - longitude, 2)), station_id) AS rn
      FROM (SELECT DISTINCT station_id AS id FROM evp WHERE starts_with(station_id, 'DD_')), stations s) WHERE rn = 1) n ON e.station_id = n.id""",
       ("stations",), (), (("evp", _EVP),))
def _(spark, sf):
    k = F.col("c_custkey")
    point = F.concat(F.lit("DD_"), (k % 30 - 40).cast("string"), F.lit(".5_"), (k % 35 + 115).cast("string"), F.lit(".25"))
    ev = B.table(spark, sf, "customer").select(
        F.when(k % 2 == 0, point).otherwise((k % 120).cast("string")).alias("station_id"),
        F.date_add(F.lit("2001-01-01").cast("date"), (k % 200).cast("int")).alias("date"), F.lower("c_mktsegment").alias("event_type"))
    return E.enrich_with_regions(ev, B.stations_df(spark, sf)).select("station_id", "date", "event_type", "sa2_name", "sa3_name")


@query("c14_points_in_polygons", inside_sql("points", "point_id"), ("points", "edges"))
def _(spark, sf):
    return SP.points_in_polygons(B.points_df(spark, sf), B.edges_df(spark, sf))


@query("c14_cells_in_polygons", f"SELECT region, cell_id FROM ({inside_sql('cells', 'cell_id')})", ("cropfrac", "edges"), (), (_CELLS,))
def _(spark, sf):
    inside = SP.cells_in_polygons(B.edges_df(spark, sf), *GRID)
    return inside.join(B.cropfrac_df(spark, sf).select("cell_id"), "cell_id").select("region", "cell_id")


@query("c15_nearest_grid_cell", f"""
    SELECT station_id, CAST(round((latitude + 0.01 + 44) / 0.05) AS BIGINT) * {B.GRID_COLS} + CAST(round((longitude - 0.01 - 112) / 0.05) AS BIGINT) AS cell_id FROM stations""", ("stations",))
def _(spark, sf):
    s = B.stations_df(spark, sf).select("station_id", (F.col("latitude") + 0.01).alias("la"), (F.col("longitude") - 0.01).alias("lo"))
    return s.select("station_id", SP.snap_to_cell("la", "lo", *GRID).alias("cell_id"))


WEIGHTS = (_CELLS, ("ins", f"SELECT region, cell_id FROM ({inside_sql('cells', 'cell_id')})"), ("wc", """
    SELECT region, cell_id, frac AS weight, false AS fallback FROM ins JOIN cropfrac USING (cell_id) WHERE frac >= 0.05"""), ("cw", """
    SELECT * FROM wc UNION ALL SELECT region, cell_id, 1.0, true FROM (
      SELECT region, cell_id, row_number() OVER (PARTITION BY region ORDER BY sqrt(pow(c.lat - q.lat, 2) + pow(c.lon - q.lon, 2)), cell_id) AS rn
      FROM (SELECT region, avg(y1) AS lat, avg(x1) AS lon FROM edges WHERE ring = 0 GROUP BY 1) c, cells q WHERE region NOT IN (SELECT region FROM wc)) WHERE rn = 1"""))


def _weights(spark, sf):
    return SP.region_cell_weights(B.edges_df(spark, sf), B.cropfrac_df(spark, sf), *GRID)


@query("d39_region_cell_weights", "SELECT region, cell_id, CAST(weight AS DOUBLE) AS weight, fallback FROM cw", ("cropfrac", "edges"), (), WEIGHTS)
def _(spark, sf):
    return _weights(spark, sf)


_ZONAL = "sum(mm * weight)::DOUBLE / nullif(sum(weight) FILTER (mm IS NOT NULL), 0)"


@query("d39_zonal_weighted_mean", f"SELECT region, year, month, {_ZONAL} AS mm, count(mm) AS n_cells, bool_or(fallback) AS fallback FROM grid_month JOIN cw USING (cell_id) GROUP BY 1, 2, 3",
       ("cropfrac", "edges", "grid_month"), ("mm",), WEIGHTS)
def _(spark, sf):
    return SP.zonal_mean(B.grid_month_df(spark, sf), _weights(spark, sf))


_CENT = f"SELECT region, CAST(round((avg(y1) + 44) / 0.05) AS BIGINT) * {B.GRID_COLS} + CAST(round((avg(x1) - 112) / 0.05) AS BIGINT) AS cell_id FROM edges WHERE ring = 0 GROUP BY 1"


@query("d40_zonal_monthly_extract", f"""
    SELECT region, year, month, mm, 'centroid' AS method FROM grid_month JOIN (
      SELECT region, cell_id FROM (SELECT region, cell_id, row_number() OVER (PARTITION BY region ORDER BY sqrt(pow(c.lat - q.lat, 2) + pow(c.lon - q.lon, 2)), cell_id) AS rn
        FROM (SELECT region, avg(y1) AS lat, avg(x1) AS lon FROM edges WHERE ring = 0 GROUP BY 1) c, cells q) WHERE rn = 1) USING (cell_id)
    UNION ALL SELECT region, year, month, {_ZONAL}, 'crop_weighted' FROM grid_month JOIN cw USING (cell_id) GROUP BY 1, 2, 3""", ("cropfrac", "edges", "grid_month"), ("mm",), WEIGHTS)
def _(spark, sf):
    table = SP.method_weights(B.edges_df(spark, sf), B.cropfrac_df(spark, sf), *GRID)
    return SP.zonal_extract(B.grid_month_df(spark, sf), table).select("region", "year", "month", "mm", "method")


_PART = ("part_m", "SELECT * FROM grid_daily WHERE year = 2001 AND month = 11 AND day <= (SELECT max(day) FROM grid_daily WHERE year = 2001 AND month = 11 AND mm IS NOT NULL)")


@query("d41_partial_month_sum", """
    SELECT cell_id, (SELECT max(day) FROM part_m) AS through_day, sum(mm) AS mm, CASE WHEN count(mm) = (SELECT max(day) FROM part_m) THEN sum(mm) END AS whole_mm FROM part_m GROUP BY 1""",
       ("grid_daily",), (), (_PART,))
def _(spark, sf):
    part = SP.partial_month(B.grid_daily_df(spark, sf), 2001, 11)
    whole = SP.partial_month_cells(part, True).withColumnRenamed("mm", "whole_mm")
    return SP.partial_month_cells(part, False).join(whole, ["cell_id", "through_day"])


@query("d41_partial_month_regions", """
    SELECT region, 'centroid' AS method, mm AS rainfall_mm, CASE WHEN mm IS NULL THEN 'nodata' ELSE 'partial_month' END AS quality_flag, through_day
    FROM sums JOIN (SELECT region, cell_id FROM (SELECT region, cell_id, row_number() OVER (PARTITION BY region ORDER BY sqrt(pow(c.lat - q.lat, 2) + pow(c.lon - q.lon, 2)), cell_id) AS rn
        FROM (SELECT region, avg(y1) AS lat, avg(x1) AS lon FROM edges WHERE ring = 0 GROUP BY 1) c, cells q) WHERE rn = 1) USING (cell_id)
    UNION ALL SELECT region, 'crop_weighted', sum(whole * weight)::DOUBLE / nullif(sum(weight) FILTER (whole IS NOT NULL), 0),
      CASE WHEN bool_or(fallback) THEN 'cropfrac_centroid_fallback' ELSE 'ok' END, max(through_day) FROM (
        SELECT *, CASE WHEN days = through_day THEN mm END AS whole FROM sums) JOIN cw USING (cell_id) GROUP BY region""", ("grid_daily", "cropfrac", "edges"), ("rainfall_mm",),
       WEIGHTS + (_PART, ("sums", "SELECT cell_id, sum(mm) AS mm, count(mm) AS days, (SELECT max(day) FROM part_m) AS through_day FROM part_m GROUP BY 1")))
def _(spark, sf):
    table = SP.method_weights(B.edges_df(spark, sf), B.cropfrac_df(spark, sf), *GRID)
    out = SP.partial_month_regions(B.grid_daily_df(spark, sf), table, 2001, 11)
    return out.select("region", "method", "rainfall_mm", "quality_flag", F.col("partial_month_through_day").alias("through_day"))


@query("a6_read_grid", "SELECT cell_id, year, mm FROM grid_month WHERE month = 5 AND year BETWEEN 1995 AND 2001", ("grid_month",))
def _(spark, sf):
    return read_grid(B.grid_month_df(spark, sf), 5, 2001, 1995, 2000, check=False).select("cell_id", "year", "mm")


@query("a6_grid_complete_years", "SELECT year, count(DISTINCT month) AS n_months FROM grid_month GROUP BY 1 HAVING count(DISTINCT month) = 12", ("grid_month",))
def _(spark, sf):
    return complete_years(B.grid_month_df(spark, sf))


@query("a6_grid_off_target_cells", """
    SELECT DISTINCT cell_id FROM grid_month WHERE month = 11 AND year < 2001 AND cell_id NOT IN (SELECT cell_id FROM grid_month WHERE month = 11 AND year = 2001)""", ("grid_month",))
def _(spark, sf):
    return off_grid(B.grid_month_df(spark, sf).where("month = 11"), 2001)


_RES, _RADIUS = 0.5, 1.5


@query("i8_gap_grid", f"""
    SELECT lat, lon FROM gp p WHERE point_id IN (SELECT point_id FROM ({inside_sql('gp', 'point_id')}))
      AND NOT EXISTS (SELECT 1 FROM stations s WHERE sqrt(pow(p.lat - latitude, 2) + pow(p.lon - longitude, 2)) <= {_RADIUS})""", ("edges", "stations"), (),
       (("gp", f"""SELECT DISTINCT lat, lon, lat || '_' || lon AS point_id FROM (SELECT round(lat_min + i * {_RES}::DOUBLE, 4) AS lat, round(lon_min + j * {_RES}::DOUBLE, 4) AS lon
         FROM (SELECT region, min(y1) AS lat_min, max(y1) AS lat_max, min(x1) AS lon_min, max(x1) AS lon_max FROM edges WHERE ring = 0 GROUP BY 1), range(0, 100) a(i), range(0, 100) b(j)
         WHERE lat_min + i * {_RES}::DOUBLE < lat_max + {_RES / 2}::DOUBLE AND lon_min + j * {_RES}::DOUBLE < lon_max + {_RES / 2}::DOUBLE)"""),))
def _(spark, sf):
    edges = B.edges_df(spark, sf)
    bounds = edges.where("ring = 0").groupBy("region").agg(F.min("y1").alias("lat_min"), F.max("y1").alias("lat_max"), F.min("x1").alias("lon_min"), F.max("x1").alias("lon_max"))
    return SP.gap_grid(bounds, _RES, edges, B.stations_df(spark, sf), _RADIUS).select("lat", "lon")


@query("i7_coverage_plan", f"""
    SELECT t.sa2_5 AS sa2_code, total_area_ha AS broadacre_area_ha, coalesce(n, 0) AS n_stations, CASE WHEN n > 0 THEN 'internal_bom' WHEN g.lat IS NOT NULL THEN 'data_drill_gapfill' ELSE 'unresolved_gap' END AS gap_status,
           CASE WHEN n IS NULL THEN round(g.lat, 4) END AS gap_lat, CASE WHEN n IS NULL THEN round(g.lon, 4) END AS gap_lon
    FROM (SELECT station_sa2_5dig16 AS sa2_5, coalesce(sum(area_ha), 0) AS total_area_ha FROM crop_context GROUP BY 1 HAVING coalesce(sum(area_ha), 0) >= 500) t
    LEFT JOIN (SELECT CASE WHEN state_name = 'EUROPE' THEN '99998' ELSE sa2_5 END AS sa2_5, count(*) AS n FROM stations GROUP BY 1) USING (sa2_5)
    LEFT JOIN (SELECT left(region, 1) || right(region, 4) AS sa2_5, lat, lon FROM (SELECT i.region, c.lat, c.lon, row_number() OVER (PARTITION BY i.region
        ORDER BY sqrt(pow(c.lat - q.lat, 2) + pow(c.lon - q.lon, 2)), c.lat, c.lon) AS rn FROM ins i JOIN cells c USING (cell_id) JOIN (SELECT region, avg(y1) AS lat, avg(x1) AS lon FROM edges WHERE ring = 0 GROUP BY 1) q USING (region)) WHERE rn = 1) g USING (sa2_5)""",
       ("cropfrac", "edges", "crop_context", "stations"), (), WEIGHTS[:2])
def _(spark, sf):
    edges = B.edges_df(spark, sf).withColumn("region", code9_to_5("region"))
    code = F.when(F.col("state_name") == "EUROPE", "99998").otherwise(F.col("sa2_5"))  # a region without crops
    st = B.stations_df(spark, sf).withColumn("sa2_5", code)
    plan = RG.coverage_plan(B.crop_context_df(spark, sf), st, edges, B.cropfrac_df(spark, sf), 500.0, *GRID)
    return plan.select("sa2_code", "broadacre_area_ha", "n_stations", "gap_status", "gap_lat", "gap_lon")


@query("i23_cropland_fraction", """
    SELECT cell_id, avg(CASE WHEN code BETWEEN 330 AND 339 OR code BETWEEN 430 AND 439 THEN 1.0 ELSE 0 END) AS frac, count(*) AS n_fine
    FROM (SELECT cell_id, fine_cell, code, row_number() OVER (PARTITION BY cell_id, fine_cell ORDER BY count(*) DESC, code) AS rn
          FROM (SELECT l_suppkey AS cell_id, l_partkey % 16 AS fine_cell, CASE CAST(l_quantity AS INT) % 4 WHEN 0 THEN 335 WHEN 1 THEN 430 WHEN 2 THEN 210 ELSE 540 END AS code FROM lineitem) GROUP BY 1, 2, 3)
    WHERE rn = 1 GROUP BY 1""", (), ("frac",))
def _(spark, sf):
    q = F.col("l_quantity").cast("int") % 4
    px = B.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("cell_id"), (F.col("l_partkey") % 16).alias("fine_cell"),
                                               F.when(q == 0, 335).when(q == 1, 430).when(q == 2, 210).otherwise(540).alias("code"))
    return SP.cropland_fraction(px)
