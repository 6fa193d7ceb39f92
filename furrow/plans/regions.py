"""Crop-context build from census tables and the station coverage plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import scalar as S
from furrow.operators import aggregates as A
from furrow.operators import joins, spatial
from furrow.session import stored


CROP_FIELDS = ("crop", "area_code", "production_code", "yield_code")


def label_fallback(universe: DataFrame, census_regions: DataFrame) -> DataFrame:
    """Census code per region: its own code, else the only census region of that label and state."""
    labelled = census_regions.where(F.length("region_code") == 9).select(
        F.col("region_code").alias("_code"), F.col("region_label").alias("sa2_name"),
        F.substring("region_code", 1, 1).alias("state_digit"))
    unique = labelled.groupBy("sa2_name", "state_digit").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_code").alias("_label_code")).where("_n = 1").drop("_n")
    out = universe.join(unique, ["sa2_name", "state_digit"], "left")
    own = F.col("main_code").isNotNull()
    return out.withColumn("boundary_status", S.cases(
        (own, "matched"), (F.col("_label_code").isNotNull(), "matched_via_label"), otherwise="unmatched")).withColumn(
        "main_code", F.coalesce("main_code", "_label_code")).drop("_label_code")


def build_crop_context(universe: DataFrame, crops: Sequence[tuple[str, str, str, str]], census: DataFrame, census_regions: DataFrame,
                       correspondence: DataFrame | None = None, earlier: DataFrame | None = None,
                       fallback_crop: str = "wheat", baseline_year: str = "2020-21") -> DataFrame:
    """One row per region and crop, suppressed cells included.

    ``crops`` is the configured list of (crop, area code, production code, yield code), exploded onto
    every region so suppressed cells appear; ``census`` is the baseline year's
    region_code, commodity_code, estimate, rse. The three measures of a crop come from one
    conditional aggregate over the census rows of its codes.
    """
    resolved = label_fallback(universe, census_regions)
    literal = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(CROP_FIELDS, c)]) for c in crops])
    grid = resolved.withColumn("_c", F.explode(literal)).select("*", "_c.*").drop("_c")
    codes = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}_code").alias("commodity_code")) for m in ("area", "production", "yield")])
    long = grid.select("main_code", "crop", F.explode(codes).alias("_m")).select("main_code", "crop", "_m.*").where(
        F.col("main_code").isNotNull()).distinct()
    hits = long.join(census.withColumnRenamed("region_code", "main_code"), ["main_code", "commodity_code"])

    def of(m, c):
        return F.max(F.when(F.col("measure") == m, F.col(c)))

    measures = hits.groupBy("main_code", "crop").agg(
        of("area", "estimate").alias("area_ha"), of("production", "estimate").alias("production_t"),
        of("yield", "estimate").alias("yield_t_ha"), of("area", "rse").alias("area_rse"))
    totals = measures.groupBy("main_code").agg(F.sum("area_ha").alias("_total"))
    out = grid.join(measures, ["main_code", "crop"], "left").join(totals, "main_code", "left")
    out = out.withColumn("area_share", F.col("area_ha") / F.nullif("_total", F.lit(0.0))).drop("_total")
    out = out.withColumn("financial_year", F.lit(baseline_year))
    if correspondence is not None:
        out = joins.fallback_area(out.withColumnRenamed("main_code", "sa2_code"), correspondence, earlier, fallback_crop)
        out = out.withColumnRenamed("sa2_code", "main_code")
    else:
        out = out.withColumn("area_ha_for_weighting", F.col("area_ha")).withColumn("area_is_fallback", F.lit(False)).withColumn("area_fallback_reason", F.lit(""))
    known = F.col("main_code").isNotNull()
    notes = F.array_compact(F.array(
        F.when(known & F.col("area_ha").isNull(), "area suppressed"),
        F.when(known & F.col("production_t").isNull(), "production suppressed"),
        F.when(known & F.col("yield_t_ha").isNull(), "yield suppressed"),
        F.when(F.col("area_is_fallback"), "area_ha_for_weighting from fallback"),
        F.when(~known, "SA2 not in boundary file; no census lookup")))
    return out.withColumn("notes", F.array_join(notes, "; ")).drop("area_code", "production_code", "yield_code")


def top_crop_by_state(context: DataFrame) -> DataFrame:
    totals = context.where(F.col("area_ha").isNotNull()).groupBy("state", "crop").agg(F.sum("area_ha").alias("total_area_ha"))
    return totals.groupBy("state").agg(
        F.min_by("crop", F.struct(-F.col("total_area_ha"), F.col("crop"))).alias("top_crop"),
        F.max("total_area_ha").alias("total_area_ha"))


def census_coverage(census: DataFrame, universe: DataFrame, commodity: str, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Count of regions with an estimate, and those of them outside the universe."""
    seen = census.where((F.col("commodity_code") == commodity) & F.col("estimate").isNotNull()
                        & F.col("region_code").startswith(prefix)).select("region_code").distinct()
    outside = seen.join(universe.select(F.col("main_code").alias("region_code")), "region_code", "left_anti")
    return seen.agg(F.count(F.lit(1)).alias("n_regions")), outside


def crop_lookup(context: DataFrame, region: str, crop: str | None = None, year: str | None = None) -> DataFrame:
    """Crop rows of a region; naming crop and year must leave at most one row."""
    rows = context.where(F.col("station_sa2_5dig16") == region)
    if crop is not None:
        rows = rows.where(F.col("crop") == crop)
    if year is not None:
        rows = rows.where(F.col("financial_year") == year)
    if crop is not None and year is not None and len(rows.limit(2).collect()) > 1:
        raise ValueError(f"several crop rows for {region}, {crop}, {year}")
    return rows


def coverage_plan(crops: DataFrame, stations: DataFrame, edges: DataFrame, cells: DataFrame, min_area: float,
                  lat0: float, lon0: float, res: float, n_cols: int, existing: DataFrame | None = None) -> DataFrame:
    """Coverage report with a grid point for each region without stations.

    An existing point inside the region is reused, else the inside cell centre nearest the mean
    outline vertex is taken. ``edges.region`` and ``crops`` share the five-digit code as ``sa2_5``.
    """
    targets = A.region_areas(crops, min_area=min_area)
    bare = targets.join(stations.select("sa2_5").distinct(), "sa2_5", "left_anti").select("sa2_5")
    outlines = edges.join(bare.withColumnRenamed("sa2_5", "region"), "region", "left_semi")
    inside = spatial.cells_in_polygons(outlines, lat0, lon0, res, n_cols).join(cells.select("cell_id").distinct(), "cell_id", "left_semi") \
        if cells is not None else spatial.cells_in_polygons(outlines, lat0, lon0, res, n_cols)
    cell = F.col("cell_id")
    inside = inside.select("region", (F.lit(lat0) + F.floor(cell / n_cols) * F.lit(res)).alias("lat"),
                           (F.lit(lon0) + (cell % n_cols) * F.lit(res)).alias("lon"), F.lit(1).alias("_pref"))
    if existing is not None:
        own = spatial.points_in_polygons(existing, outlines).join(existing, "point_id").select(
            "region", "lat", "lon", F.lit(0).alias("_pref"))
        inside = inside.unionByName(own)
    centre = spatial.ring_centroid(outlines).select("region", F.col("lat").alias("_cy"), F.col("lon").alias("_cx"))
    d = S.planar_distance("lat", "lon", "_cy", "_cx")
    pick = inside.join(centre, "region").groupBy("region").agg(
        F.min_by(F.struct("lat", "lon"), F.struct(F.col("_pref"), d, F.col("lat"), F.col("lon"))).alias("p"))
    points = pick.select(F.col("region").alias("sa2_5"), F.round("p.lat", 4).alias("gap_lat"), F.round("p.lon", 4).alias("gap_lon"))
    report = A.coverage_report(targets, stations, points)
    return report.join(points.withColumnRenamed("sa2_5", "sa2_code"), "sa2_code", "left")


def station_select(stations: DataFrame, states=None, regions=None, min_area=None, bbox=None) -> DataFrame:
    """Stations passing every given filter; ``bbox`` is (lat_min, lat_max, lon_min, lon_max)."""
    if states is not None:
        stations = stations.where(F.col("state_name").isin(*states))
    if regions is not None:
        stations = stations.where(F.col("sa2_name").isin(*regions))
    if min_area is not None:
        stations = stations.where(F.col("cropping_area") >= min_area)
    if bbox is not None:
        stations = stations.where(F.col("latitude").between(bbox[0], bbox[1]) & F.col("longitude").between(bbox[2], bbox[3]))
    return stations


def _area_stats() -> list:
    return [F.count(F.lit(1)).alias("total_stations"), F.countDistinct("state_name").alias("n_states"),
            F.min("cropping_area").alias("area_min"), F.max("cropping_area").alias("area_max"), F.avg("cropping_area").alias("area_mean"),
            F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"), F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max")]


def station_stats(stations: DataFrame) -> DataFrame:
    """One row: count, area extremes, mean, exact median, bounds."""
    median = A.exact_median(stations, "cropping_area")
    return stations.agg(*_area_stats(), F.lit(median).cast("double").alias("area_median"))


def station_stats_by_state(stations: DataFrame, quantiles=(0.25, 0.5, 0.75), total: str = "ALL") -> DataFrame:
    """The same by state and for all stations, with exact quantiles of the area; ranks of all groups are found together."""
    levels = stored(stations.withColumn("_level", F.explode(F.array(F.struct(F.lit(0).alias("all"), F.col("state_name").alias("state")),
                                                                    F.struct(F.lit(1).alias("all"), F.lit(total).alias("state"))))), "station-levels")
    found = A.exact_quantiles(levels, "cropping_area", quantiles, ["_level"]).select(F.col("_level").alias("_l"), "quantiles")
    stats = levels.groupBy("_level").agg(*_area_stats()).join(found, F.col("_level").eqNullSafe(F.col("_l")), "left")
    named = [F.get("quantiles", F.lit(i)).alias(f"area_p{round(q * 100)}") for i, q in enumerate(quantiles)]
    return stats.select(F.col("_level.state").alias("state_name"), *[c for c in stats.columns if c not in ("_level", "_l", "quantiles")], *named)
