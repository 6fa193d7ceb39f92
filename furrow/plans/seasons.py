"""Season features per region, their join to crop areas and the weighted summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import scalar as S
from furrow.operators import joins, sets
from furrow.operators.aggregates import aggregate_to_region, season_features_monthly, weighted_mean
from furrow.operators.ranking import weighted_deciles
from furrow.operators.timeseries import season_features
from furrow.session import stored


def station_season_regions(obs: DataFrame, station_map: DataFrame, min_coverage: float = 0.8, region: str = "sa2_code") -> DataFrame:
    """Station features averaged to regions."""
    out = aggregate_to_region(season_features(obs, min_coverage), station_map, min_coverage, region)
    return out.withColumn("monthly_features_source", F.lit("station_daily")).withColumn(
        "daily_features_status", F.lit("station_daily"))


def build_season_features(source: str, *, history: DataFrame | None = None, obs: DataFrame | None = None,
                          station_map: DataFrame | None = None, as_of: tuple[int, int] | None = None,
                          min_coverage: float = 0.8, version: str = "1") -> DataFrame:
    """Season features from ``stations``, ``monthly`` or ``hybrid`` (monthly base, daily overlay)."""
    if source == "stations":
        out = station_season_regions(obs, station_map, min_coverage)
    else:
        out = season_features_monthly(history, *as_of, min_coverage)
        if source == "hybrid":
            daily = aggregate_to_region(season_features(obs, min_coverage), station_map, min_coverage)
            daily = daily.withColumn("sa2_5", S.code9_to_5("sa2_code"))
            out = joins.overlay(out, daily, ["season_year", "sa2_5"], [*P.DAILY_DERIVED, "data_quality_score"])
    return out.withColumn("source_dataset", F.lit("silo_patched_point")).withColumn("pipeline_version", F.lit(version))


def join_crop_context(features: DataFrame, crops: DataFrame) -> DataFrame:
    """Crop rows led join to season features on the five-digit code; no match reads ``no_data``."""
    right = features.drop("sa2_name", "state_name").withColumnRenamed("sa2_code", "rainfall_sa2_code").withColumnRenamed(
        "sa2_5", "_key").withColumn("_key", F.trim("_key"))
    left = crops.withColumn("_key", F.trim("station_sa2_5dig16")).withColumnRenamed("sa2_code", "abs_sa2_code").withColumnRenamed(
        "financial_year", "crop_context_year")
    return joins.led_join(left, right, "_key", "feature_quality_flag", "rainfall_feature_quality_flag").drop("_key").withColumn(
        "crop_context_is_historical", F.lit(True))


def weighted_summary(joined: DataFrame, crop: str = "wheat", weight: str = "area_ha_for_weighting",
                     metrics: Sequence[str] = P.WEIGHTED_METRICS, source_year: str = "2015-16", base_year: str = "2020-21") -> DataFrame:
    """One row per state and season: eligibility counts, area coverage, weighted metrics, name lists, fallback caveat.

    The crop's joined rows are stored: seasons, rows with a season and rows without one are all read from them.
    """
    rows = sets.replicate_into_seasons(stored(joined.where(F.col("crop") == crop), "crop-seasons"), "rainfall_feature_quality_flag", "season_year", ["state"])
    flag, w = F.col("rainfall_feature_quality_flag"), F.col(weight)
    complete = flag.isin(*P.COMPLETE_FLAGS)
    eligible = complete & w.isNotNull()

    def names(cond):
        return F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("sa2_name")))), "; ")

    fallback = eligible & F.coalesce("area_is_fallback", F.lit(False))
    out = rows.groupBy("state", F.col("season_year").cast("int").alias("season_year")).agg(
        F.count(F.lit(1)).alias("n_sa2s_universe"), F.count_if(complete).alias("n_sa2s_complete"),
        F.count_if(eligible).alias("n_sa2s_eligible"), F.count_if(flag == "insufficient_season").alias("n_sa2s_insufficient_season"),
        F.count_if(flag == "no_data").alias("n_sa2s_no_data"), F.count_if(complete & w.isNull()).alias("n_sa2s_complete_no_area"),
        F.sum(F.when(eligible, w)).alias("_eligible"), F.sum(w).alias("_mapped"),
        *[weighted_mean(m, weight, where=eligible).alias(f"{m}_wt") for m in metrics],
        names(eligible).alias("eligible_sa2s"), names(flag == "insufficient_season").alias("excluded_insufficient_season_sa2s"),
        names(flag == "no_data").alias("excluded_no_data_sa2s"), names(complete & w.isNull()).alias("excluded_complete_no_area_sa2s"),
        names(fallback).alias("fallback_area_sa2s"),
    )
    caveat = F.format_string(f"Uses {source_year} ABS fallback area for %s because {base_year} {crop} area was not published.", "fallback_area_sa2s")
    return (
        out.withColumn("area_fallback_caveat", F.when(F.col("fallback_area_sa2s") == "", "").otherwise(caveat))
        .withColumn("total_area_ha", F.when(F.col("_eligible") > 0, F.col("_eligible")))
        .withColumn("mapped_area_ha", F.when(F.col("_mapped") > 0, F.col("_mapped")))
        .withColumn("coverage_share", F.coalesce("_eligible", F.lit(0.0)) / F.when(F.col("_mapped") > 0, F.col("_mapped")))
        .withColumn("crop", F.lit(crop)).drop("_eligible", "_mapped")
    )


def weekly_outlook(summary: DataFrame, history: DataFrame, weights: DataFrame, season_year: int, current_month: int,
                   min_history: int = 10) -> DataFrame:
    """Season summary beside the monthly deciles; future months are absent, uncomparable ones show rain only."""
    deciles = weighted_deciles(history, weights, on=["sa2_code"], min_history=min_history).where(
        (F.col("year") == season_year) & (F.col("month") <= current_month))
    ok = F.col("climatology_quality_flag") == "ok"
    monthly = deciles.select(
        F.col("state_name").alias("state"), "month",
        S.cases((F.col("month") <= 3, "pre-seeding"), (F.col("month") <= 10, "growing season"), otherwise="harvest").alias("period"),
        "rainfall_mm_wt", F.when(ok, F.col("historical_median_mm_wt")).alias("median_mm"),
        F.when(ok, F.col("rainfall_decile")).alias("decile"), F.when(ok, F.col("rainfall_decile_label")).alias("label"),
        F.when(ok, F.col("anomaly_mm_wt")).alias("diff_from_median_mm"))
    head = summary.where(F.col("season_year") == season_year).select(
        "state", "n_sa2s_eligible", "coverage_share", "pre_seeding_rain_mm_wt")
    return monthly.join(head, "state", "left")
