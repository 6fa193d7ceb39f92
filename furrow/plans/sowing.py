"""Sowing-window pressure: guide validation, SD break roll-up and pressure rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import ranks as R
from furrow.functions import scalar as S
from furrow.operators import joins
from furrow.session import stored

DOYS = ("earliest_sow_doy", "optimal_start_doy", "optimal_end_doy", "latest_viable_doy")


def resolve_region(rows: DataFrame, allowed: dict[str, str], excluded: dict[str, str], home_state: str,
                   code: str = "sd_code", state: str = "sd_state_code") -> tuple[DataFrame, DataFrame]:
    """Split rows into resolved and deliberately dropped ones; an unknown code raises.

    Dropped rows carry the rationale. Lookups are literal maps, so nothing is shuffled.
    """
    region = S.lookup(F.trim(code), allowed)
    reason = S.cases(
        (F.trim(state) != home_state, F.concat(F.lit("interstate edge overlap: SD resides in state "), F.trim(state))),
        (region.isNotNull(), None),
        otherwise=S.lookup(F.trim(code), excluded),
    )
    tagged = rows.withColumn("rationale", reason).withColumn("sd_region", region)
    unknown = tagged.where(F.col("rationale").isNull() & F.col("sd_region").isNull()).select(code).distinct()
    joins.fail_unless_empty(unknown, "unknown SD codes")
    return tagged.where(F.col("rationale").isNull()).drop("rationale"), tagged.where(F.col("rationale").isNotNull()).drop("sd_region")


def resolve_commodity(rows: DataFrame, mapping: dict[str, str], crop: str = "crop") -> DataFrame:
    """Guide crop to commodity; an unmapped crop fails when its row is read."""
    value = S.lookup(F.col(crop), mapping)
    fail = F.raise_error(F.concat(F.lit("no commodity mapping for crop "), F.col(crop)))
    return rows.withColumn("commodity", F.when(value.isNotNull(), value).otherwise(fail.cast("string")))


def assert_region_known(rows: DataFrame, reference: DataFrame, region: str = "sd_region", level: str | None = "sd",
                        state: str | None = None) -> DataFrame:
    """The rows, after checking every region code against the reference table."""
    ref = reference
    if level is not None:
        ref = ref.where(F.col("region_level") == level)
    if state is not None:
        ref = ref.where(F.col("state") == state)
    known = ref.select(F.col("region_code").alias(region)).distinct()
    joins.fail_unless_empty(rows.select(region).distinct().join(known, region, "left_anti"), "unknown region codes")
    return rows


def window_violations(windows: DataFrame, known_regions: DataFrame | None = None) -> DataFrame:
    """Guide rows with the list of rules they break; rows that pass are not returned."""
    doys = [F.col(c) for c in DOYS]
    errors = [
        F.when(~S.all_of([d.between(1, 366) for d in doys]), "doy_range"),
        F.when(~S.all_of([a <= b for a, b in zip(doys, doys[1:])]), "doy_order"),
        F.when(~F.col("rainfall_regime").isin(*P.RAINFALL_REGIMES), "rainfall_regime"),
        F.when(~F.col("season_type").isin(*P.SEASON_TYPES), "season_type"),
        F.when(~F.col("confidence").isin(*P.CONFIDENCE_LEVELS), "confidence"),
    ]
    rows = windows
    if known_regions is not None:
        rows = rows.join(known_regions.select("sd_region").distinct().withColumn("_known", F.lit(True)), "sd_region", "left")
        errors.append(F.when(F.col("_known").isNull(), "sd_region"))
    return rows.withColumn("errors", F.array_compact(F.array(*errors))).drop("_known").where(F.size("errors") > 0)


def sd_break_rollup(breaks: DataFrame, threshold: float = P.BREAK_MIN_COVERAGE) -> DataFrame:
    """Weighted mean break day per SD and season over dated breaks, with its area coverage.

    ``breaks`` carries sd_region, season_year, status, break_doy and weight.
    """
    w = F.col("weight")
    ok = F.col("status").isin(*P.DATED_BREAK_STATUSES) & F.col("break_doy").isNotNull()
    agg = breaks.groupBy("sd_region", "season_year").agg(
        F.sum(F.when(ok, w * F.col("break_doy"))).alias("_wd"), F.sum(F.when(ok, w)).alias("_w"), F.sum(w).alias("_all"),
        F.count_if(ok).alias("n_sa2_eligible"), F.count(F.lit(1)).alias("n_sa2_total"))
    agg = agg.where((F.col("_all") > 0) & (F.col("_w") > 0))
    return (
        agg.withColumn("break_doy", F.col("_wd") / F.col("_w")).withColumn("coverage", F.col("_w") / F.col("_all"))
        .withColumn("break_status", S.break_status_doy("break_doy"))
        .withColumn("coverage_ok", F.col("coverage") >= threshold).drop("_wd", "_w", "_all")
    )


def break_percentile(sd_breaks: DataFrame, min_history: int = P.BREAK_MIN_HISTORY) -> DataFrame:
    """Rank each season's break day among the SD's earlier seasons.

    An SD has one break per season, so the arrays are as long as its record has seasons.
    """
    whole = sd_breaks.groupBy("sd_region").agg(F.collect_list(F.struct(*[c for c in sd_breaks.columns if c != "sd_region"])).alias("_h"))
    out = whole.select("sd_region", "_h", F.explode("_h").alias("_r")).select("sd_region", "_h", "_r.*")
    out = out.withColumn(
        "_h", F.transform(F.filter("_h", lambda h: h["season_year"] < F.col("season_year")), lambda h: h["break_doy"]))
    n = F.size("_h")
    return (out.withColumn("n_history", n)
            .withColumn("break_percentile", R.percentile_rank(R.count_below("_h", "break_doy"), n))
            .withColumn("history_ok", n >= min_history).drop("_h"))


def sowing_pressure(sd_breaks: DataFrame, guides: DataFrame, min_history: int = P.BREAK_MIN_HISTORY) -> DataFrame:
    """Pressure rows: late breaks against each commodity's latest usable guide; in-time breaks give none."""
    ranked = break_percentile(sd_breaks, min_history)
    winter = guides.where(F.col("season_type") == "winter")
    rows = joins.as_of_guide(ranked, winter, ["sd_region"])
    rows = rows.withColumn("break_day", F.bround("break_doy").cast("int"))
    band = S.sowing_band("break_day", "optimal_start_doy", "optimal_end_doy", "latest_viable_doy", "break_percentile")
    rows = rows.withColumn("pressure_band", band).where(F.col("pressure_band").isNotNull())
    late_start = F.greatest("break_day", "optimal_start_doy")
    return rows.select(
        F.concat_ws("-", F.lit("SWP"), F.col("season_year").cast("string"), "sd_region", "commodity", F.lit("BRK")).alias("evidence_id"),
        S.season_label("season_year").alias("season"), "season_year", "state", "sd_region", "commodity",
        F.lit("at_risk").alias("pressure_direction"), "pressure_band", F.lit("unknown").alias("counterparty_commodity"),
        F.lit("season_break_forced_switch").alias("reason_code"),
        S.doy_to_date("break_day", "season_year").alias("break_date"), "break_status",
        F.col("break_percentile").alias("break_percentile_vs_history"),
        F.greatest(F.lit(0), F.col("optimal_end_doy") - late_start + 1).alias("window_overlap_days"),
        (F.col("break_day") - F.col("latest_viable_doy")).alias("days_after_latest_viable"),
        F.lit(False).alias("establishment_risk_flag"), F.col("source_document").alias("guide_source_document"),
        F.col("source_year").alias("guide_source_year"),
        F.when(~F.col("coverage_ok") | ~F.col("history_ok"), "low").otherwise(F.col("confidence")).alias("window_confidence"),
    )


def sd_breaks_from_features(features: DataFrame, concordance: DataFrame, areas: DataFrame, region_of: dict[str, str] | None = None,
                            strict: bool = True) -> DataFrame:
    """Region season features to break records per SD overlap, weighted by ratio x area."""
    dated = F.col("autumn_break_status").isin(*P.DATED_BREAK_STATUSES)
    f = features.select("sa2_code", "season_year", F.col("autumn_break_status").alias("status"),
                        F.when(dated, F.dayofyear("autumn_break_date")).alias("break_doy"))
    if strict:
        # the check below is a job of its own; the features behind it are computed once
        f = stored(f, "region-breaks")
    rows = joins.bridge(f, concordance, areas, strict=strict)
    return rows.withColumn("sd_region", S.lookup("sd_code", region_of) if region_of else F.col("sd_code"))


def check_windows(windows: DataFrame, known_regions: DataFrame | None = None) -> DataFrame:
    joins.fail_unless_empty(window_violations(windows, known_regions), "invalid sowing windows")
    return windows


def commodity_gaps(rows: DataFrame, mapped: Iterable[str], crop: str = "crop") -> DataFrame:
    """Crops that have no commodity mapping, with their row counts."""
    return rows.where(~F.col(crop).isin(*mapped)).groupBy(crop).agg(F.count(F.lit(1)).alias("n_rows"))
