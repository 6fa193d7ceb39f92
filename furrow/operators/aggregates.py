"""Group aggregates: daily summaries, quality, weighted means and regional roll-ups."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import scalar as S
from furrow.session import stored

MEASURES = ("min_temp", "max_temp", "rainfall")


def daily_summary(obs: DataFrame, date: str = "date") -> DataFrame:
    return obs.groupBy(date).agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.avg("min_temp").alias("avg_min_temp"), F.avg("max_temp").alias("avg_max_temp"),
        F.avg("rainfall").alias("avg_rainfall"),
        F.min("min_temp").alias("lowest_temp"), F.max("max_temp").alias("highest_temp"),
        F.max("rainfall").alias("max_rainfall"),
        F.count_if(F.col("min_temp") < 2).alias("frost_count"),
        F.count_if(F.col("max_temp") > 32).alias("heat_count"),
        F.count_if(F.col("rainfall") > 10).alias("rain_count"),
    )


def coverage_summary(obs: DataFrame, start=None, date: str = "date") -> DataFrame:
    """Non-null counts and shares per day."""
    if start is not None:
        obs = obs.where(F.col(date) >= F.lit(start).cast("date"))
    n = F.count(F.lit(1))
    cols = [c for m in MEASURES for c in (
        F.count(m).alias(f"{m}_count"), (F.count(m) * 100.0 / n).alias(f"{m}_pct"))]
    return obs.groupBy(date).agg(n.alias("n_stations"), *cols)


def station_monthly(obs: DataFrame, station: str = "station_id", date: str = "date",
                    value: str = "rainfall") -> DataFrame:
    return obs.where(F.col(value).isNotNull()).groupBy(
        station, F.year(date).alias("year"), F.month(date).alias("month")
    ).agg(F.sum(value).alias("monthly_total_mm"), F.count(F.lit(1)).alias("day_count"))


def region_monthly_mean(monthly: DataFrame, station_map: DataFrame, current_year: int, current_month: int,
                        keys: Sequence[str] = ("sa2_code", "sa2_name")) -> DataFrame:
    """Simple mean of station months per region; the month in progress is flagged partial."""
    partial = (F.col("year") == current_year) & (F.col("month") == current_month)
    return (
        monthly.join(station_map, "station_id").groupBy(*keys, "year", "month")
        .agg(F.avg("monthly_total_mm").alias("rainfall_mm"), F.count(F.lit(1)).alias("station_count"))
        .withColumn("is_partial_month", partial)
        .withColumn("quality_flag", F.when(partial, "partial_month").otherwise("ok"))
    )


def weighted_mean(value, weight, where: Column | None = None) -> Column:
    """Aggregate: mean over non-null values with positive weight; NULL when none has any."""
    v, w = S._col(value), S._col(weight)
    ok = v.isNotNull() & (w > 0)
    if where is not None:
        ok = ok & where
    return F.sum(F.when(ok, v * w)) / F.nullif(F.sum(F.when(ok, w)), F.lit(0.0))


def area_weighted(df: DataFrame, weights: DataFrame, value: str, group: Sequence[str],
                  on: Sequence[str] = ("sa2_code", "state_name"), weight: str = "weight") -> DataFrame:
    """Weighted mean of ``value`` by any keys after an inner join with the area weights."""
    joined = df.join(weights.select(*on, weight), list(on))
    ok = F.col(value).isNotNull() & (F.col(weight) > 0)
    return joined.where(ok).groupBy(*group).agg(weighted_mean(value, weight).alias(value))


def window_by_state(monthly: DataFrame, weights: DataFrame, target_year: int, windows: dict = P.ANALOGUE_WINDOWS,
                    on: Sequence[str] = ("sa2_5", "state_name"), state: str = "state_name",
                    weight: str = "weight") -> DataFrame:
    """Seasonal windows summed per region, then area-weighted to state-years, in one pass.

    Partial months count only in the target year.
    """
    rows = monthly.where(~F.coalesce("is_partial_month", F.lit(False)) | (F.col("year") == target_year))
    rows = rows.join(weights.select(*on, weight), list(on))
    per_region = rows.groupBy("year", state, on[0], weight).agg(*[
        F.sum(F.when(F.col("month").between(lo, hi), F.col("rainfall_mm"))).alias(name)
        for name, (lo, hi) in windows.items()])
    return per_region.groupBy("year", state).agg(
        *[weighted_mean(name, weight).alias(name) for name in windows])


def month_wide(month: str, value: str) -> list[Column]:
    """Twelve month columns by conditional aggregation, so a pivot costs one exchange."""
    return [F.max(F.when(F.col(month) == m, F.col(value))).alias(f"monthly_rainfall_{P.MONTH_ABBR[m - 1]}_mm")
            for m in range(1, 13)]


def season_features_monthly(history: DataFrame, as_of_year: int, as_of_month: int, min_coverage: float = 0.8,
                            keys: Sequence[str] = ("state_name", "sa2_code", "sa2_name")) -> DataFrame:
    """Season features from monthly totals: months wide, windows of the months present, coverage."""
    m = F.col("month")
    present = F.col("rainfall_mm").isNotNull()
    days = F.when(F.coalesce("is_partial_month", F.lit(False)) & F.col("partial_month_through_day").isNotNull(),
                  F.col("partial_month_through_day")).otherwise(S.days_in_month("year", "month"))

    def months(lo, hi):
        return F.count_if(present & m.between(lo, hi))

    def day_sum(lo, hi):
        return F.coalesce(F.sum(F.when(present & m.between(lo, hi), days)), F.lit(0))

    agg = history.groupBy(*keys, F.col("year").alias("season_year")).agg(
        *month_wide("month", "rainfall_mm"),
        *[F.sum(F.when(m.between(lo, hi), F.col("rainfall_mm"))).alias(name)
          for name, (lo, hi) in P.SEASON_WINDOWS.items()],
        months(1, 12).alias("_m"), months(4, 6).alias("_ms"), months(5, 10).alias("_mc"),
        day_sum(1, 12).alias("_d"), day_sum(4, 6).alias("_ds"), day_sum(5, 10).alias("_dc"),
        F.max(F.when(F.coalesce("is_partial_month", F.lit(False)), F.col("partial_month_through_day")))
        .alias("partial_through_day"),
    )
    y = F.col("season_year")

    def elapsed(first, length):
        so_far = max(0, min(length, as_of_month - first + 1))
        return F.when(y < as_of_year, length).when(y == as_of_year, so_far).otherwise(0)

    def gate(count, first, length):
        return F.coalesce(F.col(count) / F.nullif(elapsed(first, length), F.lit(0)), F.lit(0.0))

    return (
        agg.withColumn("season_coverage_ratio", F.col("_d") / S.days_in_year(y))
        .withColumn("sowing_window_coverage_ratio", F.col("_ds") / P.SOWING_WINDOW_DAYS)
        .withColumn("in_crop_coverage_ratio", F.col("_dc") / P.IN_CROP_WINDOW_DAYS)
        .withColumn("feature_quality_flag", S.feature_quality_flag(
            gate("_m", 1, 12), gate("_ms", 4, 3), gate("_mc", 5, 6),
            F.col("partial_through_day").isNotNull(), min_coverage))
        .withColumn("sa2_5", S.code9_to_5("sa2_code"))
        .withColumn("monthly_features_source", F.lit("canonical_monthly"))
        .withColumn("daily_features_status", F.lit("monthly_only"))
        .withColumn("autumn_break_status", F.lit("not_assessed"))
        .drop("_m", "_ms", "_mc", "_d", "_ds", "_dc")
    )


def aggregate_to_region(station_features: DataFrame, station_map: DataFrame, min_coverage: float = 0.8,
                        region: str = "sa2_code") -> DataFrame:
    """Simple mean of station features per region and season, with the station list and modal break."""
    df = station_features.join(station_map.select("station_id", region, "sa2_name", "state_name"), "station_id")
    df = df.where(F.col(region).isNotNull() & (F.col(region) != ""))
    skip = {"station_id", "season_year", region, "sa2_name", "state_name", "autumn_break_date",
            "autumn_break_status", "feature_quality_flag", "is_in_progress"}
    numeric = [c for c in df.columns if c not in skip]
    agg = df.groupBy("season_year", region).agg(
        F.count(F.lit(1)).alias("station_count"),
        F.array_join(F.array_sort(F.collect_set("station_id")), "|").alias("contributing_station_ids"),
        F.min("state_name").alias("state_name"), F.min("sa2_name").alias("sa2_name"),
        *[F.avg(c).alias(c) for c in numeric],
        F.coalesce(F.mode("autumn_break_status", True), F.lit("absent")).alias("autumn_break_status"),
        F.min("autumn_break_date").alias("autumn_break_date"),
        F.bool_or("is_in_progress").alias("is_in_progress"),
    )
    return agg.withColumn("feature_quality_flag", S.feature_quality_flag(
        F.coalesce("season_coverage_ratio", F.lit(0.0)), F.coalesce("sowing_window_coverage_ratio", F.lit(0.0)),
        F.coalesce("in_crop_coverage_ratio", F.lit(0.0)), "is_in_progress", min_coverage)).drop("is_in_progress")


_CODES = {"observed": P.OBSERVED_CODES, "interpolated": P.INTERPOLATED_CODES, "synthetic": (P.SYNTHETIC_CODE,), "missing": (P.MISSING_CODE,)}


def code_counts(variables: Iterable[str] = MEASURES) -> list[Column]:
    """Rows, and rows of each kind of code for each variable, as aggregates."""
    return [F.count(F.lit(1)).alias("record_count")] + [
        F.count_if(F.col(f"{v}_quality").isin(*codes)).alias(f"{v}_{kind}_n") for v in variables for kind, codes in _CODES.items()]


def code_ratios(counts: DataFrame, variables: Iterable[str] = MEASURES, rules: P.QualityRules = P.QualityRules()) -> DataFrame:
    """``code_counts`` turned into shares of the rows, with the completeness of each variable."""
    counted, cols = [f"{v}_{kind}_n" for v in variables for kind in _CODES], []
    for v in variables:
        share = {kind: F.col(f"{v}_{kind}_n") / F.col("record_count") for kind in _CODES}
        cols += [share[kind].alias(f"{v}_{kind}_ratio") for kind in _CODES]
        cols.append((share["observed"] + share["interpolated"] if rules.accept_interpolated else share["observed"]).alias(f"{v}_completeness"))
    return counts.select(*[c for c in counts.columns if c not in counted], *cols)


def quality_ratios(obs: DataFrame, variables: Iterable[str] = MEASURES, station: str = "station_id",
                   rules: P.QualityRules = P.QualityRules()) -> DataFrame:
    """Share of observed, interpolated, synthetic and missing codes per station and variable."""
    variables = list(variables)
    return code_ratios(obs.groupBy(station).agg(*code_counts(variables)), variables, rules)


def confidence_score(ratios: DataFrame, variables: Iterable[str] = MEASURES,
                     rules: P.QualityRules = P.QualityRules()) -> DataFrame:
    """Add the weighted confidence, its class and the list of issues."""
    variables = list(variables)
    total = F.lit(0.0)
    issues = []
    for v in variables:
        c = F.col(f"{v}_completeness")
        synthetic = F.col(f"{v}_synthetic_ratio") > rules.max_synthetic
        interpolated = F.col(f"{v}_interpolated_ratio") > rules.max_interpolated
        unobserved = F.col(f"{v}_observed_ratio") < rules.min_observed
        c = c * F.when(synthetic, 0.7).otherwise(1.0)
        c = c * F.when(interpolated, 0.3).otherwise(1.0)
        c = c * F.when(unobserved, 0.5).otherwise(1.0)
        total = total + c * rules.weights.get(v, 0.1)
        issues += [
            F.when(F.col(f"{v}_completeness") < rules.min_completeness, f"low_completeness_{v}"),
            F.when(synthetic, f"high_synthetic_{v}"),
            F.when(interpolated, f"high_interpolation_{v}"),
            F.when(unobserved, f"low_observed_data_{v}"),
        ]
    weight = sum(rules.weights.get(v, 0.1) for v in variables)
    score = F.least(total / weight, F.lit(1.0))
    return (
        ratios.withColumn("confidence_score", score)
        .withColumn("overall_quality", S.cases((score >= 0.8, "high"), (score >= 0.5, "medium"), otherwise="poor"))
        .withColumn("issues", F.array_compact(F.array(*issues)))
    )


def quality_score(obs: DataFrame, keys: Sequence[str], quality: str = "rainfall_quality") -> DataFrame:
    """Mean confidence of the codes; a NULL code counts as missing."""
    code = F.coalesce(F.col(quality), F.lit(P.MISSING_CODE))
    return obs.groupBy(*keys).agg(
        F.when(F.count(quality) == 0, P.QUALITY_CONFIDENCE_DEFAULT)
        .otherwise(F.avg(S.quality_confidence(code))).alias("data_quality_score"))


def region_areas(crops: DataFrame, region: str = "station_sa2_5dig16", area: str = "area_ha",
                 min_area: float | None = None) -> DataFrame:
    """Total crop area per region; an all-suppressed region keeps 0.0."""
    out = (
        crops.withColumn("sa2_5", S.norm_region_code(region)).where(F.col("sa2_5") != "")
        .groupBy("sa2_5").agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("total_area_ha"),
                              F.min("sa2_name").alias("sa2_name"), F.min("state").alias("state"))
    )
    return out if min_area is None else out.where(F.col("total_area_ha") >= min_area)


def coverage_report(targets: DataFrame, stations: DataFrame, gap_regions: DataFrame | None = None) -> DataFrame:
    """One row per target region: its stations and whether a grid point fills the gap."""
    own = (
        stations.withColumn("sa2_5", S.norm_region_code("sa2_5")).select("sa2_5", "station_id").distinct()
        .groupBy("sa2_5").agg(F.count(F.lit(1)).alias("n_stations"),
                              F.array_join(F.array_sort(F.collect_list("station_id")), ";").alias("station_ids"))
    )
    out = targets.join(own, "sa2_5", "left")
    if gap_regions is None:
        out = out.withColumn("_gap", F.lit(False))
    else:
        out = out.join(gap_regions.select("sa2_5").distinct().withColumn("_gap", F.lit(True)), "sa2_5", "left")
    n = F.coalesce("n_stations", F.lit(0))
    status = S.cases((n > 0, "internal_bom"), (F.coalesce("_gap", F.lit(False)), "data_drill_gapfill"),
                     otherwise="unresolved_gap")
    return out.select(
        F.col("sa2_5").alias("sa2_code"), "sa2_name", "state", F.col("total_area_ha").alias("broadacre_area_ha"),
        n.alias("n_stations"), F.coalesce("station_ids", F.lit("")).alias("station_ids"), status.alias("gap_status"))


def freshness(coverage: DataFrame, obs: DataFrame, cutoff) -> DataFrame:
    """Newest observation per region against a cutoff date."""
    latest = obs.groupBy("station_id").agg(F.max("date").alias("_last"))
    ids = coverage.select("*", F.explode_outer(F.filter(F.split("station_ids", ";"), lambda s: s != "")).alias("station_id"))
    cut = F.lit(cutoff).cast("date")
    out = ids.join(latest, "station_id", "left").groupBy("sa2_code", "sa2_name", "state").agg(
        F.count("station_id").alias("n_stations"), F.max("_last").alias("max_obs_date"))
    d = F.col("max_obs_date")
    return out.select(
        "*", F.when(d.isNotNull(), F.greatest(F.datediff(cut, d), F.lit(0))).alias("days_behind_cutoff"),
        S.cases((d.isNull(), "no_data"), (d >= cut, "current"), otherwise="stale").alias("status"))


def freshness_verdict(fresh: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "current")
    n = F.count(F.lit(1))
    return fresh.agg(n.alias("n_regions"), ok.alias("n_current"),
                     F.when((n > 0) & (ok == n), "PASS").otherwise("FAIL").alias("verdict"))


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float] = (0.5,), by: Sequence[str] = (), buckets: int = 4096) -> DataFrame:
    """Exact quantiles of every group, between neighbours by their distance: ``by``, ``n`` and the array ``quantiles``.

    NULL and NaN are missing, infinities are the ends of the order, NULL keys are a group; groups without values have no
    row. No group is gathered or sorted: every wanted rank of every group is a range of values, and a round counts all
    ranges' values in equal-width buckets, in one pass, and narrows each range to the values of the bucket that holds its
    rank, until all ranges are single values. The ends of a range have buckets of their own, so every round narrows it.
    """
    key = F.struct(*(by or [F.lit(0).alias("_all")]))
    number = F.col(value).cast("double")
    data = stored(df.where(number.isNotNull() & ~F.isnan(number)).select(key.alias("_g"), number.alias("_v")), "values")
    position = [(F.col("n") - 1) * q for q in quantiles]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in position])))
    places = (data.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
              .withColumn("_rank", F.explode(ranks)).withColumn("_left", F.col("_rank")))
    most = sys.float_info.max
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    low = F.greatest(lo, F.lit(-most)) / 2  # halves, so that no difference overflows
    part = (v / 2 - low) / F.nullif(F.least(hi, F.lit(most)) / 2 - low, F.lit(0.0))
    inner = F.least(F.coalesce(F.floor(part * (buckets - 2)), F.lit(0)), F.lit(buckets - 3)) + 1
    bucket = F.when(v == hi, buckets).when(v == lo, 0).otherwise(inner).alias("_b")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("_g", "_lo", "_hi")]
    order = W.partitionBy("_g", "_lo", "_hi").orderBy("_b").rowsBetween(W.unboundedPreceding, 0)  # a row a bucket
    while True:
        places = stored(places.select("_g", "n", "_rank", "_left", "_lo", "_hi"), "ranks")
        open_ = places.where("_lo < _hi")
        if open_.isEmpty():
            break
        ranges = open_.select(F.col("_g").alias("_h"), "_lo", "_hi").distinct()
        counts = (data.join(ranges, F.col("_g").eqNullSafe(F.col("_h")) & v.between(lo, hi)).groupBy("_g", "_lo", "_hi", bucket)
                  .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
                  .withColumn("_upto", F.sum("_c").over(order)))
        begin = F.col("t._upto") - F.col("t._c")
        holds = (F.col("s._left") >= begin) & (F.col("s._left") < F.col("t._upto"))
        narrowed = open_.alias("s").join(counts.alias("t"), [*same, holds]).select(
            "s._g", "s.n", "s._rank", (F.col("s._left") - begin).alias("_left"), F.col("t._least").alias("_lo"), F.col("t._most").alias("_hi"))
        places = places.where("_lo >= _hi").unionByName(narrowed)
    found = places.groupBy("_g", "n").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_at"))
    values = []
    for p in position:
        a, b, f = F.element_at("_at", F.floor(p)), F.element_at("_at", F.ceil(p)), p - F.floor(p)
        values.append(F.when(a == b, a).otherwise(a * (1 - f) + b * f))
    return found.select(*[F.col(f"_g.`{c}`").alias(c) for c in by], "n", F.array(*values).alias("quantiles"))


def exact_median(df: DataFrame, value: str) -> float | None:
    """Exact median of a numeric column over a whole table; NULL and NaN are missing."""
    row = exact_quantiles(df, value).first()
    return row["quantiles"][0] if row else None


def landuse_area(pixels: DataFrame, keys: Sequence[str], area: str = "area_ha") -> DataFrame:
    """Feature count and area per class; NULL classes keep their own group."""
    return pixels.groupBy(*keys).agg(F.count(area).alias("feature_count"), F.sum(area).alias("area_ha"))


def landuse_conservation(pixels: DataFrame, grouped: DataFrame, area: str = "area_ha") -> DataFrame:
    """Total area before and after grouping, and their difference, in one row."""
    sides = pixels.select(F.col(area).alias("_a"), F.lit(1).alias("_raw")).unionByName(
        grouped.select(F.col("area_ha").alias("_a"), F.lit(0).alias("_raw")))
    raw, out = F.sum(F.when(F.col("_raw") == 1, F.col("_a"))), F.sum(F.when(F.col("_raw") == 0, F.col("_a")))
    return sides.agg(raw.alias("total_ha"), out.alias("grouped_ha"), F.abs(raw - out).alias("difference_ha"))


def join_coverage(joined: DataFrame, region: str = "abs_sa2_code", flag: str = "rainfall_feature_quality_flag") -> DataFrame:
    """Distinct matched regions per state and in all."""
    matched = F.countDistinct(F.when(F.col(flag) != "no_data", F.col(region)))
    return joined.rollup("state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(region).alias("n_sa2"), matched.alias("n_matched"),
        F.countDistinct(F.when(F.col(flag) == "no_data", F.col(region))).alias("n_no_data"),
    ).withColumn("state", F.coalesce("state", F.lit("ALL")))


def latest_complete_year(monthly: DataFrame) -> DataFrame:
    """Newest year in which all twelve months occur."""
    years = monthly.groupBy("year").agg(F.countDistinct("month").alias("n")).where("n = 12")
    return years.agg(F.max("year").alias("latest_complete_year"))
