"""Analogue seasons and the production they imply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.aggregates import weighted_mean
from furrow.operators.topk import top_k


def select_analogues(seasons: DataFrame, target_year: int, windows: Sequence[str], n: int = 3,
                     state: str = "state_name") -> DataFrame:
    """The n earlier years nearest to the target per state, by distance over standardised windows.

    Means and sample deviations are taken over the earlier years with all windows present (a zero
    deviation counts as 1). States whose target lacks a window or with fewer than n such years drop out.
    """
    whole = seasons.dropna(subset=list(windows))
    past = whole.where(F.col("year") < target_year)
    stats = past.groupBy(state).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.stddev_samp(w).alias(f"_sd_{w}") for w in windows])
    target = whole.where(F.col("year") == target_year).select(state, *[F.col(w).alias(f"_t_{w}") for w in windows])
    rows = past.join(stats.where(F.col("_n") >= n), state).join(target, state)
    squares = []
    for w in windows:
        sd = F.when(F.coalesce(F.col(f"_sd_{w}"), F.lit(0.0)) == 0, 1.0).otherwise(F.col(f"_sd_{w}"))
        squares.append(F.pow((F.col(w) - F.col(f"_t_{w}")) / sd, 2))
    rows = rows.withColumn("distance", F.sqrt(sum(squares, F.lit(0.0))))
    keep = [c for c in seasons.columns if c not in (state, "year")]
    return top_k(rows.select(state, "year", "distance", *keep), [state], [F.asc("distance"), F.asc("year")], n)


def production_wide(production: DataFrame, crop: str = "Wheat") -> DataFrame:
    """Area, production and yield per state and season; yield only where area is positive."""
    rows = production.where(F.col("crop") == crop)

    def metric(m):
        return F.max(F.when(F.col("metric") == m, F.col("value_normalized")))

    wide = rows.groupBy("state", "crop_season").agg(metric("Area").alias("area"), metric("Production").alias("production"))
    return wide.withColumn("yield", F.when(F.col("area") > 0, F.col("production") / F.nullif("area", F.lit(0.0))))


def implied_production(analogues: DataFrame, production: DataFrame, base_year: int, crop: str = "Wheat") -> DataFrame:
    """Mean analogue yield times the base year's area, in millions."""
    wide = production_wide(production, crop)
    yields = wide.select(F.col("state").alias("state_name"), F.col("crop_season").alias("year"), "yield")
    base = wide.where(F.col("crop_season") == base_year).select(F.col("state").alias("state_name"), F.col("area").alias("base_area"))
    rows = analogues.join(yields, ["state_name", "year"], "left")
    agg = rows.groupBy("state_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "year"))), lambda r: r["year"].cast("string")), ",").alias("analogue_years"),
        F.avg("yield").alias("mean_yield"))
    out = agg.where(F.col("mean_yield").isNotNull()).join(base.where(F.col("base_area").isNotNull()), "state_name")
    return out.withColumn("implied_production_mt", F.col("mean_yield") * F.col("base_area") / 1e6)


def production_dispersion(analogues: DataFrame, production: DataFrame, base_year: int, later: str = "jun_oct",
                          crop: str = "Wheat") -> DataFrame:
    """Low, mid and high production: yields of the analogues with least and most later rain.

    The rain range is that of all analogues; a state without any yield keeps its row, its production NULL.
    """
    wide = production_wide(production, crop)
    yields = wide.where(F.col("yield").isNotNull()).select(
        F.col("state").alias("state_name"), F.col("crop_season").alias("year"), "yield")
    base = wide.where(F.col("crop_season") == base_year).select(F.col("state").alias("state_name"), F.col("area").alias("base_area"))
    rows = analogues.join(yields, ["state_name", "year"], "left")
    by_rain = F.when(F.col("yield").isNotNull(), F.struct(F.coalesce(later, F.lit(0.0)), F.col("year")))
    agg = rows.groupBy("state_name").agg(
        F.min(later).alias("later_low_mm"), F.max(later).alias("later_high_mm"),
        F.min_by("yield", by_rain).alias("_lo"), F.avg("yield").alias("_mid"), F.max_by("yield", by_rain).alias("_hi"))
    out = agg.join(base.where(F.col("base_area").isNotNull()), "state_name")
    some = F.col("later_low_mm").isNotNull()
    return out.select(
        "state_name", "later_low_mm", "later_high_mm", "base_area",
        (F.when(some, F.col("_lo")).otherwise(F.col("_mid")) * F.col("base_area") / 1e6).alias("production_low_mt"),
        (F.col("_mid") * F.col("base_area") / 1e6).alias("production_mid_mt"),
        (F.when(some, F.col("_hi")).otherwise(F.col("_mid")) * F.col("base_area") / 1e6).alias("production_high_mt"))


def scenario_production(analogues: DataFrame, seasons: DataFrame, production: DataFrame, base_year: int, target_year: int,
                        p_above: float = 0.30, bucket: str = "jun_oct", crop: str = "Wheat") -> DataFrame:
    """Probability-weighted production of analogues above and below the long-run median of a window."""
    median = seasons.where(F.col("year") < target_year).groupBy("state_name").agg(F.median(bucket).alias("long_run_median"))
    wide = production_wide(production, crop)
    yields = wide.select(F.col("state").alias("state_name"), F.col("crop_season").alias("year"), "yield")
    base = wide.where(F.col("crop_season") == base_year).select(F.col("state").alias("state_name"), F.col("area").alias("base_area"))
    rows = (analogues.join(median, "state_name").join(yields.where(F.col("yield").isNotNull()), ["state_name", "year"])
            .join(base, "state_name").withColumn("prod", F.col("yield") * F.col("base_area") / 1e6))
    above = F.col(bucket) >= F.col("long_run_median")
    agg = rows.groupBy("state_name", "long_run_median").agg(
        F.avg(F.when(above, F.col("prod"))).alias("mean_above_mt"), F.avg(F.when(~above, F.col("prod"))).alias("mean_below_mt"),
        F.avg("prod").alias("mean_simple_mt"), F.min("prod").alias("low_mt"), F.max("prod").alias("high_mt"))
    central = F.coalesce(p_above * F.col("mean_above_mt") + (1 - p_above) * F.col("mean_below_mt"), "mean_above_mt", "mean_below_mt")
    return agg.withColumn("central_mt", central)


def complete_window_by_state(monthly: DataFrame, weights: DataFrame, name: str, lo: int, hi: int,
                             on: Sequence[str] = ("sa2_code", "state_name")) -> DataFrame:
    """Weighted state window where a region counts only with every month present."""
    m = F.col("month").between(lo, hi) & F.col("rainfall_mm").isNotNull()
    per = monthly.join(weights.select(*on, "weight"), list(on)).groupBy("year", *on, "weight").agg(
        F.when(F.count_if(m) == hi - lo + 1, F.sum(F.when(m, F.col("rainfall_mm")))).alias(name))
    return per.groupBy("year", "state_name").agg(weighted_mean(name, "weight").alias(name))
