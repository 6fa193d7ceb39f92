"""Cumulative rainfall windows at region, SD and state level, ranked against history.

A window is ``Window(label, first, last, partial)``: the months it adds up. In a partial window the
last month is in progress: the target year takes it from the month-to-date table and every
historical month is scaled to the same share of days.
"""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import scalar as S
from furrow.operators import joins
from furrow.operators.aggregates import weighted_mean
from furrow.operators.ranking import climatology, rank_target
from furrow.operators.topk import top_k
from furrow.session import stored


@dataclass(frozen=True)
class Window:
    label: str
    first: int
    last: int
    partial: bool = False


def partial_scale(year: int, month: int, through_day: int) -> float:
    return through_day / calendar.monthrange(year, month)[1]


def window_totals(history: DataFrame, windows: Sequence[Window], target_year: int, keys: Sequence[str] = ("sa2_code",),
                  mtd: DataFrame | None = None, mtd_month: int | None = None, through_day: int | None = None,
                  require_complete: bool = True, value: str = "rainfall_mm") -> DataFrame:
    """Window totals per key and year in long form, all windows from one aggregation.

    Missing months are missing, not 0 mm: an incomplete window is NULL and dropped unless
    ``require_complete`` is off. Partial-month history rows are ignored.
    """
    keys = list(keys)
    rows = history
    if "is_partial_month" in history.columns:
        rows = rows.where(~F.coalesce("is_partial_month", F.lit(False)))
    rows = rows.select(*keys, "year", "month", S.nodata_masked(value).alias("_v"), F.lit(False).alias("_mtd"))
    scale = 1.0
    if mtd is not None:
        scale = partial_scale(target_year, mtd_month, through_day)
        rows = rows.unionByName(mtd.where(F.col("year") == target_year).select(
            *keys, "year", F.lit(mtd_month).alias("month"), S.nodata_masked(value).alias("_v"), F.lit(True).alias("_mtd")))
    m, v = F.col("month"), F.col("_v")
    totals = []
    for w in windows:
        inside = m.between(w.first, w.last)
        if w.partial:
            running = m == w.last
            term = F.when(running & (F.col("year") == target_year), F.when(F.col("_mtd"), v)).when(
                ~F.col("_mtd"), F.when(running, v * scale).otherwise(v))
        else:
            term = F.when(~F.col("_mtd"), v)
        term = F.when(inside, term)
        total = F.sum(term)
        if require_complete:
            total = F.when(F.count(term) == w.last - w.first + 1, total)
        totals.append(F.struct(F.lit(w.label).alias("window"), total.alias("value")).alias(f"w{len(totals)}"))
    agg = rows.groupBy(*keys, "year").agg(*totals)
    return (
        agg.select(*keys, "year", F.explode(F.array(*[f"w{i}" for i in range(len(totals))])).alias("w"))
        .select(*keys, "year", "w.window", "w.value").where(F.col("value").isNotNull())
    )


def weighted_series(totals: DataFrame, members: DataFrame, level: Sequence[str], key: str = "sa2_code") -> DataFrame:
    """Area-weighted window totals of an upper level per year."""
    return (totals.join(members.select(*dict.fromkeys([key, *level, "weight"])), key)
            .groupBy(*level, "window", "year").agg(weighted_mean("value", "weight").alias("value")))


def region_ranks(history: DataFrame, windows: Sequence[Window], target_year: int, first_year: int, last_year: int,
                 keys: Sequence[str] = ("sa2_code",), min_years: int = 10, median_floor: float | None = 0.1, **mtd) -> DataFrame:
    """Each region's window total ranked against its own complete years."""
    totals = window_totals(history, windows, target_year, keys, **mtd)
    return rank_target(totals, [*keys, "window"], target_year, first_year=first_year, last_year=last_year,
                       min_years=min_years, median_floor=median_floor)


def level_ranks(history: DataFrame, members: DataFrame, windows: Sequence[Window], target_year: int, first_year: int,
                last_year: int, level: Sequence[str], min_years: int = 10, **mtd) -> DataFrame:
    """Weighted window totals of SDs or states ranked against the same windows of other years."""
    series = weighted_series(window_totals(history, windows, target_year, **mtd), members, level)
    return rank_target(series, [*level, "window"], target_year, first_year=first_year, last_year=last_year, min_years=min_years)


def sd_members(concordance: DataFrame, areas: DataFrame, floor: float = 0.0, states: Sequence[str] | None = None) -> DataFrame:
    """Members of the SDs above an area floor, with the SD's dominant state."""
    m = joins.members(concordance, areas)
    size = m.groupBy("sd_code").agg(F.sum("weight").alias("sd_area")).where(F.col("sd_area") >= floor)
    state = joins.dominant(m, ["sd_code"], "state_name", "weight").select("sd_code", F.col("state_name").alias("sd_state"))
    if states is not None:
        state = state.where(F.col("sd_state").isin(*states))
    return m.join(size, "sd_code").join(state, "sd_code")


def sd_review(history: DataFrame, mtd: DataFrame, members: DataFrame, year: int, month: int, through_day: int,
              first_year: int) -> DataFrame:
    """One row per SD: month to date against the scaled month of earlier years."""
    w = [Window("month", month, month, True)]
    ranks = level_ranks(history, members, w, year, first_year, year - 1, ["sd_code"], min_years=1,
                        mtd=mtd, mtd_month=month, through_day=through_day)
    dim = members.groupBy("sd_code").agg(F.min("sd_name").alias("sd_name"), F.min("sd_state").alias("state"),
                                         F.min("sd_area").alias("sd_area"))
    return ranks.join(dim, "sd_code").drop("window")


def state_review(sd_rows: DataFrame, history: DataFrame, mtd: DataFrame, members: DataFrame, year: int, month: int,
                 through_day: int, first_year: int) -> DataFrame:
    """State rows: SD means re-weighted by area, ranks from the state's own members, and year to date."""
    w = F.col("sd_area")
    mean = sd_rows.groupBy("state").agg(
        F.sum(w).alias("area"), (F.sum(F.col("value") * w) / F.sum(w)).alias("rain_mm"),
        (F.sum(F.col("hist_median") * w) / F.sum(w)).alias("hist_scaled_median_mm"), F.count(F.lit(1)).alias("n_sds"))
    mean = mean.withColumn("pct_of_median", S.pct_of_median("rain_mm", "hist_scaled_median_mm"))
    m = members.withColumn("state", F.col("sd_state")).join(sd_rows.select("sd_code"), "sd_code", "left_semi")
    ranks = level_ranks(history, m, [Window("month", month, month, True), Window("ytd", 1, month, True)], year, first_year,
                        year - 1, ["state"], min_years=1, mtd=mtd, mtd_month=month, through_day=through_day)
    ytd = F.col("window") == "ytd"

    def pick(c, cond):
        return F.max(F.when(cond, F.col(c)))

    wide = ranks.groupBy("state").agg(
        *[pick(c, ~ytd).alias(c) for c in ("percentile_rank", "decile", "decile_decimal")],
        pick("value", ytd).alias("ytd_mm"), pick("hist_median", ytd).alias("ytd_median_mm"),
        pick("pct_of_median", ytd).alias("ytd_pct_of_median"), pick("percentile_rank", ytd).alias("ytd_percentile_rank"),
        pick("decile_decimal", ytd).alias("ytd_decile_decimal"))
    return mean.join(wide, "state", "left")


def sa2_review(history: DataFrame, mtd: DataFrame, areas: DataFrame, concordance: DataFrame, year: int, month: int,
               through_day: int, first_year: int) -> DataFrame:
    """One row per region with area: month to date against its own scaled history, with its main SD."""
    ranks = region_ranks(history, [Window("month", month, month, True)], year, first_year, year - 1, min_years=1,
                         median_floor=None, mtd=mtd, mtd_month=month, through_day=through_day)
    main = concordance.groupBy("sa2_code").agg(F.max_by(
        F.struct("sd_code", "sd_name"), F.struct("allocation_ratio", F.col("sd_code"))).alias("sd"))
    return (ranks.join(areas.where("area > 0").select("sa2_code", "area"), "sa2_code").join(main, "sa2_code")
            .select("*", "sd.sd_code", "sd.sd_name").drop("sd", "window"))


def sd_breakdown(history: DataFrame, members: DataFrame, mtd: DataFrame, season: Window, month: Window, target_year: int,
                 first_year: int, mtd_month: int, min_years: int = 1) -> DataFrame:
    """SD rows: season to date and month against weighted medians of the members, and the gap of
    the month in progress to the full-month median."""
    last = target_year - 1
    own = region_ranks(history, [season, month], target_year, first_year, last, min_years=min_years, median_floor=None)
    s, m = F.col("window") == season.label, F.col("window") == month.label
    wide = own.groupBy("sa2_code").agg(
        F.max(F.when(s, F.col("value"))).alias("std"), F.max(F.when(s, F.col("hist_median"))).alias("std_median"),
        F.max(F.when(m, F.col("value"))).alias("mon"), F.max(F.when(m, F.col("hist_median"))).alias("mon_median"),
    ).dropna()
    full = climatology(
        history.where((F.col("month") == mtd_month) & F.col("year").between(first_year, last)), ["sa2_code"], "rainfall_mm",
        (0.5,)).select("sa2_code", F.col("p50").alias("full_median"))
    now = mtd.where(F.col("year") == target_year).select("sa2_code", F.col("rainfall_mm").alias("mtd"))
    rows = members.join(wide, "sa2_code", "left").join(full, "sa2_code", "left").join(now, "sa2_code", "left")
    out = rows.groupBy("sd_code", "sd_name", "sd_state", "sd_area").agg(
        *[weighted_mean(c, "weight").alias(c) for c in ("std", "std_median", "mon", "mon_median", "mtd", "full_median")])
    ranks = level_ranks(history, members, [season, month], target_year, first_year, last, ["sd_code"], min_years)
    deciles = ranks.groupBy("sd_code").agg(
        F.max(F.when(s, F.col("decile"))).alias("std_decile"), F.max(F.when(m, F.col("decile"))).alias("mon_decile"))
    return (
        out.where(F.col("std").isNotNull() & F.col("mon").isNotNull()).join(deciles, "sd_code", "left")
        .withColumn("std_pct", S.pct_of_median("std", "std_median"))
        .withColumn("mon_pct", S.pct_of_median("mon", "mon_median"))
        .withColumn("gap_to_median", F.col("full_median") - F.col("mtd"))
        .withColumn("pct_of_full_median", S.pct_of_median("mtd", "full_median"))
    )


def year_over_year(history: DataFrame, members: DataFrame, windows: Sequence[Window], years: tuple[int, int], first_year: int,
                   level: Sequence[str], min_years: int, **mtd) -> DataFrame:
    """The same windows for two years side by side, each ranked against the earlier years.

    The earlier year always takes its scaled full month; the later one may take month to date.
    """
    before, now = years
    series = weighted_series(window_totals(history, windows, now, **mtd), members, level)
    # every row serves both targets, so one aggregation ranks the two years
    rows = series.select("*", F.explode(F.array(*[F.lit(y) for y in years])).alias("y")).where(
        (F.col("year") == F.col("y")) | (F.col("year") < before))
    both = rank_target(rows, [*level, "window", "y"], F.col("y"), first_year=first_year, last_year=before - 1, min_years=min_years)
    wide = []
    for y, tag in ((before, "before"), (now, "now")):
        for c in ("value", "pct_of_median", "decile_decimal"):
            wide.append(F.max(F.when(F.col("y") == y, F.col(c))).alias(f"{c}_{tag}"))
    return both.groupBy(*level, "window").agg(*wide)


def moisture_trajectory(history: DataFrame, mtd: DataFrame, weights: DataFrame, target_year: int, month: int, through_day: int,
                        first_year: int, on: Sequence[str] = ("sa2_code", "state_name")) -> DataFrame:
    """State trajectory: each finished month, the months so far, the month to date and their sum.

    Months are area-weighted first and then added, so a window needs every month of the state.
    """
    def monthly(df):
        ok = F.col("rainfall_mm").isNotNull() & (F.col("weight") > 0)
        return df.join(weights.select(*on, "weight"), list(on)).where(ok).groupBy("state_name", "year", "month").agg(
            weighted_mean("rainfall_mm", "weight").alias("rainfall_mm"))

    windows = [Window(calendar.month_abbr[m], m, m) for m in range(1, month)]
    windows += [Window("ytd", 1, month - 1), Window("mtd", month, month, True), Window("ytd_mtd", 1, month, True)]
    totals = window_totals(monthly(history), windows, target_year, ["state_name"], mtd=monthly(mtd), mtd_month=month,
                           through_day=through_day)
    return rank_target(totals, ["state_name", "window"], target_year, first_year=first_year, last_year=target_year - 1)


def seeding_conditions(history: DataFrame, mtd: DataFrame, target_year: int, month: int, through_day: int, first_year: int,
                       keys: Sequence[str] = ("sa2_code", "sa2_name", "sa3_name", "sa4_name")) -> DataFrame:
    """Last full month, month to date and their sum per region, with ranks and classes.

    Only regions that have both months count.
    """
    prev = month - 1
    windows = [Window("prev", prev, prev), Window("mtd", month, month, True), Window("both", prev, month, True)]
    totals = window_totals(history, windows, target_year, list(keys), mtd=mtd, mtd_month=month, through_day=through_day)
    ranks = rank_target(totals, [*keys, "window"], target_year, first_year=first_year, last_year=target_year - 1,
                        probs=(("p10", 0.1), ("p25", 0.25), ("p75", 0.75), ("p90", 0.9)), median_floor=0.1)

    def pick(c, w):
        return F.max(F.when(F.col("window") == w, F.col(c)))

    wide = ranks.groupBy(*keys).agg(*[
        pick(c, w).alias(f"{w}_{c}") for w in ("prev", "mtd", "both")
        for c in ("value", "hist_median", "percentile_rank", "pct_of_median", "decile")])
    return (
        wide.where(F.col("both_value").isNotNull())
        .withColumn("seeding_class", S.seeding_class("mtd_value"))
        .withColumn("season_class", S.season_class("both_value"))
    )


def class_rollup(conditions: DataFrame, group: str = "sa4_name") -> DataFrame:
    """Medians and class counts of seeding conditions by a wider region."""
    med = [F.median(c).alias(f"{c}_median") for c in ("prev_value", "mtd_value", "both_value", "both_percentile_rank")]
    counts = [F.count_if(F.col("seeding_class") == c).alias(n) for c, n in (
        ("Adequate", "n_adequate"), ("Marginal", "n_marginal"), ("Insufficient", "n_insufficient"))]
    counts += [F.count_if(F.col("season_class") == c).alias(n) for c, n in (
        ("Strong", "n_strong_season"), ("Below average", "n_below_avg"), ("Poor", "n_poor"))]
    return conditions.groupBy(group).agg(F.count(F.lit(1)).alias("n_sa2"), *med, *counts)


def band_area_share(drill: DataFrame, weights: DataFrame, on: Sequence[str] = ("sa2_code", "state_name"), strict: bool = True) -> DataFrame:
    """Per state: area share of dry, mid and wet regions, weighted and plain mean ranks, top-10 share."""
    if strict:
        drill = stored(drill, "drill")
        joins.fail_unless_empty(drill.select(*on).distinct().join(weights.select(*on), list(on), "left_anti"),
                                "regions without an area record")
    rows = drill.join(weights.select(*on, "weight"), list(on)).where("weight > 0").withColumn("band", S.band3("decile"))
    top = top_k(rows, ["state_name"], [F.desc("weight"), F.asc("sa2_code")], 10).groupBy("state_name").agg(
        F.sum("weight").alias("_top"))
    w = F.col("weight")
    share = lambda band: F.coalesce(F.sum(F.when(F.col("band") == band, w)), F.lit(0.0)) / F.sum(w) * 100
    out = rows.groupBy("state_name").agg(
        F.sum(w).alias("total_area_ha"), F.count(F.lit(1)).alias("n_sa2"),
        F.avg("percentile_rank").alias("unweighted_pct_rank"), weighted_mean("percentile_rank", "weight").alias("area_weighted_pct_rank"),
        F.avg("pct_of_median").alias("unweighted_pct_of_median"), weighted_mean("pct_of_median", "weight").alias("area_weighted_pct_of_median"),
        share("Dry (D1-D3)").alias("dry_share_pct"), share("Mid (D4-D7)").alias("mid_share_pct"), share("Wet (D8-D10)").alias("wet_share_pct"))
    return out.join(top, "state_name").withColumn("top10_share_pct", F.col("_top") / F.col("total_area_ha") * 100).drop("_top")


def area_rollup(drill: DataFrame, weights: DataFrame, group: Sequence[str] = ("state_name", "sa3_name"),
                on: Sequence[str] = ("sa2_code", "state_name")) -> DataFrame:
    """Area-weighted ranks of a mid-level region, with its share of the state."""
    rows = drill.join(weights.select(*on, "weight"), list(on)).where("weight > 0")
    state = rows.groupBy(group[0]).agg(F.sum("weight").alias("_state"))
    out = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_sa2"), F.sum("weight").alias("area_ha"),
        weighted_mean("percentile_rank", "weight").alias("area_weighted_pct_rank"),
        weighted_mean("pct_of_median", "weight").alias("area_weighted_pct_of_median"))
    return out.join(state, group[0]).withColumn("state_area_share_pct", F.col("area_ha") / F.col("_state") * 100).drop("_state")


def dual_window(ranks: DataFrame, keys: Sequence[str], early: str, late: str) -> DataFrame:
    """Class of an early and a late window's scores side by side."""
    def pick(w):
        return F.max(F.when(F.col("window") == w, F.col("decile_decimal")))

    wide = ranks.groupBy(*keys).agg(pick(early).alias("early_score"), pick(late).alias("late_score"))
    return wide.dropna(subset=["early_score", "late_score"]).withColumn("outlook", S.dual_window_class("early_score", "late_score"))


def east_west(ranks: DataFrame, lon: DataFrame, areas: DataFrame, group: str, window: str) -> DataFrame:
    """Area-weighted score of the halves of each group split at its median longitude."""
    rows = ranks.where(F.col("window") == window).join(lon, "sa2_code").join(areas, "sa2_code")
    mid = rows.groupBy(group).agg(F.median("lon").alias("median_lon"))
    rows = rows.join(mid, group).withColumn("half", F.when(F.col("lon") <= F.col("median_lon"), "west").otherwise("east"))
    return rows.groupBy(group, "half").agg(
        weighted_mean("decile_decimal", "area").alias("area_weighted_score"), F.count(F.lit(1)).alias("n_sa2"),
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"))


def with_total(rows: DataFrame, key: str, label: str, sums: Sequence[str]) -> DataFrame:
    """Rows per key plus a total row, from one rollup."""
    return level_totals(rows, [key], [label], sums)


def level_totals(rows: DataFrame, keys: Sequence[str], labels: Sequence[str], sums: Sequence[str] = (), means: dict[str, tuple[str, str]] | None = None,
                 least: Sequence[str] = (), most: Sequence[str] = ()) -> DataFrame:
    """Rows per key and the totals above them, from one rollup of mergeable sums.

    A total is made of its members, not of the rows below it: ``means`` maps a name to (value, weight), whose weighted mean
    is divided out after the sums are merged, so a state's ratio is that of its regions' members. ``least`` and ``most`` give
    ``min_`` and ``max_`` columns. A total row has its level's label in place of the key; null keys stay null.
    """
    aggregates = [F.sum(c).alias(c) for c in sums] + [weighted_mean(v, w).alias(name) for name, (v, w) in (means or {}).items()]
    aggregates += [F.min(c).alias(f"min_{c}") for c in least] + [F.max(c).alias(f"max_{c}") for c in most]
    out = rows.rollup(*keys).agg(*aggregates, *[F.grouping(k).alias(f"_total{i}") for i, k in enumerate(keys)])
    for i, (k, label) in enumerate(zip(keys, labels, strict=True)):
        out = out.withColumn(k, F.when(F.col(f"_total{i}") == 1, F.lit(label)).otherwise(F.col(k)))
    return out.drop(*[f"_total{i}" for i in range(len(keys))])

