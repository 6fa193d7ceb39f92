"""Climatology and rank operators over yearly values per key.

Baselines hold one value per key and year, so the arrays built here are at most as long as the
record has years. ``require_unique`` checks that contract where the input is not built that way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from furrow.functions import ranks as R
from furrow.functions import scalar as S
from furrow.session import stored


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "rows") -> DataFrame:
    """Return ``df`` after checking that ``keys`` identify its rows; raises otherwise."""
    clash = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if clash:
        raise ValueError(f"{what}: duplicate key {clash[0].asDict()}")
    return df


def pairwise_rank(target: DataFrame, baseline: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rank target values against a separate baseline table: n, below and the three conventions.

    The baseline is folded to one ascending array per key before the join, so no
    target-by-baseline pairs are formed.
    """
    arrays = baseline.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.array_sort(F.collect_list(value)).alias("_base"))
    out = target.join(arrays, list(keys), "left").withColumn("_base", F.coalesce("_base", F.array().cast("array<double>")))
    return _rank_columns(out, value, "_base")


def _rank_columns(df: DataFrame, value: str, arr: str) -> DataFrame:
    return (
        df.withColumns({"n_hist_years": F.size(arr), "below": R.count_below(arr, value)})
        .withColumns({
            "percentile_rank": R.percentile_rank("below", "n_hist_years"),
            "decile": R.decile_rank("below", "n_hist_years"),
            "decile_decimal": R.decile_score("below", "n_hist_years"),
        })
        .drop(arr)
    )


def rank_target(series: DataFrame, keys: Sequence[str], target_year: int | Column, year: str = "year",
                value: str = "value", first_year: int | None = None, last_year: int | None = None,
                min_years: int = 1, probs: Sequence[tuple[str, float]] = (("p10", 0.1), ("p90", 0.9)),
                median_floor: float | None = None, carry: Sequence[Column] = ()) -> DataFrame:
    """Compare each key's target-year value with its other years in one aggregation.

    The baseline is every year in ``[first_year, last_year]`` except the target. Output per key:
    value, n, median, mean, quantiles, share of median, percentile rank, decile and score. Keys
    without a target value or with fewer than ``min_years`` baseline years are left out.
    """
    y, v = F.col(year), F.col(value)
    is_target = y == target_year
    in_base = ~is_target & v.isNotNull()
    if first_year is not None:
        in_base = in_base & (y >= first_year)
    if last_year is not None:
        in_base = in_base & (y <= last_year)
    agg = series.groupBy(*keys).agg(
        F.max(F.when(is_target, v)).alias(value),
        F.array_sort(F.collect_list(F.when(in_base, v))).alias("_base"),
        *carry,
    ).where(F.col(value).isNotNull() & (F.size("_base") >= max(min_years, 1)))
    agg = agg.withColumns({
        "hist_median": R.sorted_quantile("_base", 0.5), "hist_mean": R.array_mean("_base"),
        **{f"hist_{name}": R.sorted_quantile("_base", p) for name, p in probs},
    })
    agg = agg.withColumns({"pct_of_median": S.pct_of_median(value, "hist_median", median_floor),
                           "anomaly": F.col(value) - F.col("hist_median")})
    return _rank_columns(agg, value, "_base")


def climatology(series: DataFrame, keys: Sequence[str], value: str = "value",
                probs: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Linear-interpolated percentiles, extremes and count of yearly values per key."""
    agg = series.groupBy(*keys).agg(
        F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias("_q"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("n_years"))
    cols = [F.get("_q", F.lit(i)).alias(f"p{round(p * 100)}") for i, p in enumerate(probs)]
    return agg.select(*keys, *cols, "min", "max", "n_years")


def leave_year_out(df: DataFrame, keys: Sequence[str], year: str = "year", value: str = "rainfall_mm",
                   partial: str | None = "is_partial_month", min_history: int = 10,
                   baseline: str | tuple[int, int] = "others") -> DataFrame:
    """Climatology, anomaly and decile of every row against the key's other years.

    Partial and NULL rows never enter a baseline. ``baseline`` is ``'others'`` (all other years),
    ``'prior'`` (earlier years) or a year range. One exchange on the keys: a single ordered window
    yields the rank, the moments and the ascending array the median is read from.
    """
    is_partial = F.coalesce(F.col(partial), F.lit(False)) if partial else F.lit(False)
    member = ~is_partial & F.col(value).isNotNull()
    ordered = W.partitionBy(*keys).orderBy(F.col("_member").desc(), F.col(value), F.col(year))
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    df = df.withColumn("_member", member)
    v = F.when(F.col("_member"), F.col(value))
    if baseline == "others":
        df = (
            df.withColumn("_arr", F.collect_list(v).over(whole))
            .withColumn("_pos", F.row_number().over(ordered))
            .withColumn("_rank", F.rank().over(W.partitionBy(*keys).orderBy(F.col("_member").desc(), F.col(value))))
            .withColumn("_sum", F.sum(v).over(whole))
        )
        own = F.col("_member").cast("int")
        n = F.size("_arr") - own
        below = F.col("_rank") - 1
        median = R.median_without("_arr", "_pos")
        mean = F.try_divide(F.col("_sum") - F.col(value), n)
    else:
        df = df.withColumn("_pairs", F.collect_list(
            F.when(F.col("_member"), F.struct(F.col(value).alias("v"), F.col(year).alias("y")))).over(whole))
        if baseline == "prior":
            keep = lambda p: p["y"] < F.col(year)
        else:
            lo, hi = baseline
            keep = lambda p: p["y"].between(lo, hi) & (p["y"] != F.col(year))
        df = df.withColumn("_arr", F.transform(F.filter("_pairs", keep), lambda p: p["v"])).drop("_pairs")
        n = F.size("_arr")
        below = R.count_below("_arr", value)
        median = R.sorted_quantile("_arr", 0.5)
        mean = R.array_mean("_arr")
    flag = S.cases(
        (is_partial, "partial_month_no_decile"),
        (F.col(value).isNull(), "null_rainfall"),
        (F.col("historical_year_count") < min_history,
         F.concat(F.lit("insufficient_history("), F.col("historical_year_count").cast("string"), F.lit(")"))),
        otherwise="ok",
    )
    ok = F.col("climatology_quality_flag") == "ok"
    return (
        df.withColumn("historical_year_count", n)
        .withColumn("climatology_quality_flag", flag)
        .withColumn("historical_median_mm", F.when(ok, median))
        .withColumn("historical_mean_mm", F.when(ok, mean))
        .withColumn("anomaly_mm", F.when(ok, F.col(value) - F.col("historical_median_mm")))
        .withColumn("anomaly_pct", F.col("anomaly_mm") / F.nullif(F.col("historical_median_mm"), F.lit(0.0)) * 100)
        .withColumn("rainfall_decile", F.when(ok, R.decile_rank(below, "historical_year_count")))
        .withColumn("rainfall_decile_label", S.decile_label("rainfall_decile"))
        .drop("_member", "_arr", "_pos", "_rank", "_sum")
    )


def weighted_deciles(history: DataFrame, weights: DataFrame, on: Sequence[str] = ("sa2_code",),
                     scope: Sequence[str] = ("state_name",), region: str = "sa2_code", value: str = "rainfall_mm",
                     weight: str = "weight", min_share: float = 0.8, min_history: int = 10) -> DataFrame:
    """Area-weighted monthly totals ranked against years recomputed on the same set of regions.

    Target months that share the set of regions with data share a baseline, so baselines are
    built per distinct set, not per pair of years. A set is identified by its size and two
    64-bit fingerprints; with no gaps in the data there is one set per month.
    """
    scope = list(scope)
    usable = weights.where(F.col(weight).isNotNull())
    universe = usable.groupBy(*scope).agg(F.sum(weight).alias("universe_area"), F.count(F.lit(1)).alias("n_universe"))
    rows = history.join(usable.select(*dict.fromkeys([*on, *scope]), weight), list(dict.fromkeys([*on, *scope])))
    key = [*scope, "month"]
    # one row per region and month with its years as an array: stored, for both branches below read it
    per_region = stored(rows.groupBy(*key, region, F.col(weight).alias("_w")).agg(F.collect_list(F.struct(
        "year", F.col(value).alias("v"), F.coalesce("is_partial_month", F.lit(False)).alias("p"))).alias("_years")), "region-years")
    years = per_region.select(*key, region, "_w", F.explode("_years").alias("y"))
    v, w = F.col("y.v"), F.col("_w")
    has = v.isNotNull()
    month = years.groupBy(*key, F.col("y.year").alias("year")).agg(
        F.sum(F.when(has, v * w)).alias("_vw"),
        F.sum(F.when(has, w)).alias("weighting_area"),
        F.count_if(has).alias("n_weighted"),
        F.count_if(~has).alias("n_missing"),
        F.max("y.p").alias("is_partial_month"),
        F.bit_xor(F.when(has, F.xxhash64(region))).alias("_f1"),
        F.bit_xor(F.when(has, F.xxhash64(F.lit("set"), region))).alias("_f2"),
    ).withColumn("rainfall_mm_wt", F.col("_vw") / F.nullif("weighting_area", F.lit(0.0)))
    mask = [*key, "n_weighted", "_f1", "_f2"]
    sets = month.where("n_weighted > 0").groupBy(*mask).agg(F.min("year").alias("_example"))
    # a region belongs to a set when it has data in the set's example year
    in_set = F.exists("_years", lambda y: (y["year"] == F.col("_example")) & y["v"].isNotNull())
    members = per_region.join(sets, key).where(in_set).select(*mask, "_w", F.explode("_years").alias("y"))
    totals = (
        members.where(has & ~F.col("y.p")).groupBy(*mask, F.col("y.year").alias("year"))
        .agg((F.sum(v * w) / F.nullif(F.sum(w), F.lit(0.0))).alias("_total"))
        .where(F.col("_total").isNotNull())
    )
    baselines = totals.groupBy(*mask).agg(F.array_sort(F.collect_list(F.struct("_total", "year"))).alias("_pairs"))
    out = month.join(baselines, mask, "left")
    out = out.join(universe, scope)
    others = F.filter(F.coalesce("_pairs", F.array().cast("array<struct<_total:double,year:int>>")),
                      lambda p: p["year"] != F.col("year"))
    out = out.withColumn("_base", F.transform(others, lambda p: p["_total"]))
    share = F.col("weighting_area") / F.nullif("universe_area", F.lit(0.0))
    out = out.withColumn("weighting_area_share", share)
    comparable = F.col("rainfall_mm_wt").isNotNull() & ~F.col("is_partial_month") & (
        F.coalesce(F.col("weighting_area_share") >= min_share, F.lit(True)))
    out = out.withColumn("historical_year_count", F.when(comparable, F.size("_base")).otherwise(0))
    flag = S.cases(
        (F.col("rainfall_mm_wt").isNull(), "null_weighted_rainfall"),
        (F.col("is_partial_month"), "partial_month"),
        (F.col("weighting_area_share") < min_share, "low_coverage"),
        (F.col("historical_year_count") < min_history, "insufficient_history"),
        otherwise="ok",
    )
    out = out.withColumn("climatology_quality_flag", flag)
    ok = F.col("climatology_quality_flag") == "ok"
    return (
        out.withColumn("historical_median_mm_wt", F.when(ok, R.sorted_quantile("_base", 0.5)))
        .withColumn("historical_mean_mm_wt", F.when(ok, R.array_mean("_base")))
        .withColumn("anomaly_mm_wt", F.col("rainfall_mm_wt") - F.col("historical_median_mm_wt"))
        .withColumn("anomaly_pct_wt",
                    F.col("anomaly_mm_wt") / F.nullif(F.col("historical_median_mm_wt"), F.lit(0.0)) * 100)
        .withColumn("rainfall_decile", F.when(ok, R.decile_rank(R.count_below("_base", "rainfall_mm_wt"),
                                                               "historical_year_count")))
        .withColumn("rainfall_decile_label", S.decile_label("rainfall_decile"))
        .drop("_vw", "_f1", "_f2", "_pairs", "_base")
    )


def cell_percentiles(grid: DataFrame, month: int, target_year: int, first_year: int, last_year: int,
                     cell: str = "cell_id", value: str = "mm") -> DataFrame:
    """Per-cell ``(below + 1) / n`` percentile of one month against a year range."""
    y = F.col("year")
    rows = grid.where((F.col("month") == month) & ((y == target_year) | y.between(first_year, last_year)))
    agg = rows.groupBy(cell).agg(
        F.max(F.when(y == target_year, F.col(value))).alias("target_mm"),
        F.collect_list(F.when(y.between(first_year, last_year), F.col(value))).alias("_base"))
    return agg.select(
        cell, "target_mm", F.size("_base").alias("n_valid"),
        R.cell_percentile(R.count_below("_base", "target_mm"), F.size("_base")).alias("percentile"))


def grid_decile_class(grid: DataFrame, month: int, target_year: int, first_year: int, last_year: int,
                      cell: str = "cell_id", value: str = "mm", scale: float = 1.0) -> DataFrame:
    """Per-cell class 0-6 with record tiers; a cell needs every baseline year."""
    y = F.col("year")
    rows = grid.where((F.col("month") == month) & ((y == target_year) | y.between(first_year, last_year)))
    agg = rows.groupBy(cell).agg(
        F.max(F.when(y == target_year, F.col(value))).alias("target_mm"),
        F.collect_list(F.when(y.between(first_year, last_year) & (y != target_year), F.col(value) * scale)).alias("_base"))
    years = last_year - first_year + 1 - int(first_year <= target_year <= last_year)
    out = agg.where(F.col("target_mm").isNotNull() & (F.size("_base") == years)).withColumn(
        "below", R.count_below("_base", "target_mm"))
    pr = F.col("below") / years * 100.0
    cls = S.cases((F.col("below") == years, 6), (F.col("below") == 0, 0), (pr >= 90, 5), (pr >= 70, 4),
                  (pr >= 30, 3), (pr >= 10, 2), otherwise=1)
    return out.select(cell, "target_mm", F.lit(years).alias("n_years"), pr.alias("percentile"), cls.alias("decile_class"))
