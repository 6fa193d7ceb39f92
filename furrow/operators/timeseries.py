"""Daily-series operators: rolling totals, runs, gaps, seasonal break and dry spells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from furrow import params as P
from furrow.functions import scalar as S

BLOCK_DAYS = 512


def _with_time_blocks(df: DataFrame, date: str, reach: int, block_days: int) -> DataFrame:
    """Copy each row into its time block, and into the next one where a window there needs it.

    A station's history is cut into blocks of ``block_days``; the last ``reach`` days of a block
    are repeated at the head of the next with ``_halo`` set. Windows by (station, block) then see
    every day they need, and one long series spreads over many tasks.
    """
    day = F.unix_date(date)
    block = F.floor(day / block_days).cast("int")
    own = F.struct(block.alias("_block"), F.lit(False).alias("_halo"))
    nxt = F.struct((block + 1).alias("_block"), F.lit(True).alias("_halo"))
    copies = F.when(F.pmod(day, F.lit(block_days)) >= block_days - reach, F.array(own, nxt)).otherwise(F.array(own))
    return df.select("*", day.alias("_day"), F.explode(copies).alias("_b")).select("*", "_b._block", "_b._halo").drop("_b")


def rolling_totals(obs: DataFrame, days: Iterable[int] = (3, 7, 14), station: str = "station_id",
                   date: str = "date", value: str = "rainfall", min_valid: float | None = 0.8,
                   min_rows: bool = True, min_periods: int | None = None,
                   block_days: int = BLOCK_DAYS) -> DataFrame:
    """Add ``total_{n}d``: the sum over ``[d - (n-1), d]`` per station.

    NULL when the window holds fewer than n rows (``min_rows``) or fewer than ``min_valid * n``
    non-null values. ``min_periods`` replaces both gates with a plain non-null count. All window
    lengths share one exchange and one sort. Time blocks are at least as long as the longest window.
    """
    days = sorted(days)
    block_days = max(block_days, days[-1])
    base = W.partitionBy(station, "_block").orderBy("_day")
    totals = []
    for n in days:
        w = base.rangeBetween(-(n - 1), 0)
        gate = F.count(value).over(w) >= (min_periods if min_periods is not None else n * (min_valid or 0.0))
        if min_periods is None and min_rows:
            gate = gate & (F.count(F.lit(1)).over(w) >= n)
        totals.append(F.when(gate, F.sum(value).over(w)).alias(f"total_{n}d"))
    out = _with_time_blocks(obs, date, days[-1] - 1, block_days).select("*", *totals)
    return out.where(~F.col("_halo")).drop("_day", "_block", "_halo")


def _chained(summary: DataFrame, station: str, forward: bool) -> DataFrame:
    """Add ``_in`` (or ``_out``): days of the open run that a block takes over from the blocks before (after) it.

    A block hands on its outer run, and what it took over itself where all its days are one run: a segmented sum over
    block summaries, which are few.
    """
    order = W.partitionBy(station).orderBy(F.asc("_block") if forward else F.desc("_block"))
    near, far, length, name = ("_first", "_last", "_tail", "_in") if forward else ("_last", "_first", "_head", "_out")
    joined = F.coalesce(F.abs(F.col(near) - F.lag(far).over(order)) == 1, F.lit(False))
    through = joined & F.coalesce(F.lag("_runs").over(order) == 1, F.lit(False))
    rows = summary.select("*", joined.alias("_joined"), through.alias("_through"), F.lag(length).over(order).alias("_before"))
    rows = rows.withColumn("_segment", F.sum(F.when(F.col("_through"), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    so_far = W.partitionBy(station, "_segment").orderBy(F.asc("_block") if forward else F.desc("_block")).rowsBetween(W.unboundedPreceding, 0)
    taken = F.sum(F.when(F.col("_joined"), F.col("_before")).otherwise(0)).over(so_far)
    return rows.withColumn(name, taken).drop("_joined", "_through", "_before", "_segment")


def consecutive_runs(events: DataFrame, station: str = "station_id", date: str = "date", block_days: int = BLOCK_DAYS) -> DataFrame:
    """Number runs of consecutive dates per station.

    Adds ``run_position``, ``run_length`` and ``sequence_id`` (NULL for a single day), which counts a station's runs. Needs one
    row per station and date. Runs are found inside (station, time block); each block is summed up as its first and
    last day and its first and last run, the summaries are chained along the station, and their sums go back to the
    blocks, so no task sorts a station's whole record.
    """
    day = F.unix_date(date)
    rows = events.select("*", day.alias("_day"), F.floor(day / block_days).cast("int").alias("_block"))
    ordered = W.partitionBy(station, "_block").orderBy("_day")
    fresh = F.when(F.col("_day") - F.lag("_day").over(ordered) == 1, 0).otherwise(1)
    local = rows.withColumn("_fresh", fresh).withColumn("_k", F.sum("_fresh").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    run = W.partitionBy(station, "_block", "_k")
    local = local.withColumn("_n", F.count(F.lit(1)).over(run)).withColumn("_start", F.min("_day").over(run))
    summary = local.groupBy(station, "_block").agg(
        F.min("_day").alias("_first"), F.max("_day").alias("_last"), F.max("_k").alias("_runs"), F.min_by("_n", "_day").alias("_head"),
        F.max_by("_n", "_day").alias("_tail"))
    chained = _chained(_chained(summary, station, True), station, False)
    order = W.partitionBy(station).orderBy("_block")
    own = F.col("_runs") - F.when(F.col("_in") > 0, 1).otherwise(0)
    chained = chained.withColumn("_base", F.sum(own).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("_runs"))
    out = local.join(chained.select(F.col(station).alias("_s"), F.col("_block").alias("_b"), "_runs", "_in", "_out", "_base"),
                     (F.col(station) == F.col("_s")) & (F.col("_block") == F.col("_b")))
    before = F.when(F.col("_k") == 1, F.col("_in")).otherwise(0)
    after = F.when(F.col("_k") == F.col("_runs"), F.col("_out")).otherwise(0)
    length = F.col("_n") + before + after
    return out.select(
        *events.columns, (F.col("_day") - F.col("_start") + 1 + before).cast("int").alias("run_position"), length.alias("run_length"),
        F.when(length > 1, F.concat(F.col(station), F.lit("_seq_"), (F.col("_base") + F.col("_k")).cast("string"))).alias("sequence_id"))


def date_gaps(obs: DataFrame, station: str = "station_id", date: str = "date") -> DataFrame:
    """Breaks of more than one day in a station's record."""
    days = obs.select(station, date).distinct()
    prev = F.lag(date).over(W.partitionBy(station).orderBy(date))
    return (
        days.withColumn("gap_start", prev)
        .where(F.datediff(F.col(date), F.col("gap_start")) > 1)
        .select(station, "gap_start", F.col(date).alias("gap_end"),
                (F.datediff(F.col(date), F.col("gap_start")) - 1).alias("gap_days"))
    )


def _season_windows(obs: DataFrame, station: str, date: str, value: str) -> DataFrame:
    """Daily rows with trailing totals that only see days inside the season slice.

    The slices lie inside one calendar year, so windows go by (station, year): groups of at most
    366 rows, whatever the length of the record.
    """
    month = F.month(date)
    in_sowing, in_season = month.between(4, 6), month.between(4, 10)
    base = W.partitionBy(station, "season_year").orderBy("_day")
    w7, w14 = base.rangeBetween(-6, 0), base.rangeBetween(-13, 0)
    v = F.col(value)
    days = obs.select("*", F.year(date).alias("season_year"), F.unix_date(date).alias("_day"), month.alias("_month"),
                      F.when(in_sowing, v).alias("_sow"), F.when(in_season, v).alias("_inn"))
    full7 = F.when(in_season & (F.count("_inn").over(w7) >= 7), F.sum("_inn").over(w7))
    full14 = F.when(in_season & (F.count("_inn").over(w14) >= 14), F.sum("_inn").over(w14))
    return days.select("*", F.when(in_sowing, F.sum("_sow").over(w7)).alias("_sow7"), full7.alias("_dry7"), full14.alias("_dry14"))


def _break_columns(date: str, value: str) -> list:
    trigger = F.col("_month").between(4, 6) & (
        (F.col(value) >= P.BREAK_DAY_MM) | (F.col("_sow7") >= P.BREAK_7D_MM))
    day = F.when(trigger, F.col(date))
    return [F.min(day).alias("autumn_break_date"), F.min_by("_sow7", day).alias("autumn_break_7d_mm")]


def _dry7():
    return F.col("_dry7") < P.DRY_SPELL_7D_MM


def _dry14():
    return F.col("_dry14") < P.DRY_SPELL_14D_MM


def _dry_columns(value: str) -> list:
    seen = F.count(F.when(F.col("_month").between(4, 10), F.col(value))) > 0
    return [F.when(seen, F.count_if(_dry7()).cast("double")).alias("dry_spell_days_7d_lt_5mm"),
            F.when(seen, F.count_if(_dry14()).cast("double")).alias("dry_spell_days_14d_lt_10mm")]


def _break_status():
    return F.coalesce(S.break_status_date("autumn_break_date"), F.lit("absent"))


def autumn_break(obs: DataFrame, station: str = "station_id", date: str = "date",
                 value: str = "rainfall") -> DataFrame:
    """First Apr-Jun day of each season with a wet day or a wet week, and its class."""
    rows = _season_windows(obs, station, date, value)
    return (rows.groupBy(station, "season_year").agg(*_break_columns(date, value))
            .withColumn("autumn_break_status", _break_status()))


def dry_spell_days(obs: DataFrame, station: str = "station_id", date: str = "date",
                   value: str = "rainfall") -> DataFrame:
    """Apr-Oct days whose full trailing 7 or 14 days stay under the dry limits."""
    rows = _season_windows(obs, station, date, value)
    return rows.groupBy(station, "season_year").agg(*_dry_columns(value))


def season_features(obs: DataFrame, min_coverage: float = 0.8, station: str = "station_id",
                    date: str = "date", value: str = "rainfall", quality: str = "rainfall_quality") -> DataFrame:
    """One row per station and calendar-year season: totals, break, dry spells, coverage, flag.

    Everything comes from one exchange on (station, season): the trailing windows run there and
    the season aggregate reuses their partitioning.
    """
    clean = (
        obs.where(~F.col(station).startswith("DD_"))
        .withColumn(value, F.when(F.coalesce(F.col(quality), F.lit(0)) != P.MISSING_CODE, S.clean_number(value)))
    )
    rows = _season_windows(clean, station, date, value)
    code = F.coalesce(F.col(quality), F.lit(P.MISSING_CODE))
    # months first: few aggregates over the daily rows, the wide ones over twelve rows per season;
    # both steps stay on the (station, season) partitioning of the windows
    by_month = rows.groupBy(station, "season_year", "_month").agg(
        F.sum(value).alias("_s"), F.count(value).alias("_v"), F.count(F.lit(1)).alias("_n"),
        *_break_columns(date, value), F.count_if(_dry7()).alias("_d7"), F.count_if(_dry14()).alias("_d14"),
        F.count(quality).alias("_nq"), F.sum(S.quality_confidence(code)).alias("_score"), F.max(date).alias("_last"),
    )
    per_month = []
    for m in range(1, 13):
        here = F.col("_month") == m
        per_month += [F.max(F.when(here, F.col(c))).alias(f"{c}{m}") for c in ("_s", "_v", "_n")]
    in_season = F.col("_month").between(4, 10)
    seen = F.coalesce(F.sum(F.when(in_season, F.col("_v"))), F.lit(0)) > 0
    agg = by_month.groupBy(station, "season_year").agg(
        *per_month, F.min("autumn_break_date").alias("autumn_break_date"),
        F.min_by("autumn_break_7d_mm", "autumn_break_date").alias("autumn_break_7d_mm"),
        F.when(seen, F.sum("_d7").cast("double")).alias("dry_spell_days_7d_lt_5mm"),
        F.when(seen, F.sum("_d14").cast("double")).alias("dry_spell_days_14d_lt_10mm"),
        F.sum("_nq").alias("_nq"), (F.sum("_score") / F.sum("_n")).alias("_score"),
        F.sum("_n").alias("_rows"), F.max("_last").alias("_last"),
    )

    def over(prefix, lo, hi):
        return sum((F.coalesce(F.col(f"{prefix}{m}"), F.lit(0)) for m in range(lo, hi + 1)), F.lit(0))

    def window_total(lo, hi):
        valid = over("_v", lo, hi)
        return F.when(F.try_divide(valid, over("_n", lo, hi)) >= F.when(valid > 0, min_coverage), over("_s", lo, hi).cast("double"))

    y = F.col("season_year")
    jan1, dec31 = F.make_date(y, F.lit(1), F.lit(1)), F.make_date(y, F.lit(12), F.lit(31))
    end = F.least(dec31, F.col("_last"))

    def elapsed(m1, d1, m2, d2):
        start, stop = F.make_date(y, F.lit(m1), F.lit(d1)), F.make_date(y, F.lit(m2), F.lit(d2))
        return F.when(end >= start, F.greatest(F.datediff(F.least(stop, end), start) + 1, F.lit(1))).otherwise(1)

    season_cov = F.col("_rows") / F.greatest(F.datediff(end, jan1) + 1, F.lit(1))
    months = [window_total(m, m).alias(f"monthly_rainfall_{P.MONTH_ABBR[m - 1]}_mm") for m in range(1, 13)]
    windows = [window_total(lo, hi).alias(name) for name, (lo, hi) in P.SEASON_WINDOWS.items()]
    return (
        agg.select(
            station, "season_year", *months, *windows,
            "autumn_break_date", "autumn_break_7d_mm", _break_status().alias("autumn_break_status"),
            "dry_spell_days_7d_lt_5mm", "dry_spell_days_14d_lt_10mm",
            F.when(F.col("_nq") == 0, P.QUALITY_CONFIDENCE_DEFAULT).otherwise(F.col("_score")).alias("data_quality_score"),
            season_cov.alias("season_coverage_ratio"),
            (over("_n", 4, 6) / elapsed(4, 1, 6, 30)).alias("sowing_window_coverage_ratio"),
            (over("_n", 5, 10) / elapsed(5, 1, 10, 31)).alias("in_crop_coverage_ratio"),
            (end < dec31).alias("is_in_progress"),
        )
        .where(F.col("season_coverage_ratio") >= min_coverage * 0.5)
        .withColumn("feature_quality_flag", S.feature_quality_flag(
            "season_coverage_ratio", "sowing_window_coverage_ratio", "in_crop_coverage_ratio",
            "is_in_progress", min_coverage))
    )
