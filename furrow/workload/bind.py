"""Roles of the climate tables filled from the warehouse tables, in Spark and as SQL twins.

Each ``*_df`` function builds one role table; ``CTES`` holds the same rule as SQL so a second
engine can check the operators that run on top. Values are arithmetic on keys, chosen to be
exact in binary so both engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions import scalar as S
from furrow.session import stored

QUALITY_CODES = (0, 0, 0, 0, 15, 25, 35, 75, 999, 23)
PARTIAL_YEAR, PARTIAL_MONTH = 2001, 11
TARGET_YEAR, MTD_MONTH, MTD_DAY = 2001, 5, 20
GRID_LAT0, GRID_LON0, GRID_RES, GRID_ROWS, GRID_COLS = -44.0, 112.0, 0.05, 681, 841

# (ring, dx1, dy1, dx2, dy2) offsets of a region's outline and of its hole around the centre
OUTLINE = (
    (0, -4.0, 0.0, -1.0, 3.0), (0, -1.0, 3.0, 2.0, 3.0), (0, 2.0, 3.0, 4.0, 0.0), (0, 4.0, 0.0, 0.0, -3.0),
    (0, 0.0, -3.0, -4.0, 0.0),
    (1, -0.5, -0.5, -0.5, 0.5), (1, -0.5, 0.5, 0.5, 0.5), (1, 0.5, 0.5, 0.5, -0.5), (1, 0.5, -0.5, -0.5, -0.5),
)


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _quality(key, shift: int):
    codes = F.array(*[F.lit(c) for c in QUALITY_CODES])
    return F.get(codes, ((key + shift) % 10).cast("int"))


def obs_df(spark, sf) -> DataFrame:
    """Daily observations: one station per supplier."""
    daily = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(F.sum("l_quantity").alias("q"), F.min("l_orderkey").alias("ok"))
    )
    ok = F.col("ok")
    return daily.select(
        S.zfill("l_suppkey", 6).alias("station_id"),
        "date",
        ((ok % 21) * 0.5 - 4.0).alias("min_temp"),
        ((ok % 27) * 0.5 + 24.0).alias("max_temp"),
        F.when(ok % 41 != 0, F.col("q")).alias("rainfall"),
        _quality(ok, 0).alias("min_temp_quality"),
        _quality(ok, 3).alias("max_temp_quality"),
        F.when(ok % 13 != 0, _quality(ok, 7)).alias("rainfall_quality"),
    )


def dense_obs_df(spark, sf) -> DataFrame:
    """Daily observations close to gap-free: one station per nation."""
    per_station = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("date"))
        .agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("ok"))
    )
    nation_of = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    daily = (
        per_station.join(nation_of, "l_suppkey")
        .groupBy("s_nationkey", "date")
        .agg(F.sum("q").alias("q"), F.sum("n").alias("n"), F.min("ok").alias("ok"))
    )
    ok = F.col("ok")
    wet = F.floor(F.col("q") * 4 / F.col("n")) / 16.0
    return daily.select(
        S.zfill("s_nationkey", 6).alias("station_id"),
        "date",
        ((ok % 21) * 0.5 - 4.0).alias("min_temp"),
        ((ok % 27) * 0.5 + 24.0).alias("max_temp"),
        F.when(ok % 41 != 0, F.when(F.dayofyear("date") % 28 < 12, 0.0).otherwise(wet)).alias("rainfall"),
        _quality(ok, 0).alias("min_temp_quality"),
        _quality(ok, 3).alias("max_temp_quality"),
        F.when(ok % 13 != 0, _quality(ok, 7)).alias("rainfall_quality"),
    )


def regions_df(spark, sf) -> DataFrame:
    """Region dimension: SA2 = nation, state = region."""
    n = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    digit = (F.col("n_regionkey") + 1).cast("string")
    code9 = F.concat(digit, F.lit("0100"), F.lpad((F.col("n_nationkey") + 1000).cast("string"), 4, "0"))
    return n.select(
        "n_nationkey",
        code9.alias("sa2_code"),
        S.code9_to_5(code9).alias("sa2_5"),
        F.col("n_name").alias("sa2_name"),
        F.concat("r_name", F.lit("_"), (F.floor(F.col("n_nationkey") / 5) % 3).cast("string")).alias("sa3_name"),
        F.concat("r_name", F.lit("_"), (F.floor(F.col("n_nationkey") / 5) % 2).cast("string")).alias("sa4_name"),
        (F.col("n_regionkey") + 1).alias("state_code"),
        F.col("r_name").alias("state_name"),
    )


def stations_df(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    return (
        table(spark, sf, "supplier")
        .join(regions_df(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            S.zfill(k, 6).alias("station_id"),
            F.col("s_name").alias("name"),
            (F.lit(GRID_LAT0) + (k * 7 % GRID_ROWS) * F.lit(GRID_RES)).alias("latitude"),
            (F.lit(GRID_LON0) + (k * 13 % GRID_COLS) * F.lit(GRID_RES)).alias("longitude"),
            "sa2_code", "sa2_5", "sa2_name", "sa3_name", "sa4_name", "state_code", "state_name",
            F.greatest(F.floor("s_acctbal"), F.lit(0)).cast("int").alias("cropping_area"),
        )
    )


def region_month_df(spark, sf) -> DataFrame:
    """Monthly rainfall per region with nulls and one partial month."""
    d = F.to_date("l_shipdate")
    per_station = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.year(d).alias("year"), F.month(d).alias("month"))
        .agg(
            F.sum("l_quantity").alias("q"),
            F.sum(F.when(F.day(d) <= MTD_DAY, F.col("l_quantity"))).alias("q20"),
            F.count(F.lit(1)).alias("n"),
            F.max(F.day(d)).alias("last_day"),
        )
    )
    nation_of = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    monthly = (
        per_station.join(nation_of, "l_suppkey")
        .groupBy("s_nationkey", "year", "month")
        .agg(F.sum("q").alias("q"), F.sum("q20").alias("q20"), F.sum("n").alias("n"),
             F.max("last_day").alias("last_day"))
    )
    partial = (F.col("year") == PARTIAL_YEAR) & (F.col("month") == PARTIAL_MONTH)
    null_cell = (F.col("s_nationkey") * 7 + F.col("year") * 3 + F.col("month")) % 53 == 0
    return monthly.join(regions_df(spark, sf), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "state_name", "sa2_code", "sa2_5", "sa2_name", "sa3_name", "sa4_name", "year", "month",
        F.when(~null_cell, F.floor(F.col("q") * 4 / F.col("n")) / 4.0).alias("rainfall_mm"),
        (F.floor(F.coalesce("q20", F.lit(0.0)) * 4 / F.col("n")) / 4.0).alias("to_day_mm"),
        partial.alias("is_partial_month"),
        F.when(partial, F.col("last_day")).alias("partial_month_through_day"),
    )


def history_df(spark, sf, months: DataFrame | None = None) -> DataFrame:
    """Region months known before the month-to-date cut: later months of the target year absent."""
    months = region_month_df(spark, sf) if months is None else months
    return months.where(
        (F.col("year") < TARGET_YEAR) | ((F.col("year") == TARGET_YEAR) & (F.col("month") < MTD_MONTH)))


def mtd_df(spark, sf, months: DataFrame | None = None) -> DataFrame:
    """Month-to-date totals of the target month."""
    months = region_month_df(spark, sf) if months is None else months
    return (
        months.where((F.col("year") == TARGET_YEAR) & (F.col("month") == MTD_MONTH))
        .select("state_name", "sa2_code", "sa2_5", "sa2_name", "sa3_name", "sa4_name", "year", "month",
                F.when(F.col("rainfall_mm").isNotNull(), F.col("to_day_mm")).alias("rainfall_mm"),
                F.lit(MTD_DAY).alias("partial_month_through_day"))
    )


def history_and_mtd(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both views of the region months from one stored copy, so the line items are scanned once."""
    months = stored(region_month_df(spark, sf), "region-month")
    return history_df(spark, sf, months), mtd_df(spark, sf, months)


def crop_context_df(spark, sf) -> DataFrame:
    """Crop area, production and yield per region and crop, with suppressed cells."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    agg = (
        table(spark, sf, "customer")
        .groupBy("c_nationkey", F.lower("c_mktsegment").alias("crop"))
        .agg(F.sum(cents).alias("cents"), F.count(F.lit(1)).alias("n"))
    )
    suppressed = (F.col("c_nationkey") + F.length("crop")) % 7 == 0
    no_fallback = F.col("c_nationkey") % 9 == 4
    area = F.when(~suppressed, F.floor(F.col("cents") / 10000.0).cast("double"))
    return agg.join(regions_df(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey", "sa2_code", F.col("sa2_5").alias("station_sa2_5dig16"), "sa2_name", "sa3_name", "sa4_name",
        F.col("state_name").alias("state"), F.lit("2020-21").alias("financial_year"), "crop",
        area.alias("area_ha"),
        F.coalesce(area, F.when(~no_fallback, F.col("n") * 10.0)).alias("area_ha_for_weighting"),
        (suppressed & ~no_fallback).alias("area_is_fallback"),
        (F.col("n") * 3.0).alias("production_t"),
    )


def weights_df(spark, sf, crop: str = "building") -> DataFrame:
    return crop_context_df(spark, sf).where(F.col("crop") == crop).select(
        "sa2_code", F.col("station_sa2_5dig16").alias("sa2_5"), F.col("state").alias("state_name"),
        F.col("area_ha_for_weighting").alias("weight"))


def concordance_df(spark, sf) -> DataFrame:
    """Two overlaps per region with ratios 0.75 and 0.25; a few spill into the next state."""
    r = regions_df(spark, sf)
    n = F.col("n_nationkey")
    first = F.struct(
        (F.col("state_code") * 100 + F.floor(n / 5) % 3).alias("sd"), F.col("state_code").alias("st"),
        F.lit(0.75).alias("ratio"))
    spill = F.when(n % 8 == 7, F.col("state_code") % 5 + 1).otherwise(F.col("state_code"))
    second = F.struct(
        (spill * 100 + (F.floor(n / 5) + 1) % 3).alias("sd"), spill.alias("st"), F.lit(0.25).alias("ratio"))
    return r.select("sa2_code", "sa2_5", "sa2_name", "state_name", F.explode(F.array(first, second)).alias("o")).select(
        "sa2_code", "sa2_5", "sa2_name", "state_name",
        F.col("o.sd").cast("int").cast("string").alias("sd_code"),
        F.concat(F.lit("SD_"), F.col("o.sd").cast("int").cast("string")).alias("sd_name"),
        F.col("o.st").cast("string").alias("sd_state_code"),
        F.col("o.ratio").alias("allocation_ratio"),
    )


def production_df(spark, sf) -> DataFrame:
    """State production in long form: metric Area and Production per state and season."""
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    per_customer = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("crop_season"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("o_totalprice").cast("bigint")).alias("p"))
    )
    r = regions_df(spark, sf).select("n_nationkey", "state_name")
    wide = (
        per_customer.join(cust, "o_custkey").join(r, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("state_name").alias("state"), "crop_season")
        .agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    )
    rows = F.array(
        F.struct(F.lit("Area").alias("metric"), (F.col("n") * 1.0).alias("v")),
        F.struct(F.lit("Production").alias("metric"), (F.col("p") * 1.0).alias("v")),
    )
    return wide.select("state", "crop_season", F.lit("Wheat").alias("crop"), F.explode(rows).alias("m")).select(
        "state", "crop", "crop_season", F.col("m.metric").alias("metric"), F.col("m.v").alias("value_normalized"))


def grid_daily_df(spark, sf) -> DataFrame:
    """Daily rainfall per grid cell in long form; a cell per supplier position on the grid."""
    k = F.col("l_suppkey")
    row, col = k * 7 % GRID_ROWS, k * 13 % GRID_COLS
    d = F.to_date("l_shipdate")
    return (
        table(spark, sf, "lineitem")
        .groupBy((row * GRID_COLS + col).alias("cell_id"), d.alias("date"))
        .agg(F.sum("l_quantity").alias("q"), F.min("l_orderkey").alias("ok"))
        .select("cell_id", *_cell_position(), "date", F.year("date").alias("year"), F.month("date").alias("month"),
                F.day("date").alias("day"), F.when(F.col("ok") % 211 != 0, F.col("q")).alias("mm"))
    )


def _cell_position():
    cell = F.col("cell_id")
    return (
        (F.lit(GRID_LAT0) + F.floor(cell / GRID_COLS) * F.lit(GRID_RES)).alias("lat"),
        (F.lit(GRID_LON0) + (cell % GRID_COLS) * F.lit(GRID_RES)).alias("lon"),
    )


def grid_month_df(spark, sf) -> DataFrame:
    return (
        grid_daily_df(spark, sf).groupBy("cell_id", "year", "month").agg(F.sum("mm").alias("mm"))
        .select("cell_id", *_cell_position(), "year", "month", "mm")
    )


def cropfrac_df(spark, sf) -> DataFrame:
    """Cropland fraction of every cell that has a supplier."""
    k = F.col("s_suppkey")
    frac = (F.col("cell_id") % 11)
    return (
        table(spark, sf, "supplier")
        .select((k * 7 % GRID_ROWS * GRID_COLS + k * 13 % GRID_COLS).alias("cell_id")).distinct()
        .select("cell_id", *_cell_position(), F.when(frac != 10, frac / 16.0).alias("frac"))
    )


def edges_df(spark, sf) -> DataFrame:
    """Region outlines with a hole, as one row per polygon edge."""
    rings = F.array(*[
        F.struct(F.lit(r).alias("ring"), F.lit(a).alias("x1"), F.lit(b).alias("y1"), F.lit(c).alias("x2"),
                 F.lit(d).alias("y2")) for r, a, b, c, d in OUTLINE])
    n = F.col("n_nationkey")
    cx = F.lit(116.5125) + F.floor(n / 5) * 8.0
    cy = F.lit(-40.5125) + (n % 5) * 6.5
    return regions_df(spark, sf).select("sa2_code", cx.alias("cx"), cy.alias("cy"), F.explode(rings).alias("e")).select(
        F.col("sa2_code").alias("region"), F.col("e.ring").alias("ring"),
        (F.col("cx") + F.col("e.x1")).alias("x1"), (F.col("cy") + F.col("e.y1")).alias("y1"),
        (F.col("cx") + F.col("e.x2")).alias("x2"), (F.col("cy") + F.col("e.y2")).alias("y2"))


def points_df(spark, sf) -> DataFrame:
    """Point ids ``DD_lat_lon`` of customers, off the grid lines."""
    k = F.col("c_custkey")
    lat = F.lit(-43.5) + (k * 37 % 6600) * 0.005
    lon = F.lit(112.25) + (k * 91 % 8200) * 0.005
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"), lat.alias("lat"), lon.alias("lon"))


def guides_df(spark, sf) -> DataFrame:
    """Sowing guide rows per SD, commodity and guide year."""
    grown = crop_context_df(spark, sf).select("sa2_code", F.col("crop").alias("commodity"))
    base = F.col("sd_code").cast("int") % 7 + F.length("commodity")
    rows = (concordance_df(spark, sf).join(grown, "sa2_code")
            .select("sd_code", "sd_name", "sd_state_code", "commodity").distinct())
    return rows.select(
        "*", F.explode(F.array(F.lit(1996), F.lit(1999), F.lit(2010))).alias("source_year")
    ).select(
        F.col("sd_state_code").alias("state"), F.col("sd_code").alias("sd_region"),
        F.lit("winter_dominant").alias("rainfall_regime"), "commodity",
        F.when(F.length("commodity") == 10, "summer").otherwise("winter").alias("season_type"),
        (base + 70).alias("earliest_sow_doy"), (base + 78 + (F.col("source_year") % 5)).alias("optimal_start_doy"),
        (base + 88 + (F.col("source_year") % 5)).alias("optimal_end_doy"),
        (base + 94 + (F.col("source_year") % 5)).alias("latest_viable_doy"),
        F.concat(F.lit("guide "), F.col("source_year").cast("string")).alias("source_document"), "source_year",
        F.when(F.col("source_year") < 1999, "medium").otherwise("high").alias("confidence"),
    )


def reports_df(spark, sf) -> DataFrame:
    """Report texts: document prose with claims and, for most, a fenced metadata block."""
    k = F.col("doc_id")
    day = (k % 28 + 1).cast("int")
    claim = F.when(k % 5 == 0, day + 1).otherwise(day)
    block = F.concat(
        F.lit("\n```vintage\nstatus: "), F.when(k % 3 == 0, "live").when(k % 17 == 1, "draft").otherwise("frozen"),
        F.lit("\nreport_date: 2001-06-01"),
        F.when(k % 19 == 2, F.lit("")).when(k % 4 == 3, F.lit("\ncoverage_month: \"2001-06\"  # quoted")).otherwise(F.lit("\ncoverage_month: 2001-05")),
        F.lit("\nthrough_day: "), F.when(k % 3 == 0, F.when(k % 2 == 0, F.lit(MTD_DAY)).otherwise(day)).otherwise(day).cast("string"),
        F.lit("\nbaseline_years: [2005, 2025]\ndecile_method: "),
        F.when(k % 7 == 3, "ratio_div10_v0").when(k % 23 == 5, "other").otherwise("rank_ceil_v1"),
        F.when(k % 6 == 0, F.lit("\ninputs:\n  # one to a line\n  - 'monthly'\n  - other")).when(k % 3 == 0, F.lit("\ninputs: [monthly]")).otherwise(F.lit("")),
        F.lit("\n```\n"))
    prose = F.concat(
        F.when(k % 4 == 3, F.concat(F.lit("June 1-"), claim.cast("string"), F.lit(", "), claim.cast("string"), F.lit(" of 30 days, not May 1-"), day.cast("string")))
        .otherwise(F.concat(F.lit("Data through day "), claim.cast("string"))), F.lit(". "),
        F.when(k % 11 == 4, F.lit("Decile is rank / 10. ")).otherwise(F.lit("")), F.col("text"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("report_id"),
        F.when(k % 13 != 6, F.concat(prose, block)).otherwise(prose).alias("markdown"))


# --- SQL twins ---------------------------------------------------------------------------

_CODES = "[" + ",".join(str(c) for c in QUALITY_CODES) + "]"


def _q(shift: int) -> str:
    return f"{_CODES}[CAST((ok + {shift}) % 10 AS INT) + 1]"


def _zfill(x: str) -> str:
    return f"CASE WHEN length(CAST({x} AS VARCHAR)) < 6 THEN lpad(CAST({x} AS VARCHAR), 6, '0') ELSE CAST({x} AS VARCHAR) END"


_LAT = f"CAST({GRID_LAT0} AS DOUBLE) + CAST(cell_id // {GRID_COLS} AS DOUBLE) * CAST({GRID_RES} AS DOUBLE)"
_LON = f"CAST({GRID_LON0} AS DOUBLE) + CAST(cell_id % {GRID_COLS} AS DOUBLE) * CAST({GRID_RES} AS DOUBLE)"
_TEMPS = ("CAST((ok % 21) AS DOUBLE) * CAST(0.5 AS DOUBLE) - 4 AS min_temp, "
          "CAST((ok % 27) AS DOUBLE) * CAST(0.5 AS DOUBLE) + 24 AS max_temp")

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "obs": ((), f"""
        SELECT {_zfill('sk')} AS station_id, date, {_TEMPS},
               CASE WHEN ok % 41 <> 0 THEN q END AS rainfall,
               {_q(0)} AS min_temp_quality, {_q(3)} AS max_temp_quality,
               CASE WHEN ok % 13 <> 0 THEN {_q(7)} END AS rainfall_quality
        FROM (SELECT l_suppkey AS sk, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS q, min(l_orderkey) AS ok
              FROM lineitem GROUP BY 1, 2)"""),
    "dense_obs": ((), f"""
        SELECT {_zfill('s_nationkey')} AS station_id, date, {_TEMPS},
               CASE WHEN ok % 41 <> 0 THEN CASE WHEN dayofyear(date) % 28 < 12 THEN 0
                    ELSE floor(q * 4 / n) / CAST(16 AS DOUBLE) END END AS rainfall,
               {_q(0)} AS min_temp_quality, {_q(3)} AS max_temp_quality,
               CASE WHEN ok % 13 <> 0 THEN {_q(7)} END AS rainfall_quality
        FROM (SELECT s_nationkey, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS q, count(*) AS n,
                     min(l_orderkey) AS ok
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""),
    "regions": ((), """
        SELECT n_nationkey, (n_regionkey + 1) || '0100' || lpad(CAST(n_nationkey + 1000 AS VARCHAR), 4, '0') AS sa2_code,
               (n_regionkey + 1) || lpad(CAST(n_nationkey + 1000 AS VARCHAR), 4, '0') AS sa2_5, n_name AS sa2_name,
               r_name || '_' || ((n_nationkey // 5) % 3) AS sa3_name,
               r_name || '_' || ((n_nationkey // 5) % 2) AS sa4_name,
               n_regionkey + 1 AS state_code, r_name AS state_name
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "stations": (("regions",), f"""
        SELECT {_zfill('s_suppkey')} AS station_id, s_name AS name,
               CAST({GRID_LAT0} AS DOUBLE) + CAST(s_suppkey * 7 % {GRID_ROWS} AS DOUBLE) * CAST({GRID_RES} AS DOUBLE) AS latitude,
               CAST({GRID_LON0} AS DOUBLE) + CAST(s_suppkey * 13 % {GRID_COLS} AS DOUBLE) * CAST({GRID_RES} AS DOUBLE) AS longitude,
               sa2_code, sa2_5, sa2_name, sa3_name, sa4_name, state_code, state_name,
               CAST(greatest(floor(s_acctbal), 0) AS INT) AS cropping_area
        FROM supplier JOIN regions ON s_nationkey = n_nationkey"""),
    "region_month": (("regions",), f"""
        SELECT n_nationkey, state_name, sa2_code, sa2_5, sa2_name, sa3_name, sa4_name, year, month,
               CASE WHEN (n_nationkey * 7 + year * 3 + month) % 53 <> 0 THEN floor(q * 4 / n) / CAST(4 AS DOUBLE) END AS rainfall_mm,
               floor(coalesce(q20, 0) * 4 / n) / CAST(4 AS DOUBLE) AS to_day_mm,
               year = {PARTIAL_YEAR} AND month = {PARTIAL_MONTH} AS is_partial_month,
               CASE WHEN year = {PARTIAL_YEAR} AND month = {PARTIAL_MONTH} THEN last_day END AS partial_month_through_day
        FROM (SELECT s_nationkey, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
                     sum(l_quantity) AS q, sum(l_quantity) FILTER (day(l_shipdate) <= {MTD_DAY}) AS q20, count(*) AS n,
                     CAST(max(day(l_shipdate)) AS INT) AS last_day
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)
        JOIN regions ON s_nationkey = n_nationkey"""),
    "history": (("region_month",), f"""
        SELECT * FROM region_month WHERE year < {TARGET_YEAR} OR (year = {TARGET_YEAR} AND month < {MTD_MONTH})"""),
    "mtd": (("region_month",), f"""
        SELECT state_name, sa2_code, sa2_5, sa2_name, sa3_name, sa4_name, year, month,
               CASE WHEN rainfall_mm IS NOT NULL THEN to_day_mm END AS rainfall_mm,
               {MTD_DAY} AS partial_month_through_day
        FROM region_month WHERE year = {TARGET_YEAR} AND month = {MTD_MONTH}"""),
    "crop_context": (("regions",), """
        SELECT n_nationkey, sa2_code, sa2_5 AS station_sa2_5dig16, sa2_name, sa3_name, sa4_name, state_name AS state,
               '2020-21' AS financial_year, crop,
               CASE WHEN NOT sup THEN floor(cents / CAST(10000 AS DOUBLE)) END AS area_ha,
               coalesce(CASE WHEN NOT sup THEN floor(cents / CAST(10000 AS DOUBLE)) END,
                        CASE WHEN NOT nofb THEN n * CAST(10 AS DOUBLE) END) AS area_ha_for_weighting,
               sup AND NOT nofb AS area_is_fallback, n * CAST(3 AS DOUBLE) AS production_t
        FROM (SELECT c_nationkey, lower(c_mktsegment) AS crop, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS cents,
                     count(*) AS n, (c_nationkey + length(lower(c_mktsegment))) % 7 = 0 AS sup, c_nationkey % 9 = 4 AS nofb
              FROM customer GROUP BY ALL)
        JOIN regions ON c_nationkey = n_nationkey"""),
    "weights": (("crop_context",), """
        SELECT sa2_code, station_sa2_5dig16 AS sa2_5, state AS state_name, area_ha_for_weighting AS weight
        FROM crop_context WHERE crop = 'building'"""),
    "concordance": (("regions",), """
        SELECT sa2_code, sa2_5, sa2_name, state_name, CAST(sd AS VARCHAR) AS sd_code, 'SD_' || sd AS sd_name,
               CAST(st AS VARCHAR) AS sd_state_code, allocation_ratio
        FROM (SELECT *, state_code * 100 + (n_nationkey // 5) % 3 AS sd, state_code AS st,
                     CAST(0.75 AS DOUBLE) AS allocation_ratio FROM regions
              UNION ALL
              SELECT * EXCLUDE (sp), sp * 100 + (n_nationkey // 5 + 1) % 3, sp, CAST(0.25 AS DOUBLE) FROM (
                SELECT *, CASE WHEN n_nationkey % 8 = 7 THEN state_code % 5 + 1 ELSE state_code END AS sp
                FROM regions)) AS u"""),
    "production": (("regions",), """
        SELECT state, 'Wheat' AS crop, crop_season, unnest(['Area', 'Production']) AS metric,
               unnest([n * CAST(1 AS DOUBLE), p * CAST(1 AS DOUBLE)]) AS value_normalized
        FROM (SELECT state_name AS state, CAST(year(o_orderdate) AS INT) AS crop_season, count(*) AS n,
                     sum(CAST(round(o_totalprice) AS BIGINT)) AS p
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN regions ON c_nationkey = n_nationkey GROUP BY 1, 2)"""),
    "grid_daily": ((), f"""
        SELECT cell_id, {_LAT} AS lat, {_LON} AS lon, date, CAST(year(date) AS INT) AS year,
               CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, CASE WHEN ok % 211 <> 0 THEN q END AS mm
        FROM (SELECT l_suppkey * 7 % {GRID_ROWS} * {GRID_COLS} + l_suppkey * 13 % {GRID_COLS} AS cell_id,
                     CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS q, min(l_orderkey) AS ok
              FROM lineitem GROUP BY 1, 2)"""),
    "grid_month": (("grid_daily",), """
        SELECT cell_id, min(lat) AS lat, min(lon) AS lon, year, month, sum(mm) AS mm
        FROM grid_daily GROUP BY cell_id, year, month"""),
    "cropfrac": ((), f"""
        SELECT cell_id, {_LAT} AS lat, {_LON} AS lon,
               CASE WHEN cell_id % 11 <> 10 THEN (cell_id % 11) / CAST(16 AS DOUBLE) END AS frac
        FROM (SELECT DISTINCT s_suppkey * 7 % {GRID_ROWS} * {GRID_COLS} + s_suppkey * 13 % {GRID_COLS} AS cell_id FROM supplier)"""),
    "edges": (("regions",), """
        SELECT sa2_code AS region, ring, cx + dx1 AS x1, cy + dy1 AS y1, cx + dx2 AS x2, cy + dy2 AS y2
        FROM (SELECT sa2_code, CAST(116.5125 AS DOUBLE) + (n_nationkey // 5) * CAST(8 AS DOUBLE) AS cx,
                     CAST(-40.5125 AS DOUBLE) + (n_nationkey % 5) * CAST(6.5 AS DOUBLE) AS cy FROM regions),
             (VALUES """ + ", ".join(
                 f"({r}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE), CAST({d} AS DOUBLE))"
                 for r, a, b, c, d in OUTLINE) + """) AS o(ring, dx1, dy1, dx2, dy2)"""),
    "points": ((), """
        SELECT c_custkey AS point_id, CAST(-43.5 AS DOUBLE) + CAST(c_custkey * 37 % 6600 AS DOUBLE) * CAST(0.005 AS DOUBLE) AS lat,
               CAST(112.25 AS DOUBLE) + CAST(c_custkey * 91 % 8200 AS DOUBLE) * CAST(0.005 AS DOUBLE) AS lon
        FROM customer"""),
    "guides": (("concordance", "crop_context"), """
        SELECT sd_state_code AS state, sd_code AS sd_region, 'winter_dominant' AS rainfall_regime, commodity,
               CASE WHEN length(commodity) = 10 THEN 'summer' ELSE 'winter' END AS season_type,
               base + 70 AS earliest_sow_doy, base + 78 + source_year % 5 AS optimal_start_doy,
               base + 88 + source_year % 5 AS optimal_end_doy, base + 94 + source_year % 5 AS latest_viable_doy,
               'guide ' || source_year AS source_document, source_year,
               CASE WHEN source_year < 1999 THEN 'medium' ELSE 'high' END AS confidence
        FROM (SELECT *, CAST(sd_code AS INT) % 7 + length(commodity) AS base
              FROM (SELECT DISTINCT sd_code, sd_name, sd_state_code, crop AS commodity
                    FROM concordance JOIN crop_context USING (sa2_code)),
                   (VALUES (1996), (1999), (2010)) AS y(source_year))"""),
    "reports": ((), f"""
        SELECT doc_id AS report_id, prose || CASE WHEN doc_id % 13 <> 6 THEN block ELSE '' END AS markdown
        FROM (SELECT doc_id,
          CASE WHEN doc_id % 4 = 3 THEN 'June 1-' || claim || ', ' || claim || ' of 30 days, not May 1-' || (doc_id % 28 + 1) ELSE 'Data through day ' || claim END || '. ' ||
          CASE WHEN doc_id % 11 = 4 THEN 'Decile is rank / 10. ' ELSE '' END || text AS prose,
          chr(10) || '```vintage' || chr(10) || 'status: ' ||
          CASE WHEN doc_id % 3 = 0 THEN 'live' WHEN doc_id % 17 = 1 THEN 'draft' ELSE 'frozen' END ||
          chr(10) || 'report_date: 2001-06-01' ||
          CASE WHEN doc_id % 19 = 2 THEN '' WHEN doc_id % 4 = 3 THEN chr(10) || 'coverage_month: "2001-06"  # quoted' ELSE chr(10) || 'coverage_month: 2001-05' END ||
          chr(10) || 'through_day: ' || (CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN {MTD_DAY} ELSE doc_id % 28 + 1 END) ||
          chr(10) || 'baseline_years: [2005, 2025]' || chr(10) || 'decile_method: ' ||
          CASE WHEN doc_id % 7 = 3 THEN 'ratio_div10_v0' WHEN doc_id % 23 = 5 THEN 'other' ELSE 'rank_ceil_v1' END ||
          CASE WHEN doc_id % 6 = 0 THEN chr(10) || 'inputs:' || chr(10) || '  # one to a line' || chr(10) || '  - ''monthly''' || chr(10) || '  - other'
               WHEN doc_id % 3 = 0 THEN chr(10) || 'inputs: [monthly]' ELSE '' END || chr(10) || '```' || chr(10) AS block
          FROM (SELECT *, CASE WHEN doc_id % 5 = 0 THEN doc_id % 28 + 2 ELSE doc_id % 28 + 1 END AS claim FROM documents))"""),
}


def sql(body: str, *names: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """A SELECT over role tables: the named CTEs with their dependencies, then ``body``."""
    ordered: list[str] = []

    def add(name):
        for dep in CTES[name][0]:
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in ordered] + [f"{n} AS ({b})" for n, b in extra]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
