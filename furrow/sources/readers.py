"""Readers: observations, histories, grids, regions, census and crop context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions import scalar as S

OBSERVATIONS = T.StructType([
    T.StructField("station_id", T.StringType(), False), T.StructField("date", T.DateType(), False),
    T.StructField("min_temp", T.DoubleType()), T.StructField("max_temp", T.DoubleType()),
    T.StructField("rainfall", T.DoubleType()), T.StructField("min_temp_quality", T.IntegerType()),
    T.StructField("max_temp_quality", T.IntegerType()), T.StructField("rainfall_quality", T.IntegerType()),
])
CROP_CONTEXT = T.StructType([
    *[T.StructField(c, T.StringType()) for c in (
        "sa2_code", "station_sa2_5dig16", "sa2_name", "state", "financial_year", "crop")],
    *[T.StructField(c, T.DoubleType()) for c in ("area_ha", "production_t", "yield_t_ha", "area_share")],
])
REGION_HISTORY = T.StructType([
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("sa2_code", T.StringType()), T.StructField("sa2_name", T.StringType()),
    T.StructField("state_name", T.StringType()), T.StructField("rainfall_mm", T.DoubleType()),
    T.StructField("is_partial_month", T.BooleanType()), T.StructField("partial_month_through_day", T.IntegerType()),
])
_RING = T.ArrayType(T.ArrayType(T.DoubleType()))


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Daily CSV files with a declared schema; NaN text becomes NULL, a malformed value raises."""
    df = spark.read.schema(OBSERVATIONS).csv(path, header=True, mode="FAILFAST")
    return df.select("station_id", "date", *[S.clean_number(c).alias(c) for c in ("min_temp", "max_temp", "rainfall")],
                     "min_temp_quality", "max_temp_quality", "rainfall_quality")


def scan_weather(obs: DataFrame, target_date, window_days: int = 14) -> DataFrame:
    """Complete rows of the days up to a target date."""
    end = F.lit(target_date).cast("date")
    return obs.where(F.col("date").between(F.date_sub(end, window_days - 1), end)).where(
        F.col("min_temp").isNotNull() & F.col("max_temp").isNotNull() & F.col("rainfall").isNotNull()
    ).select("station_id", "date", F.col("min_temp").alias("min_temperature"), F.col("max_temp").alias("max_temperature"),
             "rainfall", F.col("min_temp_quality").alias("min_temperature_quality"),
             F.col("max_temp_quality").alias("max_temperature_quality"), "rainfall_quality")


def station_range(obs: DataFrame, station: str, start, end) -> DataFrame:
    return obs.where((F.col("station_id") == station) & F.col("date").between(
        F.lit(start).cast("date"), F.lit(end).cast("date"))).orderBy("date")


def read_crop_context(spark: SparkSession, path: str, required: Sequence[str] = ("sa2_code", "station_sa2_5dig16", "crop", "area_ha")) -> DataFrame:
    """Crop table: blank cells are NULL, a bad number fails the read."""
    header = spark.read.csv(path, header=True).columns
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"crop context lacks columns {missing}")
    types = {f.name: f.dataType for f in CROP_CONTEXT}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    df = spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")
    return df.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) if isinstance(schema[c].dataType, T.StringType) else F.col(c)
                       for c in header])


def read_region_history(df: DataFrame, year: int | None = None) -> DataFrame:
    """Region months with the partial-month columns filled in where absent."""
    if year is not None:
        df = df.where(F.col("year") == year)
    partial = F.coalesce("is_partial_month", F.lit(False)) if "is_partial_month" in df.columns else F.lit(False)
    through = F.col("partial_month_through_day") if "partial_month_through_day" in df.columns else F.lit(None)
    return df.withColumn("rainfall_mm", S.clean_number(F.col("rainfall_mm").cast("double"))).withColumn(
        "is_partial_month", partial).withColumn("partial_month_through_day", through.cast("int"))


def complete_years(grid: DataFrame) -> DataFrame:
    """Years that hold all twelve months."""
    return grid.groupBy("year").agg(F.countDistinct("month").alias("n_months")).where("n_months = 12")


def read_grid(grid: DataFrame, month: int, target_year: int, first_year: int, last_year: int,
              check: bool = True) -> DataFrame:
    """One month of a long grid for a target and its baseline years.

    With ``check`` an incomplete baseline year, or a baseline cell the target grid lacks, raises.
    """
    y = F.col("year")
    if check:
        whole = {r["year"] for r in complete_years(grid.where(y.between(first_year, last_year))).collect()}
        gaps = sorted(set(range(first_year, last_year + 1)) - whole)
        if gaps:
            raise ValueError(f"incomplete baseline years {gaps}")
    rows = grid.where((F.col("month") == month) & (y.between(first_year, last_year) | (y == target_year)))
    if check and off_grid(rows, target_year).limit(1).collect():
        raise ValueError("baseline coordinates do not match the target grid")
    return rows


def off_grid(rows: DataFrame, target_year: int) -> DataFrame:
    """Baseline cells that the target year's grid does not have."""
    base = rows.where(F.col("year") != target_year).select("cell_id").distinct()
    return base.join(rows.where(F.col("year") == target_year).select("cell_id"), "cell_id", "left_anti")


def read_regions(spark: SparkSession, path: str, code: str = "sa2_code", name: str = "sa2_name",
                 multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """GeoJSON feature collections, one per file or one per line, to attributes and polygon edges.

    Polygon and MultiPolygon coordinates are kept as text until their depth is known. Rings are
    numbered across parts; ring 0 of the first part is the exterior used for centroids.
    """
    feature = T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])),
    ])
    doc = T.StructType([T.StructField("features", T.ArrayType(feature))])
    feats = spark.read.schema(doc).json(path, multiLine=multi_line).select(F.explode("features").alias("f")).where(
        F.col("f.geometry.type").isNotNull())
    feats = feats.select(F.col("f.properties").alias("p"), F.col("f.geometry.type").alias("kind"),
                         F.col("f.geometry.coordinates").alias("c"))
    attributes = feats.select(F.col("p")[code].alias(code), F.col("p")[name].alias(name), "kind")
    polygon = F.from_json("c", T.ArrayType(_RING))
    parts = F.from_json("c", T.ArrayType(T.ArrayType(_RING)))
    rings = F.when(F.col("kind") == "Polygon", polygon).otherwise(F.flatten(parts))
    ring = feats.select(F.col("p")[code].alias("region"), F.posexplode(rings).alias("ring", "pts"))
    ends = F.arrays_zip(F.slice("pts", F.lit(1), F.size("pts") - 1).alias("a"), F.slice("pts", F.lit(2), F.size("pts") - 1).alias("b"))
    edges = ring.where(F.size("pts") > 1).select("region", "ring", F.explode(ends).alias("e")).select(
        "region", "ring", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
        F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))
    return attributes, edges


def read_census(observations: DataFrame, year_id: int, regions: DataFrame, commodities: DataFrame) -> DataFrame:
    """Estimate and error of the wanted regions and commodities in one census year."""
    rows = observations.where(F.col("year_id") == year_id)
    return (rows.join(regions.select("region_code").distinct(), "region_code", "left_semi")
            .join(commodities.select("commodity_code").distinct(), "commodity_code", "left_semi")
            .select("region_code", "commodity_code", "estimate", "rse"))
