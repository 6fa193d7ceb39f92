"""Sinks: idempotent upserts, replace-by-date, event logs, run logs and exports.

A rewrite replaces whole partitions: Spark writes their new content beside the table and moves it in when the
job commits, so a job that fails before leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from furrow.functions import scalar as S
from furrow.session import scratch_path

EXPORT_COLUMNS = (
    "station_id", "station_name", "latitude", "longitude", "region_name", "sa2_name", "sa3_name", "sa4_name",
    "state_name", "date", "event_type", "severity", "value", "threshold", "confidence", "data_quality", "crop_stage",
    "phenology_risk_multiplier", "flowering_window_active", "days_since_flowering_start", "risk_score", "detected_at",
)
ROWS_A_SLICE = 250_000  # of a partition that is merged
RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False), T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()), T.StructField("stations", T.IntegerType()),
    T.StructField("records", T.LongType()), T.StructField("success_rate", T.DoubleType()),
    T.StructField("status", T.StringType()),
])


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions present in ``df``; AQE sizes the files and splits large ones."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _partition_values(spark: SparkSession, path: str, by: str) -> list[str]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop)]
    return [n.partition("=")[2] for n in names if n.startswith(f"{by}=")]


def last_wins(df: DataFrame, keys=("station_id", "date"), order: str = "ingested_at") -> DataFrame:
    """One row per key: the latest; among equally late ones the same in every run, by a hash of the row."""
    w = W.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), F.xxhash64(*df.columns))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _merge(rows: DataFrame, path: str, by: str, keys, order: str) -> None:
    """Replace the partitions present in ``rows`` by the last row of each key; ``by`` follows from the key.

    Rows are counted first and dealt out once, by partition and by slices of about ``ROWS_A_SLICE`` rows of a large one. A
    task sorts some slices, and that order serves the choice of the last row and the files alike.
    """
    sizes = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}  # one row per partition to write
    large = {value: 1 + n // ROWS_A_SLICE for value, n in sizes.items() if value is not None and n > ROWS_A_SLICE}
    slices = F.lit(1)
    if large:
        of = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])
        slices = F.coalesce(F.try_element_at(of, F.col(by)), F.lit(1))
    n = min(len(sizes) + sum(large.values()), 1 + sum(sizes.values()) // ROWS_A_SLICE)
    w = W.partitionBy(by, "_slice", *keys).orderBy(F.col(order).desc_nulls_last(), F.xxhash64(*rows.columns))
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(*keys), slices)).repartition(max(1, n), by, "_slice")
    last = dealt.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_slice")
    last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def upsert(batch: DataFrame, path: str, keys=("station_id", "date"), order: str = "ingested_at") -> None:
    """Insert or replace by key, latest ingest winning; only the months in the batch are rewritten, once.

    The batch is staged, as its months are needed first. Old and new rows of those months are written beside
    the table and take the months' place when the job commits.
    """
    spark = batch.sparkSession
    stage = scratch_path(spark, "stage")
    batch = batch.withColumn("month", F.year("date") * 100 + F.month("date"))
    batch.write.parquet(stage)
    rows = staged = spark.read.schema(batch.schema).parquet(stage)
    if path_exists(spark, path):
        touched = [r["month"] for r in staged.select("month").distinct().collect()]
        rows = spark.read.parquet(path).where(F.col("month").isin(touched)).unionByName(staged, allowMissingColumns=True)
    _merge(rows, path, "month", keys, order)
    _remove(spark, stage)


def merge_dates(batch: DataFrame, path: str, keys=("station_id", "date"), order: str = "ingested_at", date: str = "date") -> None:
    """Insert or replace by key in a table laid out by date; only the batch's dates are rewritten."""
    spark, rows = batch.sparkSession, batch
    if path_exists(spark, path):
        touched = batch.select(date).distinct()
        rows = spark.read.parquet(path).join(touched, date, "left_semi").unionByName(batch, allowMissingColumns=True)
    _merge(rows, path, date, keys, order)


def replace_dates(batch: DataFrame, path: str, date: str = "date") -> None:
    """Delete the batch's dates from the table and append the batch."""
    _overwrite_partitions(batch, path, date)


def write_by_type(events: DataFrame, path: str, dates=()) -> None:
    """Event log by date, each date's events sorted by type; a rerun of a date replaces all of its events.

    ``dates`` names the dates that were processed, so that those without events any more are emptied too.
    """
    spark = events.sparkSession
    (events.hint("rebalance", "date").sortWithinPartitions("date", "event_type")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))
    if dates:
        some = {str(r["date"]) for r in events.where(F.col("date").isin(list(dates))).select("date").distinct().collect()}  # at most ``dates``
        for d in dates:
            if str(d) not in some:
                _remove(spark, f"{path}/date={d}")


def write_latest_and_archive(df: DataFrame, path: str, snapshot_date: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/latest")
    df.write.mode("overwrite").parquet(f"{path}/archive/snapshot_date={snapshot_date}")


def log_run(run: DataFrame, path: str) -> None:
    """Append runs to the log, which is laid out by month of their start."""
    run.withColumn("month", F.year("started_at") * 100 + F.month("started_at")).write.mode("append").partitionBy("month").parquet(path)


def purge_runs(spark: SparkSession, path: str, before) -> None:
    """Drop runs started before a time: older months go as a whole, only the month of that time is rewritten."""
    cut = spark.range(1).select(F.lit(before).cast("timestamp").alias("t")).select((F.year("t") * 100 + F.month("t")).alias("m")).first()["m"]
    month = spark.read.parquet(path).where(F.col("month") == cut)
    keep = month.where(F.col("started_at") >= F.lit(before).cast("timestamp"))
    if keep.head(1):
        _overwrite_partitions(keep, path, "month")
    elif month.head(1):
        _remove(spark, f"{path}/month={cut}")
    for value in _partition_values(spark, path, "month"):
        if value.isdigit() and int(value) < cut:
            _remove(spark, f"{path}/month={value}")


def flagged(obs: DataFrame, start, end) -> DataFrame:
    """Observations of a range with frost, heat and rain flags."""
    rows = obs.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return rows.select("station_id", "date", "min_temp", "max_temp", "rainfall", S.frost_flag("min_temp").alias("frost_risk"),
                       S.heat_flag("max_temp").alias("heat_risk"), S.rain_flag("rainfall").alias("rain_risk"))


def export_flat(obs: DataFrame, start, end, path: str) -> None:
    flagged(obs, start, end).write.mode("overwrite").csv(path, header=True)


def _first(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the same in every run."""
    w = W.partitionBy(key).orderBy(*[F.col(c) for c in df.columns if c != key])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def export_table(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Events with station metadata and risk score in the export's column order."""
    dim = stations.select("station_id", F.col("name").alias("station_name"), "latitude", "longitude", "state_name")
    rows = events.drop("state_name").join(_first(dim, "station_id"), "station_id", "left")
    rows = rows.withColumn("risk_score", S.risk_score("event_type", "severity", "confidence"))
    if "region_name" not in rows.columns:
        rows = rows.withColumn("region_name", F.col("sa2_name") if "sa2_name" in rows.columns else F.lit(""))
    return rows.select(*[c for c in EXPORT_COLUMNS if c in rows.columns])


def export_events(events: DataFrame, stations: DataFrame, target_date, path: str) -> None:
    """All events, and those of one date; an empty date still yields a typed, empty table."""
    table = export_table(events, stations)
    table.write.mode("overwrite").parquet(f"{path}/risk_events")
    table.where(F.col("date") == F.lit(target_date).cast("date")).write.mode("overwrite").parquet(f"{path}/risk_events_latest")


def write_dimension(stations: DataFrame, path: str) -> None:
    stations.write.mode("overwrite").parquet(path)
