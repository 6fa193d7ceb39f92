"""Feed normalisation, station quality report and batch ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import scalar as S
from furrow.operators import aggregates as A
from furrow.session import scratch_path, stored
from furrow.sources.sinks import log_run, upsert

DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}"


def normalise_raw(raw: DataFrame, variables: dict[str, str] | None = None, day: str = "YYYY-MM-DD") -> DataFrame:
    """Vendor rows to observation rows.

    Rows whose day column is not a date are dropped; a variable the feed lacks becomes NULL with
    the missing code and source ``missing``.
    """
    variables = variables or {"R": "rainfall", "N": "min_temp", "X": "max_temp"}
    rows = raw.where(F.col(f"`{day}`").rlike(DAY_PATTERN))
    cols = [S.norm_station_id("station_id").alias("station_id"), F.try_to_timestamp(F.substring(f"`{day}`", 1, 10), F.lit("yyyy-MM-dd")).cast("date").alias("date")]
    for letter, name in variables.items():
        value, quality = P.VENDOR_COLUMNS[letter]
        if value in raw.columns:
            q = F.col(quality).cast("int") if quality in raw.columns else F.lit(0)
            cols += [F.col(value).try_cast("double").alias(name), q.alias(f"{name}_quality"), F.lit("silo_api").alias(f"{name}_source")]
        else:
            cols += [F.lit(None).cast("double").alias(name), F.lit(P.MISSING_CODE).alias(f"{name}_quality"),
                     F.lit("missing").alias(f"{name}_source")]
    return rows.select(*cols)


def validate_feed(raw: DataFrame, variables: dict[str, str] | None = None) -> tuple[list[str], DataFrame]:
    """Missing value columns, and code counts per variable present."""
    variables = variables or {"R": "rainfall", "N": "min_temp", "X": "max_temp"}
    wanted = [P.VENDOR_COLUMNS[v] for v in variables]
    missing = sorted(value for value, _ in wanted if value not in raw.columns)
    counts = [F.count(F.lit(1)).alias("record_count")]
    for value, quality in wanted:
        if value in raw.columns and quality in raw.columns:
            q = F.col(quality)
            counts += [F.count_if(q == 0).alias(f"{value}_observed"), F.count_if(q == 15).alias(f"{value}_interpolated"),
                       F.count_if(q == P.SYNTHETIC_CODE).alias(f"{value}_synthetic")]
    return missing, raw.agg(*counts)


def quality_report(obs: DataFrame, rules: P.QualityRules = P.QualityRules()) -> DataFrame:
    """Ratios, confidence, class and issues per station, with its first and last date and the gaps between.

    One scan: codes are counted and days marked as bits of a long by station and 64 days, folded on the map side; what goes
    along a station is one row for 64 days. A run of days begins at a marked bit whose day before is not marked, and there is
    one gap fewer than runs. Rows without a station are left out; rows without a date count in the ratios only.
    """
    day, bit = F.unix_date("date"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.unix_date("date"), F.lit(64)))
    words = obs.where(F.col("station_id").isNotNull()).groupBy("station_id", F.floor(day / 64).alias("_word")).agg(
        *A.code_counts(), F.bit_or(bit).alias("_days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    along = W.partitionBy("station_id").orderBy("_word")
    next_to = F.coalesce(F.lag("_word").over(along) == F.col("_word") - 1, F.lit(False))
    carried = F.when(next_to, F.shiftrightunsigned(F.lag("_days").over(along), 63)).otherwise(F.lit(0).cast("long"))
    begins = F.col("_days").bitwiseAND(F.bitwise_not(F.shiftleft("_days", 1).bitwiseOR(carried)))
    counts = [c for c in words.columns if c == "record_count" or c.endswith("_n")]
    stations = words.withColumn("_begins", begins).groupBy("station_id").agg(
        *[F.sum(c).alias(c) for c in counts], F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.sum(F.bit_count("_days")).alias("_marked"), F.sum(F.bit_count("_begins")).alias("_runs"))
    scored = A.confidence_score(A.code_ratios(stations, rules=rules), rules=rules)
    missing = F.datediff("last_date", "first_date") + 1 - F.col("_marked")
    return (
        scored.withColumn("n_gaps", F.coalesce(F.col("_runs") - 1, F.lit(0).cast("long")))
        .withColumn("missing_days", F.coalesce(missing, F.lit(0).cast("long"))).drop("_marked", "_runs")
        .withColumn("issues", F.when(F.col("n_gaps") > 0, F.array_append("issues", F.lit("date_gaps"))).otherwise(F.col("issues")))
    )


def auto_exclude(obs: DataFrame, min_confidence: float = 0.3, rules: P.QualityRules = P.QualityRules()) -> DataFrame:
    """Observations of the stations whose confidence reaches the minimum."""
    good = A.confidence_score(A.quality_ratios(obs, rules=rules), rules=rules).where(
        F.col("confidence_score") >= min_confidence)
    return obs.join(good.select("station_id"), "station_id", "left_semi")


def filter_values(obs: DataFrame, accept_synthetic: bool = False, accept_interpolated: bool = True) -> DataFrame:
    for v in A.MEASURES:
        obs = obs.withColumn(v, S.quality_filtered(v, f"{v}_quality", accept_synthetic, accept_interpolated))
    return obs


def ingest(raw: DataFrame, table: str, quarantine: str, run_log: str, run_id: str, started_at, min_confidence: float = 0.3,
           rules: P.QualityRules = P.QualityRules(), variables: dict[str, str] | None = None) -> dict:
    """Landed vendor rows into the observation table; returns the run's figures.

    The feed is read once: its normalised rows are stored, judged by station, and the judged rows written while their number is
    observed. The stations' judgement is hashed where it meets the rows, so no task sorts its share of them. Accepted values go
    through the quality filter into the upsert, with ``started_at`` as their time of ingest; rejected rows go to ``quarantine``
    by run; the run log gets one row. A repeated run writes the same rows again.
    """
    spark = raw.sparkSession
    at = F.lit(started_at).cast("timestamp")
    obs = stored(normalise_raw(raw, variables).withColumn("ingested_at", at), "ingest")
    good = A.confidence_score(A.quality_ratios(obs, rules=rules), rules=rules).select("station_id", (F.col("confidence_score") >= min_confidence).alias("accepted"))
    seen = Observation(f"ingest-{run_id}")
    judged = obs.join(good.hint("shuffle_hash"), "station_id", "left").withColumn("accepted", F.coalesce("accepted", F.lit(False))).observe(
        seen, F.count(F.lit(1)).alias("records"), F.count_if("accepted").alias("accepted"))
    path = scratch_path(spark, "judged")
    judged.write.parquet(path)
    parts = spark.read.schema(judged.schema).parquet(path)
    accepted = parts.where("accepted").drop("accepted")
    upsert(filter_values(accepted, rules.accept_synthetic, rules.accept_interpolated), table)
    parts.where("NOT accepted").drop("accepted").write.mode("overwrite").parquet(f"{quarantine}/run_id={run_id}")
    figures = seen.get
    stations = accepted.select("station_id").distinct().count()
    share = figures["accepted"] / figures["records"] if figures["records"] else None
    run = spark.range(1).select(
        F.lit(run_id).alias("run_id"), at.alias("started_at"), F.current_timestamp().alias("finished_at"), F.lit(stations).cast("int").alias("stations"),
        F.lit(figures["accepted"]).cast("long").alias("records"), F.lit(share).cast("double").alias("success_rate"), F.lit("success").alias("status"))
    log_run(run, run_log)
    return {**figures, "stations": stations}


def ingest_batch(raw: DataFrame, min_confidence: float = 0.3, rules: P.QualityRules = P.QualityRules(),
                 variables: dict[str, str] | None = None) -> DataFrame:
    """Landed vendor rows to accepted observations, ready for the upsert sink."""
    obs = normalise_raw(raw, variables)
    return filter_values(auto_exclude(obs, min_confidence, rules), rules.accept_synthetic, rules.accept_interpolated)
