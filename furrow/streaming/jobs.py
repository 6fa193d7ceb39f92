"""Structured Streaming forms of ingest, thresholds, rolling totals, runs and freshness.

Queries run with ``availableNow`` by default and write files, so state and output live in the
shared folder and a lost executor only repeats its tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from furrow.functions import scalar as S
from furrow.operators.sets import keep_last
from furrow.session import scratch_path, stored
from furrow.sources.sinks import last_wins, merge_dates, path_exists, replace_dates, upsert

DAY_MS = 86_400_000


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def deduplicated(stream: DataFrame, keys=("station_id", "date"), time: str = "event_time", delay: str = "14 days") -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_ingest(stream: DataFrame, table: str, checkpoint: str, order: str = "ingested_at") -> StreamingQuery:
    """Upsert every micro-batch into the observation table."""
    def write(batch: DataFrame, _: int) -> None:
        upsert(batch, table, order=order)

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def late_data_writer(table: str, ledger: str, delay_days: int = 14, order: str = "ingested_at", date: str = "date"):
    """A writer for ``foreachBatch``: rows within ``delay_days`` of the newest date seen update their key, later ones replace their date.

    The ledger has a row for each batch with the newest date seen up to it. A batch that is in it changes nothing, so a
    replay after a failure, or a second run of the stream, is harmless; the limit of a batch comes from the batches before it,
    so a replay of one that failed half-way splits it as before. Late rows are the truth about their date: what the table had
    for it goes.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, f"{ledger}/batch={number}"):
            return
        rows = stored(batch, "late")
        seen = spark.read.parquet(ledger).where(F.col("batch") < number).agg(F.max("newest")).first()[0] if path_exists(spark, ledger) else None
        limit = F.date_sub(F.lit(seen).cast("date"), delay_days)
        late = F.coalesce(F.col(date) < limit, F.lit(False))
        merge_dates(rows.where(~late), table, order=order, date=date)
        replace_dates(last_wins(rows.where(late), order=order), table, date)
        newest = rows.agg(F.max(date).alias("newest")).select(F.greatest("newest", F.lit(seen).cast("date")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    return write


def start_late_data(stream: DataFrame, table: str, ledger: str, checkpoint: str, **options) -> StreamingQuery:
    """Run ``late_data_writer`` over all available input."""
    return (stream.writeStream.foreachBatch(late_data_writer(table, ledger, **options)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def threshold_events(stream: DataFrame) -> DataFrame:
    """Stateless frost and heat flags."""
    frost, heat = S.frost_severity_flat("min_temp"), S.heat_severity_flat("max_temp")
    hit = F.array_compact(F.array(
        F.when(frost.isNotNull(), F.struct(F.lit("frost").alias("event_type"), frost.alias("severity"))),
        F.when(heat.isNotNull(), F.struct(F.lit("heat").alias("event_type"), heat.alias("severity")))))
    return stream.select("station_id", "event_time", F.explode(hit).alias("e")).select("station_id", "event_time", "e.*")


def daily_values(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Daily total per station from finer readings."""
    return (stream.withWatermark("event_time", delay).groupBy("station_id", F.window("event_time", "1 day").alias("w"))
            .agg(F.sum("value").alias("value")).select("station_id", F.col("w.start").alias("event_time"), "value"))


def rolling(stream: DataFrame, days: int, delay: str = "2 days", min_valid: float = 0.8) -> DataFrame:
    """Sliding n-day total per station over daily rows, with the row and validity gates."""
    w = F.window("event_time", f"{days} days", "1 day")
    agg = stream.withWatermark("event_time", delay).groupBy("station_id", w.alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_valid"), F.sum("value").alias("_sum"))
    gate = (F.col("n_rows") >= days) & (F.col("n_valid") >= days * min_valid)
    return agg.select("station_id", F.date_sub(F.col("w.end").cast("date"), 1).alias("date"), "n_rows",
                      F.when(gate, F.col("_sum")).alias("total"))


def daily_summary(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    return (stream.withWatermark("event_time", delay).groupBy(F.window("event_time", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_valid"), F.avg("value").alias("avg_value"),
                 F.max("value").alias("max_value"))
            .select(F.col("w.start").cast("date").alias("date"), "n_rows", "n_valid", "avg_value", "max_value"))


def runs(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Runs of consecutive event days: sessions with a 25-hour gap over date-truncated times."""
    day = stream.select("station_id", F.date_trunc("day", "event_time").alias("event_time"))
    w = F.session_window("event_time", "25 hours")
    return (day.withWatermark("event_time", delay).groupBy("station_id", w.alias("w")).agg(F.min("event_time").alias("_a"), F.max("event_time").alias("_b"))
            .select("station_id", F.col("_a").cast("date").alias("run_start"), F.col("_b").cast("date").alias("run_end"),
                    (F.datediff("_b", "_a") + 1).alias("run_length")))


def _merged(runs: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    """Runs (first day, last day, changed) that touch or overlap made one."""
    out: list[tuple[int, int, bool]] = []
    for first, last, changed in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] or changed)
        else:
            out.append((first, last, changed))
    return out


def _advance(key: tuple, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take a station's new nights into its runs and give all nights of the runs that changed.

    The state keeps the runs a night may still reach; a timer at the oldest one's end wakes stations without new nights.
    """
    runs = [(a, b, False) for a, b in zip(*state.get)] if state.exists else []
    for chunk in chunks:
        if len(chunk):
            runs = _merged(runs + [(int(d), int(d), True) for d in chunk["day"].unique()])
    for first, last, changed in runs:
        if changed:
            n = last - first + 1
            yield pd.DataFrame({"station_id": key[0], "date": pd.to_datetime(range(first, last + 1), unit="D").date,
                                "run_position": range(1, n + 1), "run_length": n})
    watermark = state.getCurrentWatermarkMs()
    still = [(a, b) for a, b, _ in runs if (b + 1) * DAY_MS >= watermark]
    if still:
        state.update(([a for a, _ in still], [b for _, b in still]))
        state.setTimeoutTimestamp((min(b for _, b in still) + 2) * DAY_MS)
    elif state.exists:
        state.remove()


def run_positions(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Position and length of every event night in its run, open runs included; an update stream.

    A batch gives all nights of the runs it changed, so each night's last version equals the batch form's numbers after every
    batch. Rows without station or time are left out, repeats of a night count once, and nights behind the watermark are dropped.
    A station's state is bounded by the runs that end within ``delay`` of the newest night.
    """
    day = stream.where(F.col("station_id").isNotNull() & F.col("event_time").isNotNull()).select(
        "station_id", F.date_trunc("day", "event_time").alias("event_time"))
    nights = day.withWatermark("event_time", delay).withColumn("day", F.unix_date(F.col("event_time").cast("date")))
    return nights.groupBy("station_id").applyInPandasWithState(
        _advance, "station_id string, date date, run_position int, run_length bigint", "starts array<int>, ends array<int>", "update",
        GroupStateTimeout.EventTimeTimeout)


def freshness(stream: DataFrame, region: str = "region") -> DataFrame:
    """Newest observation per region; run in complete mode and compare with the cutoff."""
    return stream.groupBy(region).agg(F.max("event_time").cast("date").alias("max_obs_date"))


def append_updates(result: DataFrame, out: str, checkpoint: str) -> None:
    """Run an update stream over all input not seen yet; each batch's rows go to a folder of its number, so a replay rewrites them."""
    def write(batch: DataFrame, i: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={i}")

    (result.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
     .trigger(availableNow=True).start().awaitTermination())


def latest_versions(result: DataFrame, out: str, keys: tuple[str, ...]) -> DataFrame:
    """Each key's last version among the files of ``append_updates``."""
    versions = result.sparkSession.read.option("basePath", out).parquet(out)
    return keep_last(versions, keys, [F.desc("batch")]).select(*result.columns)


def run_to_files(result: DataFrame, name: str, mode: str = "append", keys: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over all available input and return its output as a batch frame.

    Complete mode leaves the last state; update mode keeps each key's last version.
    """
    spark = result.sparkSession
    out, checkpoint = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")

    def write(batch: DataFrame, i: int) -> None:
        target = out if mode == "complete" else f"{out}/batch={i}"
        batch.write.mode("overwrite").parquet(target)

    writer = result.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:
        query = writer.foreachBatch(write).start()
    query.awaitTermination()
    if mode == "update":
        versions = spark.read.option("basePath", out).parquet(out)
        return keep_last(versions, keys, [F.desc("batch")]).select(*result.columns)
    return spark.read.schema(result.schema).parquet(out)
