"""Risk-event detection over a whole date range in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow import params as P
from furrow.functions import scalar as S
from furrow.operators import joins, sets, spatial
from furrow.operators.timeseries import consecutive_runs, rolling_totals

COLUMNS = (
    "station_id", "date", "event_type", "severity", "value", "threshold", "crop_stage", "confidence",
    "data_quality", "accumulation_window", "rainfall_role", "crop_type", "phenology_risk_multiplier",
    "flowering_window_active", "days_since_flowering_start",
)
RUN_COLUMNS = ("consecutive_night", "sequence_id", "detected_at")


QUALITIES = ("min_temp_quality", "max_temp_quality", "rainfall_quality")


def with_stage(obs: DataFrame, calendar: str = "dates") -> DataFrame:
    """Attach the crop stage and its flags; pure expressions on the date, no join."""
    stage = S.crop_stage("date", calendar)
    return obs.withColumn("crop_stage", stage).select(
        "*", *[S.stage_flag("crop_stage", k).alias(f"{k}_critical") for k in ("frost", "heat", "rain")])


def _event(event_type: str, severity, value, threshold, *, window=None, crop=None) -> Column:
    """The part of an event that depends on its rule; the rest is filled in after the expansion."""
    def typed(x, t):
        return (F.lit(x) if not isinstance(x, Column) else x).cast(t)

    return F.struct(
        F.lit(event_type).alias("event_type"), typed(severity, "string").alias("severity"),
        typed(value, "double").alias("value"), typed(threshold, "double").alias("threshold"),
        typed(window, "int").alias("accumulation_window"), typed(crop, "string").alias("crop_type"))


def _frost() -> Column:
    temp = F.col("min_temp")
    severity = S.frost_severity(temp, "crop_stage")
    rec = _event("frost", severity, temp, S.frost_threshold_hit(temp, "crop_stage"))
    return F.when(F.col("frost_critical") & severity.isNotNull(), rec)


def _heat() -> Column:
    temp = F.col("max_temp")
    severity = S.heat_severity(temp)
    rec = _event("heat", severity, temp, S.heat_threshold_hit(temp))
    return F.when(F.col("heat_critical") & severity.isNotNull(), rec)


def _harvest(severe_tier: bool) -> list[Column]:
    t = P.HARVEST_RAIN
    live = F.col("rain_critical") & F.col("rainfall").isNotNull()

    def rec(severity, value, threshold, window):
        return _event("rainfall", severity, value, threshold, window=window)

    total = F.col("total_3d")
    one_day = F.when(live & (F.col("rainfall") >= t["moderate"]), rec("moderate", F.col("rainfall"), t["moderate"], 1))
    three_day = F.when(live & (total >= t["high"]), rec("high", total, t["high"], 3))
    out = [one_day, three_day]
    if severe_tier:
        out.append(F.when(live & (total >= t["severe"]), rec("severe", total, t["severe"], 3)))
    return out


def _seeding() -> list[Column]:
    total, month = F.col("total_7d"), F.month("date")
    out = []
    for crop in P.SEEDING_CROPS:
        severity = S.cases((total >= crop.adequate, "adequate"), (total >= crop.marginal, "marginal"),
                           (total >= crop.marginal_low, "marginal_low"), ((month >= 5) & (total < crop.marginal_low), "inadequate"))
        threshold = S.cases((total >= crop.adequate, crop.adequate), (total >= crop.marginal, crop.marginal),
                            otherwise=crop.marginal_low)
        live = month.isin(*crop.months) & F.col("rainfall").isNotNull() & severity.isNotNull()
        out.append(F.when(live, _event("seeding_rain", severity, total, threshold, window=7, crop=crop.name)))
    return out


def _development() -> list[Column]:
    live = F.month("date").isin(*P.DEVELOPMENT_MONTHS) & F.col("rainfall").isNotNull()
    out = []
    for days, limit, severity in ((7, P.DRY_SPELL_7D_MM, "dry_spell"), (14, P.DRY_SPELL_14D_MM, "moisture_stress")):
        total = F.col(f"total_{days}d")
        out.append(F.when(live & (total < limit), _event("development_rain", severity, total, limit, window=days)))
    return out


def _expand(rows: DataFrame, candidates: list[Column]) -> DataFrame:
    """One row per fired rule; confidence, stage and phenology are worked out for fired rows only."""
    fired = F.explode(F.array_compact(F.array(*candidates))).alias("e")
    out = rows.select("station_id", "date", F.col("crop_stage").alias("_stage"), *QUALITIES, fired).select("*", "e.*").drop("e")
    et = F.col("event_type")
    frost = et == "frost"
    quality = F.when(frost, F.col(QUALITIES[0])).when(et == "heat", F.col(QUALITIES[1])).otherwise(F.col(QUALITIES[2]))
    out = out.select("*", quality.cast("int").alias("data_quality"), S.flowering_active("date").alias("_active"),
                     S.days_since_flowering("date").alias("_since"))
    return out.select(
        "station_id", "date", "event_type", "severity", "value", "threshold",
        F.when(et == "rainfall", "harvest").when(et == "seeding_rain", "seeding").otherwise(F.col("_stage")).alias("crop_stage"),
        S.quality_confidence("data_quality").alias("confidence"), "data_quality", "accumulation_window",
        F.when(et.isin("seeding_rain", "development_rain"), "beneficial").alias("rainfall_role"), "crop_type",
        F.when(frost, S.phenology_multiplier("_stage", "frost", "_active", "_since")).alias("phenology_risk_multiplier"),
        F.when(frost, F.col("_active")).alias("flowering_window_active"), F.when(frost, F.col("_since")).alias("days_since_flowering_start"),
    ).select(*COLUMNS)


def complete_rows(obs: DataFrame) -> DataFrame:
    """Days on which all three measures are present, as the daily scan delivers them."""
    return obs.where(F.col("min_temp").isNotNull() & F.col("max_temp").isNotNull() & F.col("rainfall").isNotNull())


def detect_events(obs: DataFrame, start=None, end=None, calendar: str = "dates", severe_tier: bool = False,
                  lookback_days: int = 14, complete_only: bool = True, detected_at=None) -> DataFrame:
    """All five event types for a date range, with run columns: ``consecutive_night`` and ``sequence_id`` of frosts, ``detected_at``.

    Rain and heat take one exchange on (station, time block): rows before ``start`` inside the lookback feed the rolling
    totals and are then dropped, and each day's candidate events are an array of structs. Frost nights need no totals; they
    are numbered over the record up to ``end``, so a run that is open at ``start`` goes on counting and a sequence has the same
    name in every range. ``detected_at`` is a time stamp, now by default.
    """
    if complete_only:
        obs = complete_rows(obs)
    if end is not None:
        obs = obs.where(F.col("date") <= F.lit(end).cast("date"))
    frost = numbered_frosts(obs, calendar)
    if start is not None:
        obs = obs.where(F.col("date") >= F.date_sub(F.lit(start).cast("date"), lookback_days - 1))
        frost = frost.where(F.col("date") >= F.lit(start).cast("date"))
    rows = rolling_totals(obs, (3, 7, 14))
    if start is not None:
        rows = rows.where(F.col("date") >= F.lit(start).cast("date"))
    rest = _expand(with_stage(rows, calendar), [_heat(), *_harvest(severe_tier), *_seeding(), *_development()])
    at = F.current_timestamp() if detected_at is None else F.lit(detected_at).cast("timestamp")
    return sets.union_sparse(frost, rest).withColumn("detected_at", at).select(*COLUMNS, *RUN_COLUMNS)


def numbered_frosts(obs: DataFrame, calendar: str = "dates") -> DataFrame:
    """Frost events with ``consecutive_night`` and ``sequence_id``."""
    runs = consecutive_runs(_expand(with_stage(obs, calendar), [_frost()]))
    return runs.withColumnRenamed("run_position", "consecutive_night").drop("run_length")


def frost_events(obs: DataFrame, calendar: str = "dates") -> DataFrame:
    """Frost events with run numbering over the whole range."""
    events = _expand(with_stage(obs, calendar), [_frost()])
    return consecutive_runs(events)


def harvest_rain_events(obs: DataFrame, calendar: str = "dates", severe_tier: bool = False) -> DataFrame:
    return _expand(with_stage(rolling_totals(complete_rows(obs), (3,)), calendar), _harvest(severe_tier))


def seeding_events(obs: DataFrame) -> DataFrame:
    return _expand(with_stage(rolling_totals(complete_rows(obs), (7,))), _seeding())


def development_events(obs: DataFrame) -> DataFrame:
    return _expand(with_stage(rolling_totals(complete_rows(obs), (7, 14))), _development())


def flat_threshold_events(obs: DataFrame) -> DataFrame:
    """Calendar-free frost and heat events with strict thresholds."""
    frost, heat = S.frost_severity_flat("min_temp"), S.heat_severity_flat("max_temp")
    level = {"severe": -2.0, "moderate": 0.0, "light": 2.0, "very_hot": 35.0, "hot": 32.0}

    def rec(kind, severity, value, quality):
        code = F.coalesce(F.col(quality), F.lit(P.MISSING_CODE)).cast("int")
        return F.when(severity.isNotNull(), F.struct(
            F.lit(kind).alias("event_type"), severity.alias("severity"), F.col(value).alias("value"),
            S.lookup(severity, level).alias("threshold"), S.quality_confidence(code).alias("confidence"),
            code.alias("data_quality")))

    fired = F.array_compact(F.array(rec("frost", frost, "min_temp", "min_temp_quality"),
                                    rec("heat", heat, "max_temp", "max_temp_quality")))
    return obs.select("station_id", "date", F.explode(fired).alias("e")).select("station_id", "date", "e.*")


def enrich_with_regions(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Region names for events: by station id, or by the nearest station for grid point ids.

    Grid points are looked up once per distinct id, not once per event.
    """
    names = ["sa2_name", "sa3_name", "sa4_name"]
    events = events.withColumn("station_id", S.norm_station_id("station_id"))
    is_point = F.col("station_id").startswith("DD_")
    direct = joins.dimension_join(events.where(~is_point), stations.select("station_id", *names), "station_id")
    ids = events.where(is_point).select("station_id").distinct().select(
        F.col("station_id").alias("point_id"), S.point_lat("station_id").alias("lat"), S.point_lon("station_id").alias("lon"))
    nearest = spatial.nearest_site(ids, stations, "site", site_lat="latitude", site_lon="longitude") if "site" in stations.columns \
        else spatial.nearest_site(ids, stations.withColumnRenamed("station_id", "site"), "site")
    labels = nearest.join(stations.select(F.col("station_id").alias("site"), *names), "site").select(
        F.col("point_id").alias("station_id"), *names)
    by_point = events.where(is_point).join(labels, "station_id", "left")
    out = sets.union_sparse(direct, by_point)
    for c in names:
        out = out.withColumn(c, F.coalesce(c, F.lit("")))
    return out.withColumn("region_name", F.col("sa2_name"))
