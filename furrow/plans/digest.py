"""Report tables: daily digest, season summary and event context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from furrow.functions import scalar as S
from furrow.operators import joins
from furrow.operators.topk import top_k
from furrow.session import stored

EVENT_TYPES = ("frost", "heat", "rainfall", "development_rain", "seeding_rain")
SEEDING_ORDER = {"adequate": 0, "marginal": 1, "marginal_low": 2, "inadequate": 3}


def in_year(events: DataFrame, year: int) -> DataFrame:
    """Events of a calendar year, by a range of the date itself, which a scan can skip files by."""
    return events.where(F.col("date").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")))


def daily_digest(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Events by type, stations affected and the largest harvest rain per date and state; needs a known station."""
    et = F.col("event_type")
    rows = events.join(stations.select("station_id", "state_name"), "station_id")
    return rows.groupBy("date", "state_name").agg(
        F.count(F.lit(1)).alias("total_events"), *[F.count_if(et == t).alias(f"{t}_events") for t in EVENT_TYPES],
        F.countDistinct("station_id").alias("stations_affected"), F.max(F.when(et == "rainfall", F.col("value"))).alias("wettest"))


def season_summary(events: DataFrame, season: int, k: int = 5) -> DataFrame:
    """A season's tables in one long table, told apart by ``section``.

    ``month``: events by month and type, NULL for all months or all types; ``peak``: the strongest frost, heat and
    harvest-rain event; ``stressed``: the station with most development events; ``top``: the ``k`` stations with most events.
    Events are read once, into a count and the strongest event per station, month and type; all sections are made of those.
    """
    et = F.col("event_type")
    strength = F.when(et == "frost", -F.col("value")).otherwise(F.col("value"))
    worst = F.struct("date", "severity", "value")
    cells = stored(in_year(events, season).groupBy("station_id", F.month("date").alias("month"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max(strength).alias("strength"),
        F.min_by(worst, F.struct(-strength, F.col("date"))).alias("worst")), "season-cells")
    n = F.sum("n_events").alias("n_events")

    def section(name: str, rows: DataFrame) -> DataFrame:
        types = {"rank": "int", "month": "int", "event_type": "string", "station_id": "string", "date": "date", "severity": "string",
                 "value": "double", "n_events": "long"}
        return rows.select(F.lit(name).alias("section"), *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])

    pick = F.min_by(F.struct("station_id", "worst"), F.struct(-F.col("strength"), F.col("station_id"), F.col("worst.date")))
    peaks = cells.where(et.isin("frost", "heat", "rainfall")).groupBy("event_type").agg(pick.alias("p")).select("event_type", "p.station_id", "p.worst.*")
    by_station = cells.groupBy("station_id").agg(n)
    stressed = cells.where(et == "development_rain").groupBy("station_id").agg(n).orderBy(F.desc("n_events"), "station_id").limit(1)
    top = by_station.orderBy(F.desc("n_events"), "station_id").limit(k)
    ranked = top.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n_events"), "station_id")))  # k rows
    parts = [section("month", cells.cube("month", "event_type").agg(n)), section("peak", peaks),
             section("stressed", stressed), section("top", ranked)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def daily_counts(events: DataFrame) -> DataFrame:
    """Events by type and stations affected per date."""
    et = F.col("event_type")
    return events.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_events"), *[F.count_if(et == t).alias(f"{t}_events") for t in EVENT_TYPES],
        F.countDistinct("station_id").alias("stations_affected"))


def season_counts(events: DataFrame) -> DataFrame:
    """Per season and type: count, share of the season, stations and events inside flowering."""
    rows = events.withColumn("season", F.year("date"))
    total = rows.groupBy("season").agg(F.count(F.lit(1)).alias("_total"))
    out = rows.groupBy("season", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("station_id").alias("n_stations"),
        F.count_if(F.coalesce("flowering_window_active", F.lit(False))).alias("n_in_flowering"))
    return out.join(total, "season").withColumn("share_pct", F.col("n_events") * 100.0 / F.col("_total")).drop("_total")


def severity_split(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "severity").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("station_id").alias("n_stations"), F.avg("value").alias("avg_value"))


def region_severity(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Event counts by region and severity."""
    dim = stations.select("station_id", "sa2_name", "state_name")
    return joins.dimension_join(events, dim, "station_id").groupBy("state_name", "sa2_name", "event_type", "severity").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("station_id").alias("n_stations"),
        F.avg("confidence").alias("avg_confidence"))


def monthly_matrix(events: DataFrame, season: int) -> DataFrame:
    """Month by event type with totals on both sides."""
    rows = in_year(events, season).withColumn("month", F.month("date"))
    et = F.col("event_type")
    return rows.rollup("month").agg(
        *[F.count_if(et == t).alias(t) for t in EVENT_TYPES], F.count(F.lit(1)).alias("total"))


def peak_events(events: DataFrame) -> DataFrame:
    """Coldest frost, hottest heat and wettest rainfall event, one row each."""
    rows = events.where(F.col("event_type").isin("frost", "heat", "rainfall"))
    # cold is worst for frost, so its value is negated to make the largest the worst everywhere
    strength = F.when(F.col("event_type") == "frost", -F.col("value")).otherwise(F.col("value"))
    pick = F.min_by(F.struct("station_id", "date", "severity", "value"), F.struct(-strength, F.col("station_id"), F.col("date")))
    return rows.groupBy("event_type").agg(pick.alias("p")).select("event_type", "p.*")


def most_stressed_station(events: DataFrame) -> DataFrame:
    counts = events.where(F.col("event_type") == "development_rain").groupBy("station_id").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.orderBy(F.desc("n_events"), F.asc("station_id")).limit(1)


def top_stations(events: DataFrame, k: int = 5) -> DataFrame:
    counts = events.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.orderBy(F.desc("n_events"), F.asc("station_id")).limit(k)


def seeding_regions(events: DataFrame) -> DataFrame:
    """Best severity, largest total and stations per crop and region; events carry sa2_name."""
    rows = events.where(F.col("event_type") == "seeding_rain").withColumn("_rank", S.lookup("severity", SEEDING_ORDER))
    return rows.groupBy("crop_type", "sa2_name").agg(
        F.min_by("severity", "_rank").alias("best_severity"), F.max("value").alias("max_value"),
        F.countDistinct("station_id").alias("n_stations"))


def moisture_status(events: DataFrame) -> DataFrame:
    """Per date: state of the seeding, development and harvest windows."""
    et, sev, month = F.col("event_type"), F.col("severity"), F.month("date")
    dry_seed = (et == "seeding_rain") & (sev == "inadequate")
    dry_dev = (et == "development_rain") & sev.isin("dry_spell", "moisture_stress")
    out = events.groupBy("date").agg(
        F.countDistinct(F.when(dry_seed, F.col("station_id"))).alias("seeding_dry_stations"),
        F.count_if((et == "seeding_rain") & (sev == "adequate")).alias("seeding_adequate"),
        F.count_if(et == "seeding_rain").alias("_seed"),
        F.countDistinct(F.when(dry_dev, F.col("station_id"))).alias("development_dry_stations"),
        F.count_if(et == "development_rain").alias("_dev"),
        F.count_if(et == "rainfall").alias("harvest_events"))

    def status(active, dry, adequate, seen, before):
        return S.cases(
            (~active, F.when(month < before, "Pre-season").otherwise("Complete")), (seen == 0, "No data"),
            (dry > 0, "DRY SPELL"), (adequate > 0, "Adequate"), otherwise="Monitoring")

    c = F.col
    return out.select(
        "date", "seeding_dry_stations", "seeding_adequate", "development_dry_stations", "harvest_events",
        status(month.between(4, 6), c("seeding_dry_stations"), c("seeding_adequate"), c("_seed"), 4).alias("seeding_status"),
        status(month.between(7, 10), c("development_dry_stations"), F.lit(0), c("_dev"), 7).alias("development_status"),
        F.when(month.isin(11, 12, 1), "Active").when(month < 11, "Pre-season").otherwise("Complete").alias("harvest_status"))


def stressed_stations(events: DataFrame, k: int = 5) -> DataFrame:
    """First k dry stations of each date with their driest total."""
    dry = events.where(F.col("event_type").isin("seeding_rain", "development_rain")
                       & F.col("severity").isin("inadequate", "dry_spell", "moisture_stress"))
    per = dry.groupBy("date", "station_id").agg(
        F.min("value").alias("value"), F.min_by("accumulation_window", F.struct("value", "accumulation_window")).alias("accumulation_window"))
    return top_k(per, ["date"], [F.asc("station_id")], k)


def event_quality(events: DataFrame) -> DataFrame:
    """Share of confident events and of events from observed data, per type."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.avg((F.col("confidence") >= 0.9).cast("double")).alias("high_confidence_share"),
        F.avg((F.coalesce("data_quality", F.lit(999)) == 0).cast("double")).alias("perfect_quality_share"),
        F.max("data_quality").alias("worst_code"))


def top_crops(context: DataFrame, k: int = 5) -> DataFrame:
    """Crops of each region by area share, unknown shares last."""
    return top_k(context, ["station_sa2_5dig16"], [F.desc_nulls_last("area_share"), F.asc("crop")], k)


def crop_context_for_events(events: DataFrame, stations: DataFrame, context: DataFrame, k: int = 5) -> DataFrame:
    """Leading crops of the regions that had events."""
    affected = (events.select("station_id").distinct().join(stations.select("station_id", "sa2_5"), "station_id")
                .select(F.col("sa2_5").alias("station_sa2_5dig16")).distinct())
    return top_crops(context.join(affected, "station_sa2_5dig16", "left_semi"), k)


def with_area_share(context: DataFrame) -> DataFrame:
    """Crop area over the region's known crop areas."""
    totals = context.groupBy("station_sa2_5dig16").agg(F.sum("area_ha").alias("_total"))
    return context.join(totals, "station_sa2_5dig16").withColumn(
        "area_share", F.col("area_ha") / F.nullif("_total", F.lit(0.0))).drop("_total")
