"""Join operators: hierarchy look-ups, fail-loud matching, split allocation, as-of and overlay.

No broadcast is forced anywhere: Spark broadcasts a side whose size it has measured against
``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions import scalar as S


def fail_unless_empty(df: DataFrame, message: str) -> None:
    """Raise with a few sample rows when ``df`` holds any row."""
    sample = df.limit(5).collect()
    if sample:
        raise ValueError(f"{message}: {[r.asDict() for r in sample]}")


def dimension_join(facts: DataFrame, dim: DataFrame, on: str | Sequence[str],
                   fallbacks: dict[str, Column] | None = None) -> DataFrame:
    """Left join to a dimension that is first cut to one row per key."""
    keys = [on] if isinstance(on, str) else list(on)
    out = facts.join(dim.dropDuplicates(keys), keys, "left")
    for name, value in (fallbacks or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out


def region_names(dim: DataFrame, names: DataFrame, on: str = "station_id", name: str = "sa2_name") -> DataFrame:
    """Station dimension with its region name from a preferred source, else its own."""
    preferred = names.select(on, F.col(name).alias("_preferred")).dropDuplicates([on])
    return (dim.join(preferred, on, "left")
            .withColumn(name, F.coalesce("_preferred", name)).drop("_preferred").dropDuplicates([on]))


def led_join(left: DataFrame, right: DataFrame, on: str, flag: str, renamed: str) -> DataFrame:
    """Keep every left row; unmatched ones carry ``no_data`` as their flag."""
    out = left.join(right, on, "left")
    return out.withColumn(renamed, F.coalesce(flag, F.lit("no_data"))).drop(flag)


def weighted_measure(facts: DataFrame, weights: DataFrame, on: Sequence[str], value: str, weight: str, name: str) -> DataFrame:
    """Facts that have a weight, with value times weight."""
    return facts.join(weights.select(*on, weight), list(on)).withColumn(name, F.col(value) * F.col(weight)).drop(weight)


def bridge(facts: DataFrame, concordance: DataFrame, areas: DataFrame, key: str = "sa2_code",
           area: str = "area", strict: bool = True) -> DataFrame:
    """Split-allocation bridge: weight = allocation ratio x area, an unknown area counting as 0.

    With ``strict`` a fact whose key the concordance lacks raises.
    """
    if strict:
        fail_unless_empty(facts.select(key).distinct().join(concordance.select(key), key, "left_anti"),
                          "regions absent from the concordance")
    sized = concordance.join(areas.select(key, area), key, "left")
    sized = sized.withColumn("weight", F.col("allocation_ratio") * F.coalesce(area, F.lit(0.0))).drop(area)
    return facts.join(sized, key)


def members(concordance: DataFrame, areas: DataFrame, key: str = "sa2_code", area: str = "area") -> DataFrame:
    """Members of each upper region with positive weight."""
    sized = concordance.join(areas.select(key, area), key)
    return sized.withColumn("weight", F.col("allocation_ratio") * F.col(area)).where("weight > 0").drop(area)


def dominant(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """The value with the largest total weight per key; ties go to the smallest value."""
    totals = df.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    best = F.min_by(value, F.struct(-F.col("_w"), F.col(value)))
    return totals.groupBy(*keys).agg(best.alias(value), F.max("_w").alias("weight"))


def strict_inner(a: DataFrame, b: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Inner join, and a one-row frame counting the keys each side loses."""
    on = list(on)
    sides = a.select(*on).distinct().withColumn("_a", F.lit(1)).join(
        b.select(*on).distinct().withColumn("_b", F.lit(1)), on, "full")
    dropped = sides.agg(
        F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"))
    return a.join(b, on), dropped


def overlay(base: DataFrame, top: DataFrame, on: Sequence[str], columns: Sequence[str],
            status: str = "daily_features_status", label: str = "station_daily") -> DataFrame:
    """Prefer the top layer's non-null values and mark the rows that received any."""
    renamed = top.select(*on, *[F.col(c).alias(f"_top_{c}") for c in columns])
    out = base.join(renamed, list(on), "left")
    got = F.coalesce(*[F.col(f"_top_{c}").cast("string") for c in columns]).isNotNull()
    out = out.withColumn(status, F.when(got, label).otherwise(F.col(status)))
    for c in columns:
        top_c = F.col(f"_top_{c}")
        out = out.withColumn(c, F.coalesce(top_c, F.col(c)) if c in base.columns else top_c)
    return out.drop(*[f"_top_{c}" for c in columns])


def as_of_guide(facts: DataFrame, guides: DataFrame, on: Sequence[str], fact_year: str = "season_year",
                guide_year: str = "source_year") -> DataFrame:
    """Latest guide not newer than the fact's year, per key and guide commodity.

    Both sides are grouped per key: guide versions of a key are few (one per publication year).
    """
    on = list(on)
    rest = [c for c in guides.columns if c not in on and c != "commodity"]
    versions = guides.groupBy(*on, "commodity").agg(
        F.array_sort(F.collect_list(F.struct(guide_year, *[c for c in rest if c != guide_year]))).alias("_g"))
    out = facts.join(versions, on)
    usable = F.filter("_g", lambda g: g[guide_year] <= F.col(fact_year))
    out = out.withColumn("_pick", F.try_element_at(usable, F.lit(-1))).where(F.col("_pick").isNotNull())
    return out.select(*facts.columns, "commodity", *[F.col(f"_pick.{c}").alias(c) for c in rest])


def unique_name_match(left: DataFrame, right: DataFrame, left_id: str, left_name: str,
                      right_id: str, right_name: str, claimed: DataFrame | None = None) -> DataFrame:
    """Match names that are equal or continue after a space, where the match is one to one.

    Each right name is indexed by its word prefixes, so the comparison is an equality join.
    ``claimed`` lists right ids already taken.
    """
    if claimed is not None:
        right = right.join(claimed.select(right_id), right_id, "left_anti")
    clean = lambda c: F.lower(F.trim(F.col(c)))
    words = F.split(clean(right_name), " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, F.lit(1), i), " "))
    # names are counted on both sides before they meet, so a frequent name costs one row, not its pairs
    r = right.select(right_id, F.explode(prefixes).alias("_name")).where("_name <> ''").groupBy("_name").agg(
        F.count(F.lit(1)).alias("_nr"), F.min(right_id).alias(right_id)).where("_nr = 1")
    lft = left.select(left_id, clean(left_name).alias("_name")).groupBy("_name").agg(
        F.count(F.lit(1)).alias("_nl"), F.min(left_id).alias(left_id))
    once = lft.join(r, "_name").groupBy(right_id).agg(F.sum("_nl").alias("_n"), F.min(left_id).alias(left_id))
    return once.where("_n = 1").select(left_id, right_id)


def fallback_area(current: DataFrame, correspondence: DataFrame, earlier: DataFrame, crop: str = "wheat",
                  source_year: str = "2015-16", base_year: str = "2020-21") -> DataFrame:
    """Fill suppressed areas of one crop from an earlier census over good correspondences, and say from where.

    A region may overlap several earlier ones: of those with an estimate, the one of the greatest ratio counts, then that of
    the least code. ``area_fallback_reason`` names it; ``correspondence`` may have its name in ``name_2011``.
    """
    name = F.col("name_2011") if "name_2011" in correspondence.columns else F.col("region_2011")
    pick = F.struct("ratio", F.col("estimate").alias("estimate"), name.cast("string").alias("name"))
    # one grouping folds the overlaps: the least (minus ratio, code) is the greatest ratio, and among equal ones the least code
    good = (correspondence.where(F.col("quality") == "Good").join(earlier, "region_2011").where(F.col("estimate").isNotNull())
            .groupBy("sa2_code").agg(F.min_by(pick, F.struct(-F.col("ratio"), "region_2011")).alias("_pick"))
            .select("sa2_code", F.col("_pick.estimate").alias("_fallback"), F.col("_pick.ratio").alias("ratio"), F.col("_pick.name").alias("_name")))
    out = current.join(good, "sa2_code", "left")
    use = F.col("area_ha").isNull() & F.col("_fallback").isNotNull() & (F.col("crop") == crop)
    reason = F.format_string(f"Uses {source_year} ABS fallback area (2011 SA2 '%s', ratio=%.4f); {base_year} {crop} area not published (np)", "_name", F.col("ratio").cast("double"))
    return (
        out.withColumn("area_ha_for_weighting", F.when(use, F.col("_fallback")).otherwise(F.col("area_ha")))
        .withColumn("area_source_year", S.cases(
            (use, source_year), (F.col("area_ha").isNotNull(), base_year), otherwise=""))
        .withColumn("area_fallback_reason", F.when(use, reason).otherwise(F.lit("")))
        .withColumn("area_is_fallback", use).drop("_fallback", "ratio", "_name")
    )
