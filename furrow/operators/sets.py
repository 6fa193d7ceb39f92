"""Set operations on frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def union_sparse(*frames: DataFrame) -> DataFrame:
    """Union by name; a column some frames lack is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def replicate_into_seasons(rows: DataFrame, flag: str, season: str, scope: Sequence[str]) -> DataFrame:
    """Put rows without a season into every season seen in their scope."""
    seasons = rows.where(F.col(season).isNotNull()).select(*scope, season).distinct()
    no_data = rows.where(F.col(flag) == "no_data").drop(season).join(seasons, list(scope))
    return rows.where(F.col(flag) != "no_data").unionByName(no_data)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the last by ``order`` (given as descending columns)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def key_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of both sides labelled left_only, right_only or both."""
    left = a.select(key).distinct().withColumn("_a", F.lit(True))
    right = b.select(key).distinct().withColumn("_b", F.lit(True))
    where = F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").otherwise("both")
    return left.join(right, key, "full").select(key, where.alias("side"))


def override_universe(base: DataFrame, override: DataFrame, scope: str) -> DataFrame:
    """Rows of the override, plus base rows whose scope the override does not cover."""
    rest = base.join(override.select(scope).distinct(), scope, "left_anti")
    return override.unionByName(rest)


def append_current(history: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the running year after those of the years before, by name; no row is merged or dropped."""
    return history.select(*columns).unionByName(current.select(*columns))


def membership(df: DataFrame, targets: DataFrame, key: str, labels=("in_target", "outside"), name: str = "side") -> DataFrame:
    """Rows labelled by whether their key is among the targets' keys, in one join; a NULL key is outside."""
    known = targets.select(F.col(key).alias("_key")).distinct()
    return df.join(known, F.col(key) == F.col("_key"), "left").withColumn(
        name, F.when(F.col("_key").isNotNull(), labels[0]).otherwise(labels[1])).drop("_key")


def with_every(universe: DataFrame, facts: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Facts of each key of the universe for every one of a few values, NULL where there are none; other facts go."""
    grid = universe.select(*keys).distinct().withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid.join(facts, [*keys, column], "left")


def tiers(df: DataFrame, value: str, floors: dict[str, float], rest: str, keep: Sequence[str] | None = None, name: str = "tier") -> DataFrame:
    """Rows with the name of the highest floor they reach, else ``rest``; only the tiers to keep, if given."""
    tier = F.lit(rest)
    for label, floor in sorted(floors.items(), key=lambda f: f[1]):
        tier = F.when(F.col(value) >= floor, label).otherwise(tier)
    out = df.withColumn(name, tier)
    return out if keep is None else out.where(F.col(name).isin(*keep))
