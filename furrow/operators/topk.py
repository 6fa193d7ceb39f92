"""Ordered picks per group; ``row_number() <= k`` lets Spark drop rows before the exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def both_ends(df: DataFrame, keys: Sequence[str], by: Sequence[str], k: int, labels=("driest", "wettest")) -> DataFrame:
    """First and last k rows of each group; a row may be in both."""
    low = top_k(df, keys, [F.asc_nulls_last(c) for c in by], k).withColumn("side", F.lit(labels[0]))
    high = top_k(df, keys, [F.desc_nulls_last(by[0]), *[F.asc(c) for c in by[1:]]], k).withColumn("side", F.lit(labels[1]))
    return low.unionByName(high)


def extremes(df: DataFrame, keys: Sequence[str], by: Sequence[str], name: str, labels=("driest", "wettest")) -> DataFrame:
    """Name of each group's lowest and highest row by several columns in turn, then by the name; folds on the map side."""
    order = F.struct(*by, name)
    return df.groupBy(*keys).agg(F.min_by(name, order).alias(labels[0]), F.max_by(name, order).alias(labels[1]))


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of a fixed order; every task keeps n."""
    return df.orderBy(*order).limit(n)


def extremes_of_largest(df: DataFrame, keys: Sequence[str], size: str, by: str, tie: str, k: int = 8) -> DataFrame:
    """Among each group's k largest rows, the lowest and the highest by another column."""
    large = top_k(df, keys, [F.desc(size), F.asc(tie)], k, "_k")
    return large.groupBy(*keys).agg(
        F.min_by(tie, F.struct(by, tie)).alias("driest"), F.min(by).alias("driest_value"),
        F.when(F.count(F.lit(1)) >= 2, F.max_by(tie, F.struct(by, tie))).alias("wettest"),
        F.when(F.count(F.lit(1)) >= 2, F.max(by)).alias("wettest_value"))


def with_cumulative_share(df: DataFrame, keys: Sequence[str], size: str, tie: str, k: int = 10) -> DataFrame:
    """The k largest rows of each group with their running share of the whole group."""
    totals = df.groupBy(*keys).agg(F.sum(size).alias("_total"))
    top = top_k(df, keys, [F.desc(size), F.asc(tie)], k).join(totals, list(keys))
    w = W.partitionBy(*keys).orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    share = F.col(size) / F.nullif("_total", F.lit(0.0)) * 100
    return top.withColumn("share_pct", share).withColumn("cumulative_share_pct", F.sum(share).over(w)).drop("_total")


def good_middle_bad(df: DataFrame, score: str, tie: str, k: int = 8, keys: Sequence[str] = ()) -> DataFrame:
    """Best k (score >= 7), k nearest to the middle (4-7) and worst k (< 4)."""
    s = F.col(score)
    groups = (("good", s >= 7, s.desc()), ("average", (s >= 4) & (s < 7), F.abs(s - 5).asc()), ("bad", s < 4, s.asc()))
    parts = []
    for name, cond, order in groups:
        part = df.where(cond)
        if keys:
            part = top_k(part, keys, [order, F.asc(tie)], k).drop("rank")
        else:
            part = part.orderBy(order, F.asc(tie)).limit(k)
        parts.append(part.withColumn("outlook", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def business_order(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Position of each value in a fixed order, unlisted values last."""
    entries = [F.lit(x) for i, v in enumerate(order) for x in (v, i)]
    return df.withColumn("sort_order", F.coalesce(F.try_element_at(F.create_map(*entries), F.col(column)), F.lit(len(order))))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows, chosen by an MD5 of key and seed and so the same in every run and engine."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return df.orderBy(digest, F.col(key)).limit(n)
