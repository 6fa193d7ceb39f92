"""Named queries over the warehouse tables, each with an equivalent SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.workload import bind as B

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6
NUDGE = 1e-9  # moves exact halves off the rounding edge, where engines differ


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = (), rounded: tuple[str, ...] = (),
          extra: tuple[tuple[str, str], ...] = ()):
    """Register a query; ``rounded`` columns are rounded alike in Spark and in the SQL."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            for c in rounded:
                df = df.withColumn(c, F.round(F.col(c).cast("double") + NUDGE, DIGITS) + F.lit(0.0))
            return df

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__module_of__ = fn.__module__
        QUERIES[name] = run
        if sql is not None:
            body = sql
            if rounded:
                cols = ", ".join(f"round(CAST({c} AS DOUBLE) + CAST({NUDGE} AS DOUBLE), {DIGITS}) + 0 AS {c}" for c in rounded)
                body = f"SELECT * REPLACE ({cols}) FROM ({sql}) AS q"
            ORACLES[name] = B.sql(body, *uses, extra=extra)
        return fn

    return wrap
