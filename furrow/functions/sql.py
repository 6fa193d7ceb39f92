"""SQL functions for interactive users; Catalyst inlines their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

from furrow import params as P


def register(spark: SparkSession) -> list[str]:
    """Define the temporary SQL functions of this library and return their names."""
    confidence = " ".join(f"WHEN {k} THEN {v}D" for k, v in P.QUALITY_CONFIDENCE.items())
    bodies = {
        "decile_rank(below BIGINT, n BIGINT) RETURNS INT":
            "CASE WHEN n > 0 AND below IS NOT NULL THEN CAST(greatest(1, least(10, ceil((below + 1) / n * 10))) AS INT) END",
        "decile_score(below BIGINT, n BIGINT) RETURNS DOUBLE":
            "CASE WHEN n > 0 AND below IS NOT NULL THEN bround(greatest(1D, least(10D, (below + 1) / n * 10D)), 1) END",
        "quality_confidence(code INT) RETURNS DOUBLE":
            f"CASE code {confidence} ELSE {P.QUALITY_CONFIDENCE_DEFAULT}D END",
        "break_status(d DATE) RETURNS STRING":
            "CASE WHEN d < make_date(year(d), 5, 15) THEN 'early' "
            "WHEN d <= make_date(year(d), 6, 15) THEN 'on_time' WHEN d IS NOT NULL THEN 'late' END",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in bodies]
