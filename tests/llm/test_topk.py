import math
import random

from pyspark.sql import functions as F

from furrow.llm import topk


def expected(rows, k=5):
    valid = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in valid:
        if i % 50 == 0 and v:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in valid if m != n and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SEEDS", 20)
    rng = random.Random(8)
    smooth = [[math.sin(a + k / 9) for k in range(32)] for a in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in smooth[i % 6]]) for i in range(400)] + [(50, smooth[0]), (50, smooth[0]), (777, smooth[0]), (778, smooth[0])]
    rows += [(1000, None), (1050, [None] * 32), (1100, [float("nan")] * 32), (1150, [float("inf")] * 32), (1200, []), (1250, [0.5, 0.25]), (1251, [0.25, 1.0]), (None, smooth[1])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id bigint, embedding array<double>, score int, rank int")
    out = topk.top_k(df, F.col("vec_id") % 50 == 0, query_block=3, row_block=64)
    assert sorted(map(tuple, out.collect())) == expected(rows)


def test_no_rows_and_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).collect() == [] and topk.top_k(df.where("false"), F.lit(True)).collect() == []


def test_large_components_stay_exact():
    import numpy as np

    a = np.array([[1 << 30, 3], [-(1 << 30), 5]], dtype=np.int64)
    assert topk.inner_products(a, a).tolist() == [[(1 << 60) + 9, -(1 << 60) + 15], [-(1 << 60) + 15, (1 << 60) + 25]]
