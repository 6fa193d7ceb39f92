"""Exact top-k search by inner product, pruned with segment means and deviations from coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from furrow.llm.common import kept, query, table

LEVELS = (4, 16)  # segments, coarse to fine
QUERY_BLOCK, ROW_BLOCK = 4096, 4096
SEEDS = 2048
_EXACT = float(1 << 53)

BLOCK = "block bigint, dim int, n int, ids binary, uids binary, vectors binary"


def quantised(vec: Column, scale: float = 256.0) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _pack(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Rows to blocks of at most ``size`` rows of one dimension."""
    held: dict[int, list] = {}

    def block(dim: int, rows: list) -> pd.DataFrame:
        ids, uids, vectors = zip(*rows, strict=True)
        return pd.DataFrame([{
            "block": uids[0], "dim": dim, "n": len(rows), "ids": np.array(ids, dtype="<i8").tobytes(), "uids": np.array(uids, dtype="<i8").tobytes(),
            "vectors": np.array(vectors, dtype="<i8").reshape(len(rows), dim).tobytes()}])

    for pdf in batches:
        for row in zip(pdf["id"], pdf["uid"], pdf["q"], strict=True):
            own = held.setdefault(len(row[2]), [])
            own.append(row)
            if len(own) == size:
                yield block(len(row[2]), own)
                own.clear()
    for dim, rows in held.items():
        if rows:
            yield block(dim, rows)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    return rows.mapInPandas(lambda batches: _pack(batches, size), BLOCK)


def _matrix(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, dtype="<i8").reshape(-1, dim) if dim else np.zeros((0, 0), dtype="<i8")


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each vector's segments, both times the root of the segment's length.

    For segments of m numbers, |a - b|^2 is at least the sum of m (mean_a - mean_b)^2 + m (dev_a - dev_b)^2, so the inner
    product is at most the inner product of these statistics.
    """
    edges = np.linspace(0, vectors.shape[1], min(segments, max(1, vectors.shape[1])) + 1).astype(int)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = vectors[:, a:b].astype(np.float64)
        out += [part.mean(axis=1) * np.sqrt(b - a), part.std(axis=1) * np.sqrt(b - a)] if b > a else []
    return np.stack(out, axis=1) if out else np.zeros((len(vectors), 1))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where no sum can lose a bit."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if top < _EXACT else a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of each row among (row, column) entries: highest score, then smallest id."""
    order = np.lexsort((ids[columns], -scores, rows))
    place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order], side="left")
    return order[place < k]


def search(queries: np.ndarray, query_uids: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int,
           levels=LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, row number, score) of each query's ``k`` best of ``rows`` that may reach ``floor``."""
    alive = query_uids[:, None] != uids[None, :]
    for segments in levels:
        if segments >= rows.shape[1]:
            break
        # only rows that some query still wants go to the finer level
        columns = np.flatnonzero(alive.any(axis=0))
        a, b = segment_statistics(queries, segments), segment_statistics(rows[columns], segments)
        bound = a @ b.T
        slack = 1e-9 * (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :] + 1)
        alive[:, columns] &= bound + slack >= floor[:, None]
    columns = np.flatnonzero(alive.any(axis=0))
    if not len(columns):
        return (np.empty(0, dtype=np.int64),) * 3
    scores = inner_products(queries, rows[columns])
    hidden = np.where(alive[:, columns], scores, np.iinfo(np.int64).min)
    if len(columns) > k:
        least = -np.partition(-hidden.astype(np.float64), k - 1, axis=1)[:, k - 1]
        want = alive[:, columns] & (scores.astype(np.float64) >= np.maximum(least, floor)[:, None])
    else:
        want = alive[:, columns]
    q, c = np.nonzero(want)
    s, c = scores[q, c], columns[c]
    keep = _best(s, ids, q, c, k)
    return q[keep], c[keep], s[keep]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0,
          query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's ``k`` highest inner products over all other rows.

    Vectors become floor(scale * x); null ones and those with null or non-finite components take no part, and vectors
    meet those of their own length only. Ties go to the smaller id; repeated rows are rows of their own, and a query
    leaves out itself alone. The stated queries meet all rows in blocks: every pair of a block of queries and one of rows
    is one unit of work of bounded size. A floor for each query, its k-th best among a few seed rows, lets the segment
    bounds discard rows before their products are computed; the floor only saves work and never decides a result.
    """
    spark = vectors.sparkSession
    v = F.col(vec_col)
    valid = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = kept(
        vectors.where(valid & F.col(id_col).isNotNull()).select(
            F.col(id_col).alias("id"), quantised(v, scale).alias("q"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
            F.monotonically_increasing_id().alias("uid")), "vectors")
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in rows.orderBy(F.xxhash64("uid"), "uid").select("q", "uid").limit(SEEDS).collect():
        seeds.setdefault(len(r["q"]), []).append((r["q"], r["uid"]))
    sent = spark.sparkContext.broadcast(seeds)  # at most SEEDS vectors

    def with_floor(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            floors = []
            for b in pdf.itertuples():
                own = sent.value.get(b.dim, [])
                a, uids = _matrix(b.vectors, b.dim), np.frombuffer(b.uids, dtype="<i8")
                floor = np.full(b.n, -np.inf)
                if b.dim and len(own) > k:
                    s = inner_products(a, np.array([x for x, _ in own], dtype=np.int64)).astype(np.float64)
                    s[uids[:, None] == np.array([u for _, u in own])[None, :]] = -np.inf
                    floor = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                floors.append(floor.tobytes())
            yield pdf.assign(floor=floors)

    row_blocks = kept(blocks(rows.select("id", "q", "uid"), row_block), "row-blocks")
    query_rows = rows.where("is_query").select("id", "q", "uid").coalesce(max(1, rows.where("is_query").count() // query_block))
    query_blocks = blocks(query_rows, query_block).mapInPandas(with_floor, BLOCK + ", floor binary")
    questions = query_blocks.select(*[F.col(c).alias(f"q_{c}") for c in query_blocks.columns])
    numbers = row_blocks.select(F.col("block").alias("_block"), F.col("dim").alias("_dim"))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b in pdf.itertuples():
                if not b.dim:
                    continue
                ids, q_ids, q_uids = (np.frombuffer(x, dtype="<i8") for x in (b.ids, b.q_ids, b.q_uids))
                q, c, s = search(_matrix(b.q_vectors, b.dim), q_uids, np.frombuffer(b.q_floor), _matrix(b.vectors, b.dim), ids, np.frombuffer(b.uids, dtype="<i8"), k)
                yield pd.DataFrame({"query_id": q_ids[q], "query_uid": q_uids[q], "vec_id": ids[c], "score": s})

    # each block of rows is told which blocks of queries it meets; both sides travel by the row block's number
    meetings = numbers.join(questions, F.col("_dim") == F.col("q_dim"))
    paired = meetings.join(row_blocks, F.col("_block") == F.col("block")).drop("_block", "_dim")
    found = paired.mapInPandas(answer, "query_id bigint, query_uid bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op4_segment_top_k", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
