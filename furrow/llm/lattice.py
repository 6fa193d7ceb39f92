"""Near duplicates of embeddings: random projections decoded to E8 lattice points, neighbouring cells probed, cosines verified."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import kept, mix64, partitions, query, table
from furrow.llm.jaccard import components

COSINE = 0.98
TABLES = 5
BLOCKS = 2  # lattice points of a cell: 16 projected numbers
NEIGHBOURS = 4  # probed on either side of a block's own point
SCALE, BALL_SCALE = 2.5, 5.0  # projected length of a unit vector
BALL_ROUNDS = 3
TILE = 1024
UNIT_BYTES = 1 << 22  # vectors compared in one task at a time
_GRID, _PROJECTION_GRID = float(1 << 20), float(1 << 16)
_MARGIN = 1e-6  # radians, far above the rounding of an angle

#: the 240 shortest vectors of the lattice
_SHORTEST = np.array(
    [[a if k == i else b if k == j else 0.0 for k in range(8)] for i, j in itertools.combinations(range(8), 2) for a in (1.0, -1.0) for b in (1.0, -1.0)]
    + [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0])


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points whose coordinates have an even sum."""
    near = np.rint(x)
    off = x - near
    row, worst = np.arange(len(x)), np.abs(off).argmax(axis=1)
    odd = near.sum(axis=1) % 2 != 0
    near[row[odd], worst[odd]] += np.where(off[row[odd], worst[odd]] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points: integers or halves of even sum, whichever is nearer."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


def _projection(dim: int, number: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([dim, number, int(scale * 1000)])
    p = rng.normal(size=(dim, 8 * BLOCKS)) * scale / math.sqrt(8.0)
    return np.rint(p * _PROJECTION_GRID), rng.uniform(0, 1, 8 * BLOCKS)


def _names(points: np.ndarray, number: int) -> np.ndarray:
    """64-bit names of lattice points (halves allowed), one row each."""
    out = np.full(len(points), number + 1, dtype=np.uint64)
    for column in (2 * points).astype(np.int64).T:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return out


def cells(vectors: np.ndarray, number: int, scale: float = SCALE, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Names of each unit vector's own cell (first column) and of its neighbouring cells in one table.

    A neighbour changes one block's lattice point by the short lattice vector nearest to what decoding left over.
    Numbers are rounded to a grid on which the projection is exact, so a vector has the same cells wherever it is computed.
    """
    p, shift = _projection(vectors.shape[1], number, scale)
    x = (np.rint(vectors * _GRID) @ p) / (_GRID * _PROJECTION_GRID) + shift
    parts = [x[:, 8 * b : 8 * b + 8] for b in range(BLOCKS)]
    points = [nearest_e8(part) for part in parts]
    names = [_names(np.concatenate(points, axis=1), number)]
    for b in range(BLOCKS if neighbours else 0):
        gain = (parts[b] - points[b]) @ _SHORTEST.T
        best = np.argsort(-gain, axis=1, kind="stable")[:, :neighbours]
        for k in range(neighbours):
            moved = [*points[:b], points[b] + _SHORTEST[best[:, k]], *points[b + 1 :]]
            names.append(_names(np.concatenate(moved, axis=1), number))
    return np.stack(names, axis=1)


def all_cells(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (one a table) and neighbouring cells of unit vectors."""
    made = [cells(vectors, t) for t in range(TABLES)]
    return np.stack([c[:, 0] for c in made], axis=1), np.concatenate([c[:, 1:] for c in made], axis=1)


def _matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<f8").reshape(-1, dim)


def unit_vectors(vec: Column) -> Column:
    """Bytes of the vector over its length; null for vectors that are null, empty or zero or hold null or non-finite numbers."""

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for v in s:
                x = np.array([] if v is None else v, dtype=np.float64)
                top = np.abs(x).max(initial=0.0)
                if not (0 < top < np.inf):
                    out.append(None)
                    continue
                x = x / top  # so that no square overflows or vanishes
                out.append((x / math.sqrt(float((x * x).sum())) + 0.0).astype("<f8").tobytes())
            yield pd.Series(out, dtype=object)

    return of(vec)


def _by_dim(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    for dim, own in pdf.groupby(pdf["unit"].map(len) // 8, sort=False):
        yield int(dim), own


def _balls(nodes: DataFrame, cosine: float) -> DataFrame:
    """``node, ball``: nodes of a ball are surely linked, for each is within half the angle of the ball's lead.

    In every round the leads of a fine lattice cell join the cell's least lead if they and what they hold are near enough;
    by the triangle inequality no angle within the ball passes that of ``cosine``. Groups of near copies end in few balls,
    whose links are counted and not compared.
    """
    most = math.acos(cosine) / 2 - _MARGIN
    leads = nodes.select("node", "label", "unit", F.lit(0.0).alias("radius"))
    names = nodes.select("node", F.col("node").alias("ball"))
    for number in range(BALL_ROUNDS if most > 0 else 0):
        def own_cell(batches: Iterator[pd.DataFrame], number=number) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, own in _by_dim(pdf):
                    cell = cells(_matrix(own["unit"], len(own["unit"].iloc[0]) // 8), TABLES + number, BALL_SCALE, 0)[:, 0]
                    yield pd.DataFrame({"node": own["node"], "label": own["label"], "dim": own["unit"].map(len), "cell": cell.astype(np.int64)})

        placed = kept(leads.select("node", "label", "unit").mapInPandas(own_cell, "node bigint, label string, dim int, cell bigint"), "ball-cells")
        first = placed.groupBy("label", "dim", "cell").agg(F.min("node").alias("lead"), F.max("node").alias("_last")).where("lead <> _last").drop("_last")
        pairs = placed.join(first, ["label", "dim", "cell"]).where("node <> lead").select("node", "lead")
        both = pairs.join(leads.select("node", "unit", "radius"), "node").join(
            leads.select(F.col("node").alias("lead"), F.col("unit").alias("lead_unit")), "lead")

        def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                angle = [2 * math.asin(min(1.0, float(np.linalg.norm(np.frombuffer(a, "<f8") - np.frombuffer(b, "<f8"))) / 2))
                         for a, b in zip(pdf["unit"], pdf["lead_unit"], strict=True)]
                out = pdf[["node", "lead"]].assign(reach=pdf["radius"] + np.array(angle))
                yield out[out["reach"] <= most]

        merged = kept(both.mapInPandas(near, "node bigint, lead bigint, reach double"), "ball-merged")
        grown = merged.groupBy("lead").agg(F.max("reach").alias("reach")).withColumnRenamed("lead", "node")
        leads = kept(leads.join(merged.select("node"), "node", "left_anti").join(grown, "node", "left")
                     .select("node", "label", "unit", F.greatest("radius", F.coalesce("reach", F.lit(0.0))).alias("radius")), "ball-leads")
        moved = merged.select(F.col("node").alias("ball"), F.col("lead"))
        names = kept(names.join(moved, "ball", "left").select("node", F.coalesce("lead", "ball").alias("ball")), "ball-names")
    return names


def _meetings(nodes: DataFrame) -> DataFrame:
    """``label, dim, cell, i, j, right, node, ball``: rows of the pairs of tiles to be compared.

    A cell's rows are cut into tiles by hash, so no task numbers or holds a crowded cell. A ball that fills tiles of its own is
    never compared with itself.
    """
    spark = nodes.sparkSession

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, own in _by_dim(pdf):
                home, probe = all_cells(_matrix(own["unit"], dim))
                n, k = home.shape[1], probe.shape[1]
                yield pd.DataFrame({
                    "label": np.tile(own["label"].to_numpy(), n + k), "dim": dim, "cell": np.concatenate((home.T.ravel(), probe.T.ravel())).astype(np.int64),
                    "home": np.repeat([True, False], [n * len(own), k * len(own)]), "node": np.tile(own["node"].to_numpy(), n + k),
                    "ball": np.tile(own["ball"].to_numpy(), n + k)})

    key = ["label", "dim", "cell"]
    placed = nodes.select("label", "unit", "node", "ball").mapInPandas(
        keys, "label string, dim int, cell bigint, home boolean, node bigint, ball bigint").repartition(partitions(spark), *key)
    held = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), F.min("ball").alias("_low"), F.max("ball").alias("_high"), F.max("home").alias("_home"))
    # cells of one ball, or without a row of their own, hold nothing to compare
    rows = kept(placed.join(held.where("_home and _low <> _high"), key).select(*key, "home", "node", "ball"), "cell-rows")
    counts = rows.groupBy(*key, "ball").agg(F.count(F.lit(1)).alias("_n"))
    sized = counts.withColumn("own", F.when(F.col("_n") > TILE, F.col("ball")))  # null: shares tiles with other balls
    tiles_of = kept(sized.groupBy(*key, "own").agg(F.ceil(F.sum("_n") / TILE).cast("int").alias("tiles")), "cell-tiles")
    crowded = sized.where(F.col("own").isNotNull()).select(*key, "ball", "own")
    named = rows.join(crowded, [*key, "ball"], "left")
    same = F.col("own").eqNullSafe(F.col("_own"))
    sizes = tiles_of.select(*key, F.col("own").alias("_own"), "tiles")
    tile = F.struct(F.coalesce(F.col("own"), F.lit(-1)).alias("own"), F.col("own").isNull().alias("mixed"),
                    F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int").alias("k"))
    joined = named.alias("r").join(sizes.alias("s"), [F.col(f"r.{c}") == F.col(f"s.{c}") for c in key] + [same])
    tiled = joined.select(*[F.col(f"r.{c}") for c in key], "home", "node", "ball", tile.alias("tile"))
    every = tiles_of.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        *key, F.struct(F.coalesce(F.col("own"), F.lit(-1)).alias("own"), F.col("own").isNull().alias("mixed"), F.col("k").alias("k")).alias("tile"))
    left, right = every.withColumnRenamed("tile", "i"), every.withColumnRenamed("tile", "j")
    meets = left.join(right, key).where((F.col("i") <= F.col("j")) & (F.col("i.mixed") | (F.col("i.own") != F.col("j.own"))))
    sides = meets.select(*key, "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("tile"))
    met = tiled.join(sides, [*key, "tile"])
    return met.select(*key, "node", "ball", F.xxhash64("i").alias("i"), F.xxhash64("j").alias("j"), (F.col("tile") != F.col("i")).alias("right"))


def links(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows of one label (not null) and one length of vector link where their cosine, in double precision, is at least
    ``cosine`` and some table brings them together: the chance is 97 % or more for a pair at 0.98 and grows with the
    cosine. No link is below it. Vectors that are null, empty or zero, or hold null or non-finite numbers, and rows without a
    label link with nothing. Equal vectors are one node with a count; repeated ids are rows of their own, of which all or
    none are kept. Null ids count as larger than all others. An empty table gives no rows; other columns play no part.

    1. Nodes near a lead form balls whose members are surely linked; a ball's links are counted by arithmetic.
    2. Each node's cells and neighbouring cells in ``TABLES`` tables are grouped; tiles of a cell meet in pairs, and a pair
       is counted in the first cell that both share, so that links need never be listed. Tiles hand on counts and the few
       links that join balls.
    """
    rows = kept(vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).cast("string").alias("label"), unit_vectors(F.col(vec_col)).alias("unit"),
        F.monotonically_increasing_id().alias("uid")), "unit-vectors")
    keyed = rows.where("unit is not null and label is not null").withColumn("key", F.md5("unit"))
    groups = keyed.groupBy("label", "key").agg(
        F.count(F.lit(1)).alias("m"), F.min("uid").alias("first"), F.min("vec_id").alias("rep"))
    named = groups.withColumn("node", F.xxhash64("first"))
    nodes = kept(named.join(rows.select(F.col("uid").alias("first"), "unit"), "first").drop("first"), "vector-nodes")
    balls = _balls(nodes, cosine)
    full = kept(nodes.join(balls, "node"), "balls")
    met = kept(_meetings(full), "meetings")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        """Counts per node (``n`` above 0) and links that join balls (``n`` is 0), of many pairs of tiles of one length of vector."""
        meeting = pdf.groupby(["label", "cell", "i", "j"], sort=False).ngroup().to_numpy()
        order = np.lexsort((pdf["right"].to_numpy(), meeting))
        pdf, meeting = pdf.iloc[order], meeting[order]
        x = _matrix(pdf["unit"], len(pdf["unit"].iloc[0]) // 8)
        node, ball, m, cell, right = (pdf[c].to_numpy() for c in ("node", "ball", "m", "cell", "right"))
        cuts = [0, *(np.flatnonzero(meeting[1:] != meeting[:-1]) + 1).tolist(), len(pdf)]
        hits = [np.empty((2, 0), dtype=np.int64)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            middle = lo + int(np.searchsorted(right[lo:hi], True))
            one = slice(lo, middle), slice(middle, hi) if middle < hi else slice(lo, middle)
            p, q = np.nonzero(x[one[0]] @ x[one[1]].T >= cosine - 1e-9)
            p, q = p + one[0].start, q + one[1].start
            keep = (ball[p] != ball[q]) & (p < q)
            hits.append(np.stack((p[keep], q[keep])))
        a, b = np.concatenate(hits, axis=1)
        first = np.zeros(len(a), dtype=bool)
        ids, place = np.unique(node, return_inverse=True)
        # cells once for each node with a hit
        used, at = np.unique(place[np.concatenate((a, b))], return_inverse=True)
        row_of = np.zeros(len(ids), dtype=np.int64)
        row_of[place] = np.arange(len(place))
        own, near_by = all_cells(x[row_of[used]]) if len(used) else (np.empty((0, 1), np.uint64),) * 2
        for lo in range(0, len(a), 4096):
            p, q = a[lo : lo + 4096], b[lo : lo + 4096]
            similar = (x[p] * x[q]).sum(axis=1) >= cosine
            pt, qt = at[lo : lo + len(p)], at[len(a) + lo : len(a) + lo + len(p)]
            least = np.full(len(p), np.iinfo(np.uint64).max, dtype=np.uint64)
            for mine, theirs in ((own[pt], own[qt]), (own[pt], near_by[qt]), (near_by[pt], own[qt])):
                for k in range(mine.shape[1]):
                    shared = (theirs == mine[:, k : k + 1]).any(axis=1)
                    least = np.where(shared, np.minimum(least, mine[:, k]), least)
            first[lo : lo + 4096] = similar & (least.astype(np.int64) == cell[p])
        a, b = a[first], b[first]
        total = np.zeros(len(ids), dtype=np.int64)
        np.add.at(total, place[a], m[b])
        np.add.at(total, place[b], m[a])
        some = np.flatnonzero(total)
        joined = np.unique(np.stack((np.minimum(ball[a], ball[b]), np.maximum(ball[a], ball[b])), axis=1), axis=0)
        parent: dict[int, int] = {}

        def top(v: int) -> int:
            while parent.get(v, v) != v:
                parent[v] = parent.get(parent[v], parent[v])
                v = parent[v]
            return v

        out = []
        for v, w in joined.tolist():
            s, t = top(v), top(w)
            if s != t:
                parent[s] = t
                out.append((v, w, 0))
        out += zip(ids[some].tolist(), ids[some].tolist(), total[some].tolist(), strict=True)
        return pd.DataFrame(out, columns=["node", "other", "n"])

    units = 1 + int(met.agg(F.sum(F.col("dim") * 8)).first()[0] or 0) // UNIT_BYTES
    unit = F.pmod(F.xxhash64("label", "cell", "i", "j"), F.lit(units)).alias("task")
    work = met.join(full.select("node", "m", "unit"), "node").select(unit, "*")
    found = kept(work.groupBy("task", "dim").applyInPandas(compare, "node bigint, other bigint, n bigint"), "vector-links")
    counted = found.where("n > 0").groupBy("node").agg(F.sum("n").alias("_across"))
    names = components(found.where("n = 0").select(F.col("node").alias("a"), F.col("other").alias("b"))).toDF("ball", "_label")
    inside = full.groupBy("ball").agg(F.sum("m").alias("_inside"), F.min("rep").alias("rep"))
    reach = inside.join(names, "ball", "left").withColumn("_label", F.coalesce("_label", "ball"))
    least = reach.groupBy("_label").agg(F.min("rep").alias("component_id"))
    placed = reach.join(least, "_label").select("ball", "_inside", "component_id")
    per_node = full.select("node", "ball", "label", "key").join(placed, "ball").join(counted, "node", "left").select(
        F.col("label").alias("_l"), F.col("key").alias("_k"), (F.col("_inside") - 1 + F.coalesce("_across", F.lit(0))).alias("n_links"), "component_id")
    out = rows.withColumn("key", F.md5("unit")).join(per_node, (F.col("label") == F.col("_l")) & (F.col("key") == F.col("_k")), "left")
    component = F.when(F.col("_k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, label, x FROM v WHERE list_inner_product(x, x) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.b, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(c.b, e.vec_id)) = e.vec_id AS kept
FROM embeddings AS e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a
"""


@query("op11_lattice_near_duplicates", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "embeddings"))
