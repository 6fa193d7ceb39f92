"""Near duplicates by word shingles: a Jaccard join through an R-tree over count vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.llm.common import forget, kept, mix64, partitions, query, release, table, window_hashes, word_hashes

WORDS, PERCENT = 5, 75
COARSE = 32  # groups of an R-tree's points
FINEST = 8192
LEAF, FANOUT = 32, 8
TILE = 1024
SMALL = 512  # nodes of a block; the sets of larger ones travel
ROW_BYTES, UNIT_BYTES = 400, 1 << 24  # of a row of a block, and of the blocks one task holds at a time
TILE_BYTES = 1 << 24  # of shingle sets
SIZE_STEP = 1.05  # sizes of one class of a large block differ by less, or by as much as links allow if that is more
BROADCAST_ROWS = 500_000  # of an id and a hash each
SAMPLE_DOCUMENTS, SAMPLE_ONE_OF, SAMPLE_HITS, MOST_COMMON = 16_384, 16, 5, 1 << 19


def shingle_sets(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; texts of fewer words have one, texts without words none."""
    words, first = word_hashes(texts)
    windows = window_hashes(words, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(windows[a : b - n + 1]))
        elif b > a:
            out.append(window_hashes(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _sets_of(texts, characters: int = 1_000_000) -> Iterator[np.ndarray]:
    """Sets of many texts (null as empty), a bounded number of characters at a time beside single long texts."""
    held, size = [], 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1])
        if size > characters:
            yield from shingle_sets(held)
            held, size = [], 0
    yield from shingle_sets(held)


def digest(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a shingle set, the same for equal sets."""
    mixed = mix64(shingles)
    both = np.array([mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed, initial=np.uint64(0)), np.uint64(len(mixed))], dtype=np.uint64)
    return int(window_hashes(both, 3)[0].astype(np.int64))


def groups_for(n: int) -> int:
    """Groups of a set's count vector: a power of two, one for about four shingles."""
    return min(FINEST, max(COARSE, 1 << max(0, math.ceil(n / 4) - 1).bit_length()))


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall in each group; groups are ranges of the hash, so neighbours add up to a coarser vector."""
    g = groups_for(len(shingles))
    return np.bincount((shingles >> np.uint64(64 - g.bit_length() + 1)).astype(np.int64), minlength=g)


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    return vector.reshape(groups, -1).sum(axis=1) if len(vector) > groups else vector


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Two linked sets share one of the first so many shingles of either, in any order common to all sets."""
    return n - -(-percent * n // 100) + 1


def may_link(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the sum of the smaller counts, at the finest groups both have, allows the similarity."""
    g = min(len(a), len(b))
    a, b = folded(a, g), folded(b, g)
    return (100 + percent) * int(np.minimum(a, b).sum()) >= percent * (int(a.sum()) + int(b.sum()))


class CountTree:
    """An R-tree over count vectors, bulk-loaded: points sorted by size and leading counts, boxes of their extremes."""

    def __init__(self, points: np.ndarray):
        self.points = points
        tile = np.lexsort(tuple(points[:, k] for k in range(min(3, points.shape[1]))) + (points.sum(axis=1) // 8,))
        self.order = tile
        self.levels = []
        low = high = points[tile]
        size = LEAF
        while True:
            cuts = np.arange(0, len(low), size)
            low, high = np.minimum.reduceat(low, cuts, axis=0), np.maximum.reduceat(high, cuts, axis=0)
            n = points.sum(axis=1)[tile] if not self.levels else None
            if n is not None:
                least, most = np.minimum.reduceat(n, cuts), np.maximum.reduceat(n, cuts)
            else:
                least, most = np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((high, least, most, size))
            if len(cuts) == 1:
                break
            size = FANOUT

    def candidates(self, queries: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs whose sizes and summed smaller counts allow the similarity."""
        sizes = queries.sum(axis=1)
        q, box = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most, _ = self.levels[depth]
            keep = (100 * most[box] >= percent * sizes[q]) & (100 * sizes[q] >= percent * least[box])
            q, box = q[keep], box[keep]
            shared = np.minimum(queries[q], high[box]).sum(axis=1)
            keep = (100 + percent) * shared >= percent * (sizes[q] + np.maximum(least[box], -(-percent * sizes[q] // 100)))
            q, box = q[keep], box[keep]
            below, step = (len(self.levels[depth - 1][0]), FANOUT) if depth else (len(self.order), LEAF)
            child = box[:, None] * step + np.arange(step)[None, :]
            q = np.repeat(q, step)[child.ravel() < below]
            box = child.ravel()[child.ravel() < below]
        point = self.order[box]
        n = self.points.sum(axis=1)
        keep = (100 + percent) * np.minimum(queries[q], self.points[point]).sum(axis=1) >= percent * (sizes[q] + n[point])
        return q[keep], point[keep]


def _common_shingles(docs: DataFrame, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many documents and how often a sample holds them; they come last in every prefix, the commonest at its end.

    The sample is one document of ``SAMPLE_ONE_OF``, or about ``SAMPLE_DOCUMENTS`` where that is more. As it grows with the
    table, the passages that it misses are in no more documents of a large table than of a small one. Any list gives the same
    links: it only keeps passages that many texts share from making large blocks.
    """
    every = min(SAMPLE_ONE_OF, max(1, math.ceil(docs.count() / SAMPLE_DOCUMENTS)))
    sample = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(every)) == 0).select(F.col(text_col).alias("text")).dropna()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = list(_sets_of(pdf["text"]))
            values, n = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
            yield pd.DataFrame({"shingle": values.astype(np.int64), "n": n})
            del pdf, sets, values, n
            release()

    met = kept(sample.mapInPandas(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= SAMPLE_HITS), "met")
    often = met.orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).toPandas()
    forget(met)
    known = often["shingle"].to_numpy(dtype=np.int64).astype(np.uint64)
    order = np.argsort(known)
    return known[order], often["n"].to_numpy(dtype=np.int64)[order]


def profile(text: Column, common: tuple[np.ndarray, np.ndarray], spark: SparkSession, percent: int = PERCENT) -> Column:
    """(n, node, groups, prefix) of a text's shingle set."""
    sent = spark.sparkContext.broadcast(common)  # at most MOST_COMMON hashes and counts

    @F.pandas_udf("struct<n:bigint,node:bigint,groups:binary,prefix:array<bigint>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, often = sent.value
        for texts in batches:
            out = []
            for s in _sets_of(texts):
                if not len(s):
                    out.append((0, 0, b"", []))  # no nulls, which would turn the column's 64-bit names into floats
                    continue
                p, order = prefix_size(len(s), percent), s
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    frequent = known[at] == s
                    order = np.concatenate((s[~frequent], s[frequent][np.argsort(often[at[frequent]], kind="stable")]))
                out.append((len(s), digest(s), _blob(count_vector(s)), order[:p].astype(np.int64)))
            yield pd.DataFrame(out, columns=["n", "node", "groups", "prefix"])
            del out, texts
            release()

    return of(text)


def _blob(vector: np.ndarray) -> bytes:
    """A count vector in as few bytes a count as its largest needs; the first byte says how many."""
    size = next(w for w in (1, 2, 4, 8) if int(vector.max(initial=0)) < 1 << (8 * w))
    return bytes([size]) + vector.astype(f"<u{size}").tobytes()


def _vector(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<u{blob[0]}", offset=1).astype(np.int64)


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that their count vectors allow."""
    sizes = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}")) for x in "ab"]
    vectors = [nodes.select(F.col("node").alias(x), F.col("groups").alias(f"g{x}")) for x in "ab"]
    sized = pairs.join(sizes[0], "a").join(sizes[1], "b").where(
        (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))).select("a", "b")
    sized = kept(sized, "sized")
    near = sized.join(vectors[0], "a").join(vectors[1], "b")

    def allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [may_link(_vector(x), _vector(y), percent) for x, y in zip(pdf["ga"], pdf["gb"], strict=True)]
            yield pdf.loc[keep, ["a", "b"]]
            del pdf
            release()

    out = kept(near.mapInPandas(allowed, "a bigint, b bigint"), "candidates")
    forget(sized)
    return out


def _shingles(concerned: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles`` of the nodes concerned, made anew of one document each."""
    ids = kept(nodes.join(concerned, "node").select(F.col("rep").alias("_id"), "node"), "concerned")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = [(node, s.astype(np.int64)) for s, node in zip(_sets_of(pdf["text"]), pdf["node"], strict=True) if len(s) and digest(s) == node]
            yield pd.DataFrame(own, columns=["node", "shingles"])
            del pdf, own
            release()

    few = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(few, F.col("id").eqNullSafe(F.col("_id")))
    out = kept(texts.select("node", "text").mapInPandas(sets, "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "shingles")
    forget(ids)
    return out


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Pairs (a, b) whose shingle sets are similar enough, by exact comparison; sets are made of the documents concerned only.

    The sets are compared in the JVM row by row, so no batch of pairs of long sets is ever held.
    """
    known = _shingles(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"), nodes, docs, id_col, text_col)
    both = pairs.join(known.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        known.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    shared, all_ = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
    out = kept(both.where((100 + percent) * shared.cast("long") >= percent * all_.cast("long")).select("a", "b"), "verified")
    forget(known)
    return out


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of all nodes with a link; one label for each connected component.

    Every round points each node to the least of itself and its neighbours, and links join what nodes point to. Names are
    hashes, so a round is expected to remove a constant share of the nodes whatever the shape of the component.
    """
    edges = kept(links.select("a", "b").where("a <> b").distinct(), "links")
    names = None
    while edges.head(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "least")
        if names is None:
            names = kept(least.select(F.col("a").alias("node"), F.col("to").alias("label")), "names")
        else:
            old, names = names, kept(names.join(least, F.col("label") == F.col("a"), "left").select("node", F.coalesce("to", "label").alias("label")), "names")
            forget(old)
        ends = edges.join(least, "a").select(F.col("to").alias("_a"), "b").join(least.withColumnRenamed("a", "b"), "b").select(
            F.least("_a", "to").alias("a"), F.greatest("_a", "to").alias("b"))
        old, edges = edges, kept(ends.where("a <> b").distinct(), "links")
        forget(old, least)
    return names if names is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _open_blocks(rows: DataFrame, nodes: DataFrame, names: DataFrame) -> DataFrame:
    """``sig, node, label, n, size`` of blocks with several components; ``size`` counts a block's nodes.

    A block of two nodes has been compared already. Blocks with the same members are taken once.
    """
    labelled = kept(rows.join(names, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("label")), "labelled")
    open_ = (labelled.groupBy("sig").agg(F.min("label").alias("_l"), F.max("label").alias("_m"), F.count(F.lit(1)).alias("size"),
                                         F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y"))
             .where("_l <> _m and size > 2").groupBy("size", "_x", "_y").agg(F.min("sig").alias("sig")).select("sig", "size"))
    out = kept(labelled.join(open_, "sig").join(nodes.select("node", "n"), "node"), "open-blocks")
    forget(labelled)
    return out


def _wanted(label: np.ndarray, points: np.ndarray, mine: np.ndarray, other: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs across components, one of ``mine`` and one of ``other``, that a tree over the count vectors leaves.

    No pair within the commonest component is wanted, so its nodes are asked for only by the others.
    """
    names, counts = np.unique(label, return_counts=True)
    main = label == names[counts.argmax()]
    out = [np.empty((2, 0), dtype=np.int64)]
    for asking, asked in ((mine & ~main, other), (other & ~main, mine)):
        x, y = np.flatnonzero(asking), np.flatnonzero(asked)
        if len(x) and len(y):
            q, p = CountTree(points[y]).candidates(points[x], percent)
            out.append(np.stack((x[q], y[p])))
    q, p = np.concatenate(out, axis=1)
    new = label[q] != label[p]
    return q[new], p[new]


def _of_like_size(blocks: DataFrame, percent: int) -> DataFrame:
    """``sig, run, node, label, n`` of those rows of small blocks that others of the block may link with, by size and component.

    A run holds the rows whose sizes follow each other closely enough for links; no two rows of different runs can link.
    """
    by_size = Window.partitionBy("sig").orderBy("n", "node")
    begins = F.coalesce((100 * F.lag("n").over(by_size) < percent * F.col("n")).cast("int"), F.lit(0))
    run = Window.partitionBy("sig", "run")
    runs = blocks.withColumn("_begins", begins).withColumn("run", F.sum("_begins").over(by_size))
    mixed = runs.withColumn("_l", F.min("label").over(run)).withColumn("_m", F.max("label").over(run)).where("_l <> _m")
    return mixed.select("sig", "run", "node", "label", "n")


def _small_blocks(blocks: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components in blocks of at most ``SMALL`` nodes, as the trees and count vectors allow."""
    like = kept(_of_like_size(blocks, percent), "like")
    # a pair belongs to the least of the blocks that both are in, so it comes out once; a node has no more blocks than prefix shingles
    places = like.groupBy("node").agg(F.collect_list("sig").alias("sigs"))
    work = like.join(nodes.select("node", "groups"), "node").join(places, "node").withColumn("sigs", F.expr("filter(sigs, x -> x < sig)"))
    # a count vector takes about half a byte a shingle, and a row some more
    volume = like.agg(F.sum(F.least(F.lit(FINEST), F.col("n") / 2) + ROW_BYTES)).first()[0] or 0
    units = 1 + int(volume) // UNIT_BYTES

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        blobs = dict(zip(pdf["node"].tolist(), pdf["groups"], strict=True))
        found = [np.empty((0, 2), dtype=np.int64)]
        for _, own in pdf.groupby(["sig", "run"], sort=False):
            node, label = own["node"].to_numpy(), own["label"].to_numpy()
            before = dict(zip(node.tolist(), (frozenset(s.tolist()) for s in own["sigs"]), strict=True))
            everywhere = np.ones(len(node), dtype=bool)
            points = np.stack([folded(_vector(g), COARSE) for g in own["groups"]])
            q, p = _wanted(label, points, everywhere, everywhere, percent)
            both = np.unique(np.stack((np.minimum(node[q], node[p]), np.maximum(node[q], node[p])), axis=1), axis=0)
            first = [before[x].isdisjoint(before[y]) for x, y in both.tolist()]
            found.append(both[np.array(first, dtype=bool)])
        some = np.concatenate(found)
        keep = [may_link(_vector(blobs[x]), _vector(blobs[y]), percent) for x, y in some.tolist()]
        return pd.DataFrame(some[np.array(keep, dtype=bool)], columns=["a", "b"])

    unit = F.pmod(F.xxhash64("sig"), F.lit(units)).alias("unit")
    out = kept(work.select(unit, "sig", "run", "node", "label", "groups", "sigs").groupBy("unit").applyInPandas(pairs, "a bigint, b bigint"), "candidates")
    forget(like)
    return out


def shared_shingles(a: list[np.ndarray], b: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """How many shingles each of ``a`` shares with each of ``b``, by products of occurrence tables of ``step`` shingles."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    values = [np.concatenate(s) if s else np.empty(0, np.uint64) for s in (a, b)]
    both = np.intersect1d(*values)
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b)]
    place = [np.searchsorted(both, v) for v in values]
    hit = [np.flatnonzero((p < len(both)) & (both[np.minimum(p, len(both) - 1)] == v)) if len(both) else np.empty(0, np.int64) for p, v in zip(place, values, strict=True)]
    for start in range(0, len(both), step):
        tables = []
        for s, r, p, h in zip((a, b), rows, place, hit, strict=True):
            here = h[(p[h] >= start) & (p[h] < start + step)]
            t = np.zeros((len(s), min(step, len(both) - start)), dtype=np.float32)
            t[r[here], p[here] - start] = 1
            tables.append(t)
        out += tables[0] @ tables[1].T
    return out.astype(np.int64)


def _meetings(blocks: DataFrame, percent: int) -> DataFrame:
    """``sig, i, j, tile, node, label`` of the rows of large blocks in each pair (i, j) of tiles that may hold links across components.

    A block is cut by set size, its commonest component apart from the others, and the parts into tiles by hash, from counts that
    are added up first, so that no task numbers or holds a block. Tiles of the commonest component meet only those of others, and
    a row goes only where its size allows a link: one odd text among many near copies takes them along once, not in all pairs.
    """
    counts = blocks.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("_n"))
    main = counts.groupBy("sig").agg(F.max(F.struct("_n", "label")).alias("_most")).select("sig", F.col("_most.label").alias("_main"))
    step = math.log(max(SIZE_STEP, 100 / percent))
    part = 2 * F.floor(F.log("n") / step).cast("long") + (F.col("label") == F.col("_main")).cast("int")
    parted = blocks.join(main, "sig").withColumn("part", part)
    parts = kept(parted.groupBy("sig", "part").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("label").alias("least"), F.max("label").alias("most"),
        F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n") * 8 / TILE_BYTES)).cast("int").alias("tiles")), "classes")

    def tile(k: Column) -> Column:
        return F.col("part") * (1 << 32) + k

    tiled = parted.join(parts.select("sig", "part", "tiles"), ["sig", "part"]).select(
        "sig", "node", "label", "n", tile(F.pmod(F.xxhash64("node"), F.col("tiles"))).alias("tile"))
    every = parts.select("sig", "low", "high", "least", "most", (F.col("part") % 2 == 1).alias("main"),
                         F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("k"), "part").withColumn("tile", tile(F.col("k"))).drop("k", "part")
    left, right = (every.select("sig", *[F.col(c).alias(f"{x}_{c}") for c in every.columns[1:]]) for x in "ij")
    allowed = (100 * F.col("i_high") >= percent * F.col("j_low")) & (100 * F.col("j_high") >= percent * F.col("i_low"))
    once = ~F.col("i_main") & (F.col("j_main") | (F.col("i_tile") <= F.col("j_tile")))
    mixed = F.least("i_least", "j_least") != F.greatest("i_most", "j_most")
    meets = left.join(right, "sig").where(allowed & once & mixed)
    here = F.array(*[F.struct(F.col(f"{x}_tile").alias("tile"), F.col(f"{y}_low").alias("low"), F.col(f"{y}_high").alias("high")) for x, y in ("ij", "ji")])
    places = meets.select("sig", F.col("i_tile").alias("i"), F.col("j_tile").alias("j"), F.explode(F.array_distinct(here)).alias("_p")).select("sig", "i", "j", "_p.*")
    fits = (100 * F.col("n") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("n"))
    out = kept(tiled.join(places, ["sig", "tile"]).where(fits).select("sig", "i", "j", "tile", "node", "label"), "meetings")
    forget(parts)
    return out


def _large_blocks(meetings: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components in blocks of more than ``SMALL`` nodes.

    Whole sets travel with the tiles that meet, and of the links found a unit returns only those that join components it has not
    joined already, never all pairs.
    """
    work = meetings.join(shingles, "node")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        node, label, tile = pdf["node"].to_numpy(), pdf["label"].to_numpy(), pdf["tile"].to_numpy()
        sets = [np.asarray(x, dtype=np.int64).astype(np.uint64) for x in pdf["shingles"]]
        size = np.array([len(x) for x in sets])
        points = np.stack([folded(count_vector(x), COARSE) for x in sets])
        q, p = _wanted(label, points, tile == i, tile == j, percent)
        rows, columns = np.unique(q), np.unique(p)
        shared = shared_shingles([sets[x] for x in rows.tolist()], [sets[x] for x in columns.tolist()])
        both = shared[np.searchsorted(rows, q), np.searchsorted(columns, p)]
        similar = 100 * both >= percent * (size[q] + size[p] - both)
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        out = []
        for x, y in zip(q[similar].tolist(), p[similar].tolist(), strict=True):
            a, b = top(label[x]), top(label[y])
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((min(node[x], node[y]), max(node[x], node[y])))
        return pd.DataFrame(out, columns=["a", "b"])

    return work.select("sig", "i", "j", "tile", "node", "label", "shingles").groupBy("sig", "i", "j").applyInPandas(links, "a bigint, b bigint").distinct()


def _labelled(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, label, component_id`` of every row; ``label`` is null for rows without shingles.

    Rows link where 100 * shared shingles >= ``percent`` * all shingles of both; ``component_id`` is the least id
    reachable by links. Null texts and texts without words have no shingles and link with nothing. Equal sets are one
    node, named by a 64-bit digest, so copies are never paired. Null ids count as larger than all others.

    1. Of each set's shingles, in one order for all, only the first quarter can be the only ones shared, so two linked
       sets meet in the block of some such shingle. Each node is compared with the lead of its blocks.
    2. Blocks that still hold several components get R-trees over count vectors, which yield the pairs across components
       that sizes and summed smaller counts allow. Large blocks are cut into tiles that meet in pairs.
    3. All candidates are verified on whole shingle sets, those of large blocks where the tiles meet.
    """
    spark = docs.sparkSession
    common = _common_shingles(docs, id_col, text_col)
    rows = kept(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), profile(F.col(text_col), common, spark, percent).alias("_p"))
        .select("doc_id", "text_hash", "_p.*"), "profiles")
    nodes = kept(rows.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("groups").alias("groups"), F.min("doc_id").alias("rep")), "nodes")
    signed = rows.where("n > 0").select("node", F.explode("prefix").alias("sig")).repartition(partitions(spark), "sig")
    # a group of near copies has few leads, as each block takes its least node
    shared = signed.groupBy("sig").agg(F.min("node").alias("lead"), F.max("node").alias("_last")).where("lead <> _last").select("sig", "lead")
    blocks = kept(signed.join(shared, "sig").distinct(), "blocks")
    profiles, rows = rows, kept(rows.select("doc_id", "text_hash", "n", "node"), "rows")
    forget(profiles)

    stars = blocks.where("node <> lead").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
    candidates = _bounded(stars, nodes, percent)
    links = _verified(candidates, nodes, docs, id_col, text_col, percent)
    forget(candidates)
    names = components(links)
    open_ = _open_blocks(blocks.select("sig", "node"), nodes, names)
    forget(blocks)
    small, large = open_.where(F.col("size") <= SMALL), open_.where(F.col("size") > SMALL)
    if large.head(1):
        meetings = _meetings(large, percent)
        sets = _shingles(meetings.select("node").distinct(), nodes, docs, id_col, text_col)
        links = kept(links.unionByName(_large_blocks(meetings, sets, percent)), "links")
        forget(meetings, sets)
    if small.head(1):
        more = _small_blocks(small, nodes, percent)
        links = links.unionByName(_verified(more, nodes, docs, id_col, text_col, percent))
        forget(more)
    forget(open_)
    names = components(links)

    reps = nodes.join(names, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "rep")
    least = reps.groupBy("label").agg(F.min("rep").alias("component_id"))
    found = kept(reps.join(least, "label").select(F.col("node").alias("_node"), "label", "component_id"), "components")
    forget(nodes, names)
    joined = rows.select("doc_id", "text_hash", "n", "node").join(found, (F.col("n") > 0) & (F.col("node") == F.col("_node")), "left")
    return joined.select("doc_id", "text_hash", "n", "label", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row, as ``_labelled`` finds them; rows without shingles are by themselves."""
    return _labelled(docs, id_col, text_col, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs``, all columns kept, one for each component: that of the least id and then the least hash of the text.

    Rows are told apart by id and text, so another row of a kept id goes if it is a near copy itself. Null ids count as larger
    than all others. Rows that repeat an id and a text count once; rows without shingles all stay but for such repeats.
    """
    columns = docs.columns
    rows = _labelled(docs, id_col, text_col, percent)
    of_group = rows.where("n > 0").groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("at")).select("at.doc_id", "at.text_hash")
    stay = of_group.unionByName(rows.where("n = 0").select("doc_id", "text_hash")).select(F.struct(F.col("doc_id").alias("id")).alias("_id"), F.col("text_hash").alias("_text"))
    # ids in a struct are equal where both are null, so the join and the removal of repeats take one exchange of the documents
    whole = docs.select(F.struct("*").alias("_doc"), F.struct(F.col(id_col).alias("id")).alias("_id"), F.xxhash64(F.col(text_col)).alias("_text"))
    found = whole.join(stay, ["_text", "_id"], "left_semi").dropDuplicates(["_text", "_id"])
    return found.select(*[F.col(f"_doc.`{c}`").alias(c) for c in columns])


@query("op8_count_tree_jaccard")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
