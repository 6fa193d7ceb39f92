"""Planar spatial operators on points, grid cells and polygon edge tables.

An edge table holds one row per polygon side: ``region, ring, x1, y1, x2, y2`` (x = longitude).
Inside-ness is even-odd over all rings, so holes work; a side covers ``min(y) <= y < max(y)``.
Every join here is an equality join on a grid key with an exact residual test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from furrow import params as P
from furrow.functions import scalar as S
from furrow.functions.scalar import planar_distance
from furrow.operators.aggregates import weighted_mean
from furrow.operators.topk import first_n
from furrow.session import stored

# Ways to take a region's rainfall from a grid.
METHODS = ("centroid", "crop_weighted")


def _bin(c, size: float) -> Column:
    return F.floor(F.col(c) / F.lit(float(size))).cast("int") if isinstance(c, str) else F.floor(c / size).cast("int")


def crossing_x(y: Column) -> Column:
    """Where a horizontal line at ``y`` meets the edge."""
    return F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))


def points_in_polygons(points: DataFrame, edges: DataFrame, point_id: str = "point_id", lat: str = "lat",
                       lon: str = "lon", tile: float = 1.0) -> DataFrame:
    """Pairs (point, region) with the point inside.

    Points meet polygons through the tiles of the polygon's bounding box; surviving pairs meet only
    the polygon's edges in the point's latitude band, and the parity of crossings to the east is
    counted with map-side aggregation. A large polygon or a crowded tile spreads over its bands.
    """
    boxes = edges.groupBy("region").agg(
        F.min(F.least("x1", "x2")).alias("bx1"), F.max(F.greatest("x1", "x2")).alias("bx2"),
        F.min(F.least("y1", "y2")).alias("by1"), F.max(F.greatest("y1", "y2")).alias("by2"))
    tiles = boxes.select("*", F.explode(F.sequence(_bin("bx1", tile), _bin("bx2", tile))).alias("_tx")).select(
        "*", F.explode(F.sequence(_bin("by1", tile), _bin("by2", tile))).alias("_ty"))
    p = points.select(point_id, F.col(lat).alias("_y"), F.col(lon).alias("_x"),
                      _bin(lon, tile).alias("_tx"), _bin(lat, tile).alias("_ty"))
    inside_box = F.col("_x").between(F.col("bx1"), F.col("bx2")) & F.col("_y").between(F.col("by1"), F.col("by2"))
    pairs = p.join(tiles, ["_tx", "_ty"]).where(inside_box).select(point_id, "_x", "_y", "_ty", "region")
    sides = edges.where("y1 <> y2").select(
        "region", "x1", "y1", "x2", "y2",
        F.explode(F.sequence(_bin(F.least("y1", "y2"), tile), _bin(F.greatest("y1", "y2"), tile))).alias("_ty"))
    y = F.col("_y")
    spans = (F.col("y1") > y) != (F.col("y2") > y)
    hits = pairs.join(sides, ["region", "_ty"]).where(spans & (F.col("_x") < crossing_x(y)))
    return (hits.groupBy(point_id, "region").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") % 2 == 1).select(point_id, "region"))


def cells_in_polygons(edges: DataFrame, lat0: float, lon0: float, res: float, n_cols: int) -> DataFrame:
    """Grid cells whose centre lies inside each region, by scan lines.

    Each edge is expanded to the grid rows it spans; the sorted crossings of a row pair up into
    runs of cells. Work grows with outline length and covered cells, not with cells x regions, and
    (region, row) groups hold only one row's crossings.
    """
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.where("y1 <> y2").select(
        "region", "x1", "y1", "x2", "y2",
        F.explode(F.sequence((F.ceil((lo - lat0) / res) - 1).cast("int"), (F.floor((hi - lat0) / res) + 1).cast("int"))).alias("row"))
    y = F.lit(lat0) + F.col("row") * F.lit(res)
    spans = (F.col("y1") > y) != (F.col("y2") > y)
    crossings = rows.where(spans & (F.col("row") >= 0)).select("region", "row", crossing_x(y).alias("cx"))
    runs = crossings.groupBy("region", "row").agg(F.array_sort(F.collect_list("cx")).alias("xs"))
    pair = F.explode(F.sequence(F.lit(0), (F.size("xs") / 2 - 1).cast("int")))
    runs = runs.select("region", "row", "xs", pair.alias("i")).select(
        "region", "row", F.get("xs", F.col("i") * 2).alias("a"), F.get("xs", F.col("i") * 2 + 1).alias("b"))
    first = F.greatest(F.lit(0), F.floor((F.col("a") - lon0) / res).cast("int"))
    last = F.least(F.lit(n_cols - 1), F.ceil((F.col("b") - lon0) / res).cast("int"))
    cells = runs.where(last >= first).select("region", "row", "a", "b", F.explode(F.sequence(first, last)).alias("col"))
    x = F.lit(lon0) + F.col("col") * F.lit(res)
    return cells.where((x >= F.col("a")) & (x < F.col("b"))).select(
        "region", (F.col("row").cast("bigint") * n_cols + F.col("col")).alias("cell_id"))


def snap_to_cell(lat, lon, lat0: float, lon0: float, res: float, n_cols: int) -> Column:
    """Id of the nearest grid cell."""
    row = F.round((F.col(lat) - lat0) / res).cast("bigint")
    col = F.round((F.col(lon) - lon0) / res).cast("bigint")
    return row * n_cols + col


def ring_centroid(edges: DataFrame) -> DataFrame:
    """Mean of the exterior ring's vertices per region."""
    return edges.where("ring = 0").groupBy("region").agg(F.avg("y1").alias("lat"), F.avg("x1").alias("lon"))


def zone_split(edges: DataFrame, lat_cut: float) -> DataFrame:
    """North or south by the middle of the latitude range."""
    mid = (F.min(F.least("y1", "y2")) + F.max(F.greatest("y1", "y2"))) / 2
    out = edges.groupBy("region").agg(mid.alias("mid_lat"))
    return out.withColumn("zone", F.when(F.col("mid_lat") > lat_cut, "north").otherwise("south"))


def far_from(points: DataFrame, sites: DataFrame, radius: float, lat: str = "lat", lon: str = "lon",
             site_lat: str = "latitude", site_lon: str = "longitude") -> DataFrame:
    """Points with no site within ``radius``.

    Sites enter the 3x3 bins around them with bins as wide as the radius; the anti join stops at
    the first site in reach, so no pairs are produced.
    """
    around = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    s = sites.select(F.col(site_lat).alias("_sy"), F.col(site_lon).alias("_sx")).distinct()
    s = s.select("*", F.explode(around).alias("_i")).select("*", F.explode(around).alias("_j"))
    s = s.select("_sy", "_sx", (_bin("_sy", radius) + F.col("_i")).alias("_by"), (_bin("_sx", radius) + F.col("_j")).alias("_bx"))
    p = points.withColumn("_py", _bin(lat, radius)).withColumn("_px", _bin(lon, radius))
    near = (F.col("_py") == F.col("_by")) & (F.col("_px") == F.col("_bx")) & (
        planar_distance(lat, lon, "_sy", "_sx") <= radius)
    return p.join(s, near, "left_anti").drop("_py", "_px")


def nearest_site(points: DataFrame, sites: DataFrame, site_id: str, point_id: str = "point_id",
                 lat: str = "lat", lon: str = "lon", site_lat: str = "latitude", site_lon: str = "longitude",
                 fan: int = 8, leaf_sites: int = 64, max_depth: int = 10) -> DataFrame:
    """Exact nearest site of every point; ties go to the smallest id.

    Branch and bound down a grid tree: each level splits a cell ``fan`` x ``fan`` and keeps, per point, only
    the occupied cells that could still hold the nearest site (nearest corner no farther than the
    best farthest corner). The tree spans all points and sites, whatever their units, and is as deep as
    it takes for its fullest cell to hold ``leaf_sites`` places. At most fan^2 and fan^4 cells are occupied
    on the first two levels, so those reach the points as a literal and as a small broadcast; deeper
    steps are equality joins on the cell. Rows without finite coordinates have no nearest site.
    """
    def finite(y: str, x: str):
        return F.abs(F.col(y)).between(0.0, 1e150) & F.abs(F.col(x)).between(0.0, 1e150)

    s = sites.select(F.col(site_id).alias("_sid"), F.col(site_lat).cast("double").alias("_sy"), F.col(site_lon).cast("double").alias("_sx"))
    s = s.where(finite("_sy", "_sx")).groupBy("_sy", "_sx").agg(F.min("_sid").alias("_sid"))
    p = points.select(point_id, F.col(lat).cast("double").alias("_py"), F.col(lon).cast("double").alias("_px")).where(finite("_py", "_px"))
    span = s.select("_sy", "_sx").unionByName(p.select(F.col("_py").alias("_sy"), F.col("_px").alias("_sx"))).agg(
        F.min("_sy").alias("y0"), F.min("_sx").alias("x0"), F.max("_sy").alias("y1"), F.max("_sx").alias("x1")).first()
    y0, x0 = span["y0"] or 0.0, span["x0"] or 0.0
    extent = max((span["y1"] or 0.0) - y0, (span["x1"] or 0.0) - x0) * (1 + 1e-9) or 1.0

    def cell(level: int):
        size, last = extent / fan ** level, F.lit(fan ** level - 1)
        return (F.least(F.floor((F.col("_sy") - y0) / size), last).alias("_ny"), F.least(F.floor((F.col("_sx") - x0) / size), last).alias("_nx"))

    def occupied(level: int) -> DataFrame:
        return s.select(*cell(level)).distinct().select(
            F.floor(F.col("_ny") / fan).alias("_cy"), F.floor(F.col("_nx") / fan).alias("_cx"), "_ny", "_nx")

    depth = 1
    while depth < max_depth:
        fullest = s.select(*cell(depth)).groupBy("_ny", "_nx").count().agg(F.max("count")).first()[0] or 0
        if fullest <= leaf_sites:
            break
        depth += 1
    top = [F.struct(F.lit(r["_ny"]).alias("_ny"), F.lit(r["_nx"]).alias("_nx")) for r in occupied(1).collect()]
    best = W.partitionBy(point_id)
    open_cells = p
    for level in range(1, depth + 1):
        size = extent / fan ** level
        # a cell's box is taken a little wider than it is, so that rounding loses no site
        slack = 1e-9 * extent
        cy1, cx1 = F.col("_ny") * size + y0 - slack, F.col("_nx") * size + x0 - slack
        cy2, cx2 = cy1 + size + 2 * slack, cx1 + size + 2 * slack
        dy = F.greatest(cy1 - F.col("_py"), F.lit(0.0), F.col("_py") - cy2)
        dx = F.greatest(cx1 - F.col("_px"), F.lit(0.0), F.col("_px") - cx2)
        fy = F.greatest(F.abs(F.col("_py") - cy1), F.abs(F.col("_py") - cy2))
        fx = F.greatest(F.abs(F.col("_px") - cx1), F.abs(F.col("_px") - cx2))
        if level == 1:
            cells = F.array(*top) if top else F.array().cast("array<struct<_ny:bigint,_nx:bigint>>")
            step = open_cells.select("*", F.explode(cells).alias("_t")).select("*", "_t._ny", "_t._nx")
        else:
            below = occupied(level)
            step = open_cells.join(F.broadcast(below) if level == 2 else below, ["_cy", "_cx"])
        step = step.withColumn("_near", dy * dy + dx * dx).withColumn("_far", fy * fy + fx * fx)
        open_cells = (
            step.withColumn("_reach", F.min("_far").over(best)).where(F.col("_near") <= F.col("_reach") * (1 + 1e-12))
            .select(point_id, "_py", "_px", F.col("_ny").alias("_cy"), F.col("_nx").alias("_cx"))
        )
    cy, cx = cell(depth)
    leaves = s.select("_sid", "_sy", "_sx", cy.alias("_cy"), cx.alias("_cx"))
    d = planar_distance("_py", "_px", "_sy", "_sx")
    found = open_cells.join(leaves, ["_cy", "_cx"]).select(point_id, "_sid", d.alias("distance"))
    return found.groupBy(point_id).agg(
        F.min_by("_sid", F.struct("distance", "_sid")).alias(site_id), F.min("distance").alias("distance"))


def region_cell_weights(edges: DataFrame, cells: DataFrame, lat0: float, lon0: float, res: float, n_cols: int,
                        floor: float = P.CROP_FLOOR) -> DataFrame:
    """Cells and weights per region: inside cells by cropland fraction, else one fallback cell.

    A region without cropland takes the cell nearest its outline's mean vertex. Compute once per
    grid and reuse for every month.
    """
    inside = cells_in_polygons(edges, lat0, lon0, res, n_cols).join(cells.select("cell_id", "frac"), "cell_id")
    weighted = inside.select("region", "cell_id", F.when(F.col("frac") >= floor, F.col("frac")).otherwise(0.0).alias("weight"))
    weighted = weighted.where("weight > 0").withColumn("fallback", F.lit(False))
    bare = ring_centroid(edges).join(weighted.select("region").distinct(), "region", "left_anti")
    nearest = nearest_site(bare, cells, "cell_id", "region", site_lat="lat", site_lon="lon")
    return weighted.unionByName(nearest.select(
        "region", "cell_id", F.lit(1.0).alias("weight"), F.lit(True).alias("fallback")))


def zonal_mean(grid: DataFrame, weights: DataFrame, time: Sequence[str] = ("year", "month"), value: str = "mm") -> DataFrame:
    """Weighted mean of grid values per region and time; NULL cells drop out of the mean."""
    return grid.join(weights, "cell_id").groupBy("region", *time).agg(
        weighted_mean(value, "weight").alias(value), F.count(value).alias("n_cells"),
        F.bool_or("fallback").alias("fallback"))


def method_weights(edges: DataFrame, cells: DataFrame, lat0: float, lon0: float, res: float, n_cols: int, floor: float = P.CROP_FLOOR,
                   methods: Sequence[str] = METHODS) -> DataFrame:
    """``region, method, cell_id, weight, fallback``: one sparse table a grid, for any period and both ways of extraction.

    ``centroid`` is the cell nearest the outline's mean vertex with weight 1, ``crop_weighted`` the region's cells by cropland
    fraction. Store it and multiply it with as many periods as wanted.
    """
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}")
    parts = []
    if "centroid" in methods:
        near = nearest_site(ring_centroid(edges), cells, "cell_id", "region", site_lat="lat", site_lon="lon")
        parts.append(near.select("region", F.lit("centroid").alias("method"), "cell_id", F.lit(1.0).alias("weight"), F.lit(False).alias("fallback")))
    if "crop_weighted" in methods:
        own = region_cell_weights(edges, cells, lat0, lon0, res, n_cols, floor)
        parts.append(own.select("region", F.lit("crop_weighted").alias("method"), "cell_id", "weight", "fallback"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def zonal_extract(grid: DataFrame, table: DataFrame, time: Sequence[str] = ("year", "month"), value: str = "mm") -> DataFrame:
    """``region, method, *time, value, n_cells, fallback``: the grid times a weight table, renormalised over the cells with data.

    One join and one grouping of the grid's scan, whatever the number of methods.
    """
    return grid.join(table, "cell_id").groupBy("region", "method", *time).agg(
        weighted_mean(value, "weight").alias(value), F.count(value).alias("n_cells"), F.bool_or("fallback").alias("fallback"))


def partial_month_regions(daily: DataFrame, table: DataFrame, year: int, month: int, value: str = "mm") -> DataFrame:
    """Month-to-date rainfall of each region and method, from one scan of the month's days.

    The last day is the last one on which any cell of the grid has data, so sums need no cut. A cell that lacks a day up to it
    leaves the crop-weighted mean, and counts 0 for that day in the centroid form; a centroid cell without any data has none.
    """
    days = daily.where((F.col("year") == year) & (F.col("month") == month)).groupBy("cell_id").agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_days"), F.max(F.when(F.col(value).isNotNull(), F.col("day"))).alias("_last"))
    cells = stored(days, "partial-month")
    last = cells.agg(F.max("_last")).first()[0]
    if last is None:
        raise ValueError(f"no data in {year}-{month:02d}")
    centroid = F.col("method") == "centroid"
    whole = F.when(centroid | (F.col("_days") == last), F.col("_sum"))
    out = cells.join(table, "cell_id").select("region", "method", "weight", "fallback", whole.alias("_mm")).groupBy("region", "method").agg(
        weighted_mean("_mm", "weight").alias("rainfall_mm"), F.count("_mm").alias("n_cells"), F.bool_or("fallback").alias("fallback"))
    flag = S.cases((centroid & F.col("rainfall_mm").isNull(), "nodata"), (centroid, "partial_month"), (F.col("fallback"), "cropfrac_centroid_fallback"), otherwise="ok")
    return out.select("region", "method", F.lit(year).alias("year"), F.lit(month).alias("month"), "rainfall_mm", "n_cells", flag.alias("quality_flag"),
                      F.lit(True).alias("is_partial_month"), F.lit(last).alias("partial_month_through_day"))


def partial_month(daily: DataFrame, year: int, month: int, value: str = "mm") -> DataFrame:
    """Rows of one month up to the last day on which any cell has data, with that day attached."""
    rows = daily.where((F.col("year") == year) & (F.col("month") == month))
    last = rows.where(F.col(value).isNotNull()).agg(F.max("day").alias("d")).first()["d"]
    if last is None:
        raise ValueError(f"no data in {year}-{month:02d}")
    return rows.where(F.col("day") <= last).withColumn("through_day", F.lit(last))


def partial_month_cells(part: DataFrame, require_all_days: bool, value: str = "mm") -> DataFrame:
    """Month-to-date sum per cell: missing days count as 0, or drop the cell when required whole."""
    total = F.sum(value)
    if require_all_days:
        total = F.when(F.count(value) == F.max("through_day"), total)
    return part.groupBy("cell_id", "through_day").agg(total.alias(value))


def gap_grid(bounds: DataFrame, res: float, edges: DataFrame | None, sites: DataFrame, radius: float,
             limit: int | None = None) -> DataFrame:
    """Regular points inside boxes and polygons that no site is close to.

    ``bounds`` has columns lat_min, lat_max, lon_min, lon_max. Points that several boxes share
    appear once.
    """
    def axis(lo, hi):
        steps = F.floor((F.col(hi) + res / 2 - F.col(lo)) / res - 1e-9).cast("int")
        return F.sequence(F.lit(0), F.greatest(steps, F.lit(0)))

    pts = bounds.select("*", F.explode(axis("lat_min", "lat_max")).alias("_i")).select(
        "*", F.explode(axis("lon_min", "lon_max")).alias("_j"))
    pts = pts.select(F.round(F.col("lat_min") + F.col("_i") * res, 4).alias("lat"),
                     F.round(F.col("lon_min") + F.col("_j") * res, 4).alias("lon")).distinct()
    pts = pts.withColumn("point_id", F.concat_ws("_", F.lit("DD"), F.col("lat").cast("string"), F.col("lon").cast("string")))
    if edges is not None:
        pts = pts.join(points_in_polygons(pts, edges).select("point_id").distinct(), "point_id", "left_semi")
    pts = far_from(pts, sites, radius)
    return first_n(pts, ["lat", "lon", "point_id"], limit) if limit is not None else pts


def cropland_fraction(pixels: DataFrame, fine: str = "fine_cell", coarse: str = "cell_id", code: str = "code") -> DataFrame:
    """Share of fine cells whose most frequent class is cropland, per coarse cell."""
    counts = pixels.groupBy(coarse, fine, code).agg(F.count(F.lit(1)).alias("_n"))
    main = counts.groupBy(coarse, fine).agg(F.min_by(code, F.struct(-F.col("_n"), F.col(code))).alias(code))
    crop = F.lit(False)
    for lo, hi in P.CROPLAND_CLASSES:
        crop = crop | F.col(code).between(lo, hi)
    return main.groupBy(coarse).agg(F.avg(crop.cast("double")).alias("frac"), F.count(F.lit(1)).alias("n_fine"))
