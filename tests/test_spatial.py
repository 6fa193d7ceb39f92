import math
import random

import pytest
from tests.conftest import rows

from furrow.operators import spatial as SP


def square(region, ring, x1, y1, x2, y2):
    c = [(x1, y1), (x1, y2), (x2, y2), (x2, y1), (x1, y1)]
    return [(region, ring, *a, *b) for a, b in zip(c, c[1:])]


EDGES = "region string, ring int, x1 double, y1 double, x2 double, y2 double"


def edges(spark, *parts):
    return spark.createDataFrame([e for p in parts for e in p], EDGES)


def points(spark, pts):
    return spark.createDataFrame([(i, float(y), float(x)) for i, (y, x) in enumerate(pts)], "point_id int, lat double, lon double")


def test_square_with_hole(spark):
    e = edges(spark, square("a", 0, 0.0, 0.0, 10.0, 10.0), square("a", 1, 4.0, 4.0, 6.0, 6.0), square("b", 0, 20.0, 0.0, 21.0, 1.0))
    p = points(spark, [(5.5, 5.5), (2.5, 2.5), (0.5, 20.5), (50.0, 50.0)])
    assert rows(SP.points_in_polygons(p, e)) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_points_match_a_loop(spark, seed):
    rnd = random.Random(seed)
    polys = {f"r{k}": [(rnd.uniform(-8, 8) + 9 * math.cos(a), rnd.uniform(-3, 3) + 9 * math.sin(a)) for a in [i * 2 * math.pi / 9 for i in range(9)]] for k in range(3)}
    e = [(r, 0, *a, *b) for r, c in polys.items() for a, b in zip(c, c[1:] + c[:1])]
    pts = [(rnd.uniform(-12, 12), rnd.uniform(-18, 18)) for _ in range(200)]
    want = []
    for i, (y, x) in enumerate(pts):
        for r in polys:
            n = sum((y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1) for q, _, x1, y1, x2, y2 in e if q == r)
            if n % 2:
                want.append((i, r))
    got = SP.points_in_polygons(points(spark, pts), spark.createDataFrame(e, EDGES), tile=2.5)
    assert rows(got) == sorted(want, key=repr)


def test_scan_lines_agree_with_the_point_test(spark):
    e = edges(spark, [("a", 0, 0.3, 0.2, 3.1, 2.9), ("a", 0, 3.1, 2.9, 4.7, -1.3), ("a", 0, 4.7, -1.3, 0.3, 0.2)], square("b", 0, 1.05, 1.05, 3.55, 3.55), square("b", 1, 2.05, 2.05, 2.45, 2.45))
    lat0, lon0, res, n = -2.0, -1.0, 0.1, 100
    grid = [(r * n + c, lat0 + r * res, lon0 + c * res) for r in range(80) for c in range(n)]
    cells = spark.createDataFrame(grid, "point_id long, lat double, lon double")
    want = {(r, i) for i, r in rows(SP.points_in_polygons(cells, e))}
    assert {tuple(x) for x in SP.cells_in_polygons(e, lat0, lon0, res, n).collect()} == want and want


def test_nearest_site_matches_a_loop_with_a_crowded_place(spark):
    rnd = random.Random(5)
    sites = [(f"s{i:03d}", -31.0 + rnd.uniform(0, 0.01), 117.0 + rnd.uniform(0, 0.01)) for i in range(150)] + [("far", 10.0, -60.0), ("s000x", -20.0, 140.0), ("dup", -20.0, 140.0)]
    pts = [(rnd.uniform(-45, -10), rnd.uniform(110, 155)) for _ in range(60)] + [(-31.005, 117.005), (0.0, 0.0)]
    got = {r["point_id"]: r["sid"] for r in SP.nearest_site(points(spark, pts), spark.createDataFrame(sites, "sid string, latitude double, longitude double"), "sid").collect()}
    for i, (y, x) in enumerate(pts):
        assert got[i] == min(sites, key=lambda s: (math.hypot(y - s[1], x - s[2]), s[0]))[0]


def test_far_from_uses_the_exact_radius(spark):
    sites = spark.createDataFrame([(0.0, 0.0)], "latitude double, longitude double")
    assert rows(SP.far_from(points(spark, [(0.0, 1.0), (0.0, 1.01), (0.8, 0.8), (5.0, 5.0)]), sites, 1.0), "point_id") == [(1,), (2,), (3,)]


def zonal(spark, frac, values, outline):
    res, n = 1.0, 10
    cells = spark.createDataFrame([(i, float(i // n), float(i % n), f) for i, f in frac.items()], "cell_id long, lat double, lon double, frac double")
    grid = spark.createDataFrame([(i, 2026, 5, v) for i, v in values.items()], "cell_id long, year int, month int, mm double")
    w = SP.region_cell_weights(edges(spark, outline), cells, 0.0, 0.0, res, n)
    return SP.zonal_mean(grid, w).first()


def test_zonal_means(spark):
    two = square("a", 0, -0.5, -0.5, 1.5, 0.5)
    assert zonal(spark, {0: 0.1, 1: 0.3}, {0: 10.0, 1: 20.0}, two)["mm"] == pytest.approx(17.5)
    assert zonal(spark, {0: 0.1, 1: 0.3}, {0: None, 1: 20.0}, two)["mm"] == 20.0
    got = zonal(spark, {0: 0.0, 1: 0.01}, {0: 5.0, 1: 20.0}, square("a", 0, 0.4, -0.5, 1.5, 0.5))
    assert got["mm"] == 20.0 and got["fallback"]


def test_partial_month_of_regions_by_method(spark):
    daily = spark.createDataFrame([(c, 2026, 5, d, mm) for c, mms in ((1, (1.0, 2.0, 3.0, None)), (2, (5.0, None, 1.0, None)), (3, (None, None, None, None)), (4, (2.0, 2.0, 2.0, None)))
                                   for d, mm in enumerate(mms, 1)], "cell_id long, year int, month int, day int, mm double")
    table = spark.createDataFrame([("r", "centroid", 2, 1.0, False), ("r", "crop_weighted", 1, 0.5, False), ("r", "crop_weighted", 2, 0.5, False), ("r", "crop_weighted", 4, 0.25, False),
                                   ("s", "centroid", 3, 1.0, False), ("s", "crop_weighted", 3, 1.0, True)], "region string, method string, cell_id long, weight double, fallback boolean")
    got = rows(SP.partial_month_regions(daily, table, 2026, 5), "region", "method", "rainfall_mm", "n_cells", "quality_flag", "partial_month_through_day")
    assert got == [("r", "centroid", 6.0, 1, "partial_month", 3), ("r", "crop_weighted", 6.0, 2, "ok", 3), ("s", "centroid", None, 0, "nodata", 3),
                   ("s", "crop_weighted", None, 0, "cropfrac_centroid_fallback", 3)]


def test_partial_month_missing_day(spark):
    daily = spark.createDataFrame([(1, 2026, 5, d, v) for d, v in ((1, 2.0), (2, None), (3, 4.0), (4, None))] + [(2, 2026, 5, d, 1.0) for d in (1, 2, 3)],
                                  "cell_id int, year int, month int, day int, mm double")
    part = SP.partial_month(daily, 2026, 5)
    assert rows(SP.partial_month_cells(part, False)) == [(1, 3, 6.0), (2, 3, 3.0)]
    assert rows(SP.partial_month_cells(part, True)) == [(1, 3, None), (2, 3, 3.0)]
    with pytest.raises(ValueError, match="no data"):
        SP.partial_month(daily, 2026, 6)


def test_cropland_fraction_takes_the_mode_first(spark):
    px = [(1, 1, 335)] * 2 + [(1, 1, 210)] + [(1, 2, 210)] + [(1, 3, 439)]
    assert SP.cropland_fraction(spark.createDataFrame(px, "cell_id int, fine_cell int, code int")).first()["frac"] == pytest.approx(2 / 3)


def test_nearest_site_of_projected_coordinates_far_from_the_origin(spark):
    sites = spark.createDataFrame([("far", 5001.0, 5001.0), ("near", 1.0, 1.0), ("east", 812_000.5, 6_100_000.25), ("none", None, 1.0)],
                                  "sid string, latitude double, longitude double")
    pts = [(1, 5000.0, 5000.0), (2, 0.0, 0.0), (3, 812_000.0, 6_100_000.0), (4, -9e6, 2.0), (5, float("nan"), 0.0)]
    df = spark.createDataFrame(pts, "point_id int, lat double, lon double")
    got = {r["point_id"]: r["sid"] for r in SP.nearest_site(df, sites, "sid").collect()}
    assert got == {1: "far", 2: "near", 3: "east", 4: "near"}
    assert SP.nearest_site(df, sites.where("false"), "sid").collect() == []
