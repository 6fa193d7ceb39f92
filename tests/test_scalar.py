import pytest
from tests.conftest import day
from pyspark.sql import functions as F

from furrow.functions import scalar as S
from furrow.functions import sql as Q


def one(spark, col, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,want", [("8137", "008137"), ("12345678", "12345678"), ("DD_-31.5_117.25", "DD_-31.5_117.25")])
def test_station_id_keeps_long_and_point_ids(spark, raw, want):
    assert one(spark, S.norm_station_id("c"), c=("string", raw)) == want


@pytest.mark.parametrize("raw,want", [("11060.0", "11060"), (" 7 ", "7"), ("x", ""), (None, ""), ("NaN", "")])
def test_region_code(spark, raw, want):
    assert one(spark, S.norm_region_code("c"), c=("string", raw)) == want


def test_code9_to_5(spark):
    assert one(spark, S.code9_to_5("c"), c=("string", "103011060")) == "11060"
    assert one(spark, S.code9_to_5("c"), c=("string", "123")) == "123"


def test_point_id_parts(spark):
    assert one(spark, S.point_lat("c"), c=("string", "DD_-31.50_117.25")) == -31.5
    assert one(spark, S.point_lon("c"), c=("string", "DD_-31.50")) is None


@pytest.mark.parametrize("t,stage,want", [
    (-3.0, "flowering", "severe"), (-2.9, "flowering", "moderate"), (1.0, "flowering", "light"), (1.1, "flowering", None),
    (2.0, "tillering", "light"), (-2.0, "tillering", "severe"), (-4.0, "grain_fill", "severe"), (0.1, "grain_fill", None)])
def test_frost_bounds_include_the_threshold(spark, t, stage, want):
    assert one(spark, S.frost_severity("t", "s"), t=("double", t), s=("string", stage)) == want


@pytest.mark.parametrize("t,want", [(-2.0, "moderate"), (-2.1, "severe"), (0.0, "light"), (2.0, "light"), (2.1, None)])
def test_flat_frost_bounds_are_strict(spark, t, want):
    assert one(spark, S.frost_severity_flat("t"), t=("double", t)) == want


@pytest.mark.parametrize("code,want", [(0, 1.0), (15, 0.8), (25, 0.7), (35, 0.3), (75, 0.6), (999, 0.0), (23, 0.5), (None, 0.5)])
def test_quality_confidence(spark, code, want):
    assert one(spark, S.quality_confidence("c"), c=("int", code)) == want


@pytest.mark.parametrize("d,stage,heat", [
    ("2026-02-01", "maturity", False), ("2026-05-01", "planting", False), ("2026-09-01", "tillering", False), ("2026-09-02", "flowering", False),
    ("2026-11-01", "grain_fill", True), ("2026-11-02", "harvest", False), ("2027-01-05", "maturity", False)])
def test_literal_calendar(spark, d, stage, heat):
    assert one(spark, S.crop_stage("d"), d=("date", day(d))) == stage
    assert one(spark, S.stage_flag(S.crop_stage("d"), "heat"), d=("date", day(d))) is heat


def test_month_calendar_option(spark):
    assert one(spark, S.crop_stage("d", "months"), d=("date", day("2026-11-20"))) == "grain_fill"


def test_phenology_multiplier_is_clamped(spark):
    args = dict(s=("string", "flowering"), a=("boolean", True), n=("int", 3))
    assert one(spark, S.phenology_multiplier("s", "frost", "a", "n"), **args) == 3.0
    args["n"] = ("int", 20)
    args["s"] = ("string", "tillering")
    assert one(spark, S.phenology_multiplier("s", "frost", "a", "n"), **args) == pytest.approx(1.3)


@pytest.mark.parametrize("d,p,want", [(127, 99.0, None), (128, 0.0, "low"), (151, 0.0, "medium"), (158, 99.0, "high"), (165, 90.0, "extreme"), (165, 89.0, "high"), (165, None, "high")])
def test_sowing_band(spark, d, p, want):
    col = S.sowing_band("d", F.lit(127), F.lit(150), F.lit(157), F.col("p"))
    assert one(spark, col, d=("int", d), p=("double", p)) == want


@pytest.mark.parametrize("pct,want", [(0.0, 0), (10.0, 0), (10.1, 1), (90.0, 8), (90.1, 9), (100.0, 9)])
def test_percentile_bins_close_on_the_right(spark, pct, want):
    assert one(spark, S.pct_bin10("p"), p=("double", pct)) == want


def test_break_status_boundaries(spark):
    got = [one(spark, S.break_status_date("d"), d=("date", day(f"2026-{m}"))) for m in ("05-14", "05-15", "06-15", "06-16")]
    assert got == ["early", "on_time", "on_time", "late"]
    assert one(spark, S.season_label("y"), y=("int", 2099)) == "2099/00"


def test_sql_functions(spark):
    Q.register(spark)
    r = spark.sql("SELECT decile_rank(0L, 21L) a, decile_rank(20L, 20L) b, decile_score(1L, 8L) c, quality_confidence(23) d, break_status(DATE'2026-06-16') e").first()
    assert tuple(r) == (1, 10, 2.5, 0.5, "late")


def test_nan_counts_as_missing(spark):
    assert one(spark, S.clean_number("x"), x=("double", float("nan"))) is None
    assert one(spark, S.nodata_flag("x"), x=("double", -32767.0)) == "nodata"
    assert one(spark, S.nodata_flag("x"), x=("double", -1.0)) == "negative_sum"


def test_mixed_dates(spark):
    for text in ("2026-03-04", "20260304", "04/03/2026"):
        assert one(spark, S.parse_date_mixed("c"), c=("string", text)) == day("2026-03-04")
    assert one(spark, S.parse_date_mixed("c"), c=("string", "soon")) is None
