import pytest
from tests.conftest import day, rows
from pyspark.sql import functions as F

from furrow.operators import aggregates as A
from furrow.operators import joins, sets, topk
from furrow.plans import analogue as AN
from furrow.plans import regions as RG
from furrow.plans import seasons as SE
from furrow.plans import sowing as SW
from furrow.plans import windows as WN

HIST = "sa2_code string, year int, month int, rainfall_mm double"


def history(spark, target_months=4):
    data = [("1", y, m, 60.0 if m == 5 else 10.0) for y in range(2005, 2026) for m in range(1, 6)]
    data += [("1", 2026, m, 10.0) for m in range(1, target_months + 1)]
    return data


def test_partial_month_is_ranked_against_scaled_months(spark):
    h = spark.createDataFrame(history(spark), HIST)
    mtd = spark.createDataFrame([("1", 2026, 45.0)], "sa2_code string, year int, rainfall_mm double")
    got = WN.region_ranks(h, [WN.Window("jan_may", 1, 5, True)], 2026, 2005, 2025, mtd=mtd, mtd_month=5, through_day=20).first()
    assert got["value"] == 85.0 and round(got["hist_median"], 1) == 78.7 and got["percentile_rank"] == 100.0


def test_incomplete_years_leave_the_baseline(spark):
    data = [r for r in history(spark) if not (r[1] in (2010, 2011) and r[2] == 2)]
    got = WN.region_ranks(spark.createDataFrame(data, HIST), [WN.Window("jan_apr", 1, 4)], 2026, 2005, 2025).first()
    assert got["n_hist_years"] == 19


def test_missing_month_to_date_is_not_zero(spark):
    h = spark.createDataFrame(history(spark), HIST)
    none = spark.createDataFrame([], "sa2_code string, year int, rainfall_mm double")
    assert WN.region_ranks(h, [WN.Window("jan_may", 1, 5, True)], 2026, 2005, 2025, mtd=none, mtd_month=5, through_day=20).count() == 0


def test_weighted_mean_skips_null_and_nonpositive_weights(spark):
    df = spark.createDataFrame([(10.0, 1.0), (20.0, 3.0), (None, 5.0), (99.0, 0.0), (99.0, -1.0)], "v double, w double")
    assert df.agg(A.weighted_mean("v", "w").alias("x")).first()["x"] == 17.5
    assert df.where("w <= 0").agg(A.weighted_mean("v", "w").alias("x")).first()["x"] is None


def test_state_windows_weight_region_sums(spark):
    rain = [(c, "WA", 2010, m, v, False) for c, v in (("50001", 20.0), ("50002", 50.0)) for m in (1, 2, 3)]
    df = spark.createDataFrame(rain, "sa2_5 string, state_name string, year int, month int, rainfall_mm double, is_partial_month boolean")
    w = spark.createDataFrame([("50001", "WA", 100.0), ("50002", "WA", 400.0)], "sa2_5 string, state_name string, weight double")
    assert A.window_by_state(df, w, 2013).first()["jan_mar"] == 132.0


def test_nearest_analogue_and_production(spark):
    s = spark.createDataFrame([("WA", 2010, 100.0, 50.0, 200.0), ("WA", 2011, 200.0, 80.0, 300.0), ("WA", 2012, 300.0, 90.0, 100.0), ("WA", 2013, 110.0, 52.0, None)],
                              "state_name string, year int, jan_mar double, apr_may double, jun_oct double")
    an = AN.select_analogues(s, 2013, ["jan_mar", "apr_may"])
    assert [r["year"] for r in an.orderBy("rank").collect()] == [2010, 2011, 2012]
    prod = [("WA", "Wheat", y, m, v) for y, a, p in ((2010, 10.0, 20.0), (2011, 10.0, 10.0), (2012, 0.0, 5.0), (2025, 4e6, None)) for m, v in (("Area", a), ("Production", p))]
    p = spark.createDataFrame(prod, "state string, crop string, crop_season int, metric string, value_normalized double")
    got = AN.implied_production(an, p, 2025).first()
    assert got["mean_yield"] == 1.5 and got["implied_production_mt"] == 6.0
    d = AN.production_dispersion(an, p, 2025).first()
    assert (d["production_low_mt"], d["production_high_mt"]) == (8.0, 4.0)
    assert AN.select_analogues(s.withColumn("apr_may", F.when(F.col("year") < 2013, F.col("apr_may"))), 2013, ["jan_mar", "apr_may"]).count() == 0


def breaks(spark, data):
    return spark.createDataFrame(data, "sd_region string, season_year int, status string, break_doy int, weight double")


def test_break_rollup_counts_absent_in_coverage_only(spark):
    got = SW.sd_break_rollup(breaks(spark, [("A", 2026, "early", 120, 3.0), ("A", 2026, "late", 180, 1.0), ("A", 2026, "absent", None, 4.0), ("B", 2026, "early", 120, 0.0)])).collect()
    assert len(got) == 1 and got[0]["break_doy"] == 135.0 and got[0]["coverage"] == 0.5
    assert not got[0]["coverage_ok"] and got[0]["break_status"] == "on_time" and got[0]["n_sa2_total"] == 3


def test_unknown_sd_code_fails_and_exclusions_carry_a_reason(spark):
    df = spark.createDataFrame([("505", "5"), ("540", "5"), ("105", "1")], "sd_code string, sd_state_code string")
    kept, dropped = SW.resolve_region(df, {"505": "WA_PERTH"}, {"540": "pastoral"}, "5")
    assert rows(kept, "sd_region") == [("WA_PERTH",)] and dropped.count() == 2
    with pytest.raises(ValueError, match="unknown SD"):
        SW.resolve_region(df, {"505": "WA_PERTH"}, {}, "5")


def test_unmapped_commodity_fails(spark):
    df = spark.createDataFrame([("wheat",), ("rye",)], "crop string")
    with pytest.raises(Exception, match="no commodity mapping"):
        SW.resolve_commodity(df, {"wheat": "wheat_incl_durum"}).collect()


def guide(spark, year, conf="high"):
    return ("WA", "A", "winter_dominant", "wheat", "winter", 120, 127, 150, 157, f"g{year}", year, conf)


GUIDE = "state string, sd_region string, rainfall_regime string, commodity string, season_type string, earliest_sow_doy int, optimal_start_doy int, optimal_end_doy int, latest_viable_doy int, source_document string, source_year int, confidence string"


def test_pressure_uses_the_latest_usable_guide_and_downgrades(spark):
    sd = SW.sd_break_rollup(breaks(spark, [("A", y, "late", 130 + i, 1.0) for i, y in enumerate(range(2015, 2026))] + [("A", 2026, "late", 170, 1.0)]))
    g = spark.createDataFrame([guide(spark, 2020), guide(spark, 2024), guide(spark, 2030)], GUIDE)
    got = {r["season_year"]: r for r in SW.sowing_pressure(sd, g).collect()}
    assert got[2026]["guide_source_year"] == 2024 and got[2026]["pressure_band"] == "extreme" and got[2026]["window_confidence"] == "high"
    assert got[2026]["days_after_latest_viable"] == 13 and got[2026]["window_overlap_days"] == 0
    assert got[2020]["window_confidence"] == "low" and min(got) == 2020


def test_guide_rows_are_validated(spark):
    bad = spark.createDataFrame([guide(spark, 2024), ("WA", "A", "odd", "wheat", "winter", 400, 127, 120, 157, "g", 2024, "high")], GUIDE)
    assert [r["errors"] for r in SW.window_violations(bad).collect()] == [["doy_range", "doy_order", "rainfall_regime"]]
    with pytest.raises(ValueError, match="invalid sowing"):
        SW.check_windows(bad)


def test_bridge_fails_on_a_region_without_overlap(spark):
    conc = spark.createDataFrame([("1", "A", 0.75), ("1", "B", 0.25)], "sa2_code string, sd_code string, allocation_ratio double")
    area = spark.createDataFrame([("1", 100.0)], "sa2_code string, area double")
    ok = joins.bridge(spark.createDataFrame([("1",)], "sa2_code string"), conc, area)
    assert rows(ok, "sd_code", "weight") == [("A", 75.0), ("B", 25.0)]
    with pytest.raises(ValueError, match="absent from the concordance"):
        joins.bridge(spark.createDataFrame([("2",)], "sa2_code string"), conc, area)


def test_name_fallback_wants_one_unclaimed_match(spark):
    left = spark.createDataFrame([(1, "Esperance"), (2, "Moora"), (3, "Kulin")], "id int, n string")
    right = spark.createDataFrame([(10, "Esperance Region"), (11, "Moora"), (12, "Moora North"), (13, "Kuliny")], "rid int, rn string")
    assert rows(joins.unique_name_match(left, right, "id", "n", "rid", "rn")) == [(1, 10)]
    claimed = spark.createDataFrame([(12,)], "rid int")
    assert rows(joins.unique_name_match(left, right, "id", "n", "rid", "rn", claimed)) == [(1, 10), (2, 11)]


def crops(spark):
    return spark.createDataFrame([("11060.0", "A", "WA", 3000.0), ("11060", "A", "WA", 2500.0), ("11061", "B", "WA", None), ("x", "C", "WA", 1.0)],
                                 "station_sa2_5dig16 string, sa2_name string, state string, area_ha double")


def test_region_areas_and_coverage(spark):
    assert rows(A.region_areas(crops(spark)), "sa2_5", "total_area_ha") == [("11060", 5500.0), ("11061", 0.0)]
    assert rows(A.region_areas(crops(spark), min_area=1.0), "sa2_5") == [("11060",)]
    st = spark.createDataFrame([("11060.0", "009"), ("11060", "009"), ("11060", "001")], "sa2_5 string, station_id string")
    got = rows(A.coverage_report(A.region_areas(crops(spark)), st), "sa2_code", "n_stations", "station_ids", "gap_status")
    assert got == [("11060", 2, "001;009", "internal_bom"), ("11061", 0, "", "unresolved_gap")]


def test_freshness(spark):
    cov = spark.createDataFrame([("1", "A", "WA", "a;b"), ("2", "B", "WA", "c"), ("3", "C", "WA", "")], "sa2_code string, sa2_name string, state string, station_ids string")
    obs = spark.createDataFrame([("a", day("2026-06-01")), ("b", day("2026-06-30")), ("c", day("2026-06-08"))], "station_id string, date date")
    got = rows(A.freshness(cov, obs, "2026-06-30"), "sa2_code", "n_stations", "days_behind_cutoff", "status")
    assert got == [("1", 2, 0, "current"), ("2", 1, 22, "stale"), ("3", 0, None, "no_data")]
    assert A.freshness_verdict(A.freshness(cov, obs, "2026-06-30")).first()["verdict"] == "FAIL"


def test_exact_median_with_a_value_holding_most_rows(spark):
    data = [(5.0,)] * 200 + [(float(i),) for i in range(101)] + [(1e12,), (None,)]
    df = spark.createDataFrame(data, "v double")
    want = df.agg(F.median("v")).first()[0]
    assert A.exact_median(df, "v") == want
    assert A.exact_median(spark.createDataFrame([(1.0,), (4.0,)], "v double"), "v") == 2.5
    assert A.exact_median(spark.createDataFrame([], "v double"), "v") is None


def test_no_data_rows_enter_every_season_and_count_in_the_universe(spark):
    schema = ("state string, crop string, sa2_name string, season_year int, rainfall_feature_quality_flag string, area_ha_for_weighting double, "
              "area_is_fallback boolean, rainfall_total_apr_oct_mm double")
    data = [("WA", "wheat", "A", 2024, "complete", 100.0, False, 200.0), ("WA", "wheat", "A", 2025, "complete", 100.0, False, 300.0),
            ("WA", "wheat", "B", 2024, "complete", 300.0, True, 400.0), ("WA", "wheat", "B", 2025, "insufficient_season", 300.0, True, 1.0),
            ("WA", "wheat", "C", None, "no_data", 100.0, False, None), ("WA", "wheat", "D", 2024, "complete_to_date", None, False, 9.0), ("WA", "oats", "A", 2024, "complete", 9.0, False, 1.0)]
    got = {r["season_year"]: r for r in SE.weighted_summary(spark.createDataFrame(data, schema), metrics=("rainfall_total_apr_oct_mm",)).collect()}
    assert got[2024]["rainfall_total_apr_oct_mm_wt"] == 350.0 and got[2024]["coverage_share"] == 0.8 and got[2024]["n_sa2s_universe"] == 4
    assert got[2024]["eligible_sa2s"] == "A; B" and got[2024]["fallback_area_sa2s"] == "B" and got[2024]["n_sa2s_complete_no_area"] == 1
    assert got[2025]["rainfall_total_apr_oct_mm_wt"] == 300.0 and got[2025]["excluded_no_data_sa2s"] == "C" and got[2025]["n_sa2s_insufficient_season"] == 1


def test_totals_come_from_members(spark):
    df = spark.createDataFrame([("A", "a", 1.0, 1.0), ("A", "a", 3.0, 3.0), ("A", "b", 10.0, 6.0), (None, "c", 5.0, 2.0), ("B", "d", None, 9.0)], "state string, sd string, v double, w double")
    got = rows(WN.level_totals(df, ["state", "sd"], ["ALL", "all"], ["w"], {"mean": ("v", "w")}, ["v"], ["v"]), "state", "sd", "w", "mean", "min_v", "max_v")
    assert ("A", "all", 10.0, 7.0, 1.0, 10.0) in got and ("A", "a", 4.0, 2.5, 1.0, 3.0) in got and ("ALL", "all", 21.0, 80 / 12, 1.0, 10.0) in got
    assert ("B", "all", 9.0, None, None, None) in got and (None, "all", 2.0, 5.0, 5.0, 5.0) in got and len(got) == 8


def test_fallback_area_says_from_where(spark):
    from furrow.operators import joins
    current = spark.createDataFrame([("r1", "wheat", None), ("r1", "oats", None), ("r2", "wheat", 7.0), ("r3", "wheat", None)], "sa2_code string, crop string, area_ha double")
    corr = spark.createDataFrame([("r1", "o2", "Two", 0.4, "Good"), ("r1", "o1", "One", 0.4, "Good"), ("r1", "o0", "Nil", 0.9, "Poor"), ("r1", "o4", "Four", 0.8, "Good"), ("r3", "o9", "Nine", 1.0, "Good")],
                                 "sa2_code string, region_2011 string, name_2011 string, ratio double, quality string")
    earlier = spark.createDataFrame([("o0", 1.0), ("o1", 11.0), ("o2", 12.0), ("o4", None)], "region_2011 string, estimate double")
    got = rows(joins.fallback_area(current, corr, earlier), "sa2_code", "crop", "area_ha_for_weighting", "area_fallback_reason")
    reason = "Uses 2015-16 ABS fallback area (2011 SA2 'One', ratio=0.4000); 2020-21 wheat area not published (np)"
    assert got == [("r1", "oats", None, ""), ("r1", "wheat", 11.0, reason), ("r2", "wheat", 7.0, ""), ("r3", "wheat", None, "")]


def test_monthly_features_partial_month(spark):
    data = [("WA", "501021007", "X", 2026, m, 10.0, m == 5, 20 if m == 5 else None) for m in range(1, 6)] + [("WA", "501021007", "X", 2025, m, 5.0, False, None) for m in range(1, 13)]
    df = spark.createDataFrame(data, "state_name string, sa2_code string, sa2_name string, year int, month int, rainfall_mm double, is_partial_month boolean, partial_month_through_day int")
    got = {r["season_year"]: r for r in A.season_features_monthly(df, 2026, 5).collect()}
    assert got[2025]["feature_quality_flag"] == "complete" and got[2025]["season_coverage_ratio"] == 1.0 and got[2025]["rainfall_total_may_oct_mm"] == 30.0
    assert got[2026]["feature_quality_flag"] == "complete_to_date" and got[2026]["partial_through_day"] == 20 and got[2026]["sa2_5"] == "51007"
    assert got[2026]["sowing_window_coverage_ratio"] == pytest.approx(50 / 91)


def test_overlay_keeps_base_where_top_is_null(spark):
    base = spark.createDataFrame([(2025, "1", "not_assessed", "monthly_only"), (2025, "2", "not_assessed", "monthly_only")], "season_year int, sa2_5 string, autumn_break_status string, daily_features_status string")
    top = spark.createDataFrame([(2025, "1", "early", 0.9)], "season_year int, sa2_5 string, autumn_break_status string, data_quality_score double")
    got = rows(joins.overlay(base, top, ["season_year", "sa2_5"], ["autumn_break_status", "data_quality_score"]), "sa2_5", "autumn_break_status", "data_quality_score", "daily_features_status")
    assert got == [("1", "early", 0.9, "station_daily"), ("2", "not_assessed", None, "monthly_only")]


def test_crop_context_keeps_suppressed_cells(spark):
    uni = spark.createDataFrame([("A", "5", "500000001"), ("B", "5", None), ("C", "5", None)], "sa2_name string, state_digit string, main_code string")
    labels = spark.createDataFrame([("500000002", "B"), ("500000003", "C"), ("500000004", "C")], "region_code string, region_label string")
    census = spark.createDataFrame([("500000001", "W_A", 10.0, "*"), ("500000001", "B_A", 30.0, ""), ("500000002", "W_A", None, None), ("500000002", "B_A", 4.0, None)],
                                   "region_code string, commodity_code string, estimate double, rse string")
    corr = spark.createDataFrame([("500000002", "old", "Good", 1.0)], "sa2_code string, region_2011 string, quality string, ratio double")
    old = spark.createDataFrame([("old", 7.0)], "region_2011 string, estimate double")
    crops_ = [("wheat", "W_A", "W_P", "W_Y"), ("barley", "B_A", "B_P", "B_Y")]
    got = {(r["sa2_name"], r["crop"]): r for r in RG.build_crop_context(uni, crops_, census, labels, corr, old).collect()}
    assert len(got) == 6 and got["A", "wheat"]["area_share"] == 0.25
    assert got["B", "wheat"]["area_ha"] is None and got["B", "wheat"]["area_ha_for_weighting"] == 7.0 and got["B", "wheat"]["area_is_fallback"]
    assert got["B", "wheat"]["boundary_status"] == "matched_via_label" and got["C", "wheat"]["boundary_status"] == "unmatched"


def test_crop_lookup_refuses_ambiguity(spark):
    df = spark.createDataFrame([("1", "wheat", "2020-21")] * 2, "station_sa2_5dig16 string, crop string, financial_year string")
    with pytest.raises(ValueError, match="several"):
        RG.crop_lookup(df, "1", "wheat", "2020-21")


def test_top_k_and_order(spark):
    df = spark.createDataFrame([("g", i, float(i % 4)) for i in range(10)], "k string, id int, v double")
    assert [r["id"] for r in topk.top_k(df, ["k"], [F.desc("v"), F.asc("id")], 3).orderBy("rank").collect()] == [3, 7, 2]
    assert topk.seeded_sample(df, "id", 4, 1).count() == 4
    assert rows(topk.seeded_sample(df, "id", 4, 1)) == rows(topk.seeded_sample(df, "id", 4, 1))
    assert {r["outlook"] for r in topk.good_middle_bad(df.withColumn("v", F.col("id").cast("double")), "v", "id", 2).collect()} == {"good", "average", "bad"}


def test_sets(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 5)], "k int, b int")
    assert rows(sets.union_sparse(a, b)) == [(1, "x", None), (2, None, 5)]
    assert rows(sets.key_differences(a, b, "k")) == [(1, "left_only"), (2, "right_only")]


@pytest.mark.parametrize("values,want", [
    ([1.0, 2.0, float("nan"), 3.0, 4.0], 2.5), ([1.0, float("-inf"), 7.0], 1.0), ([float("inf"), 5.0, float("inf")], float("inf")),
    ([float("-inf"), float("-inf"), 2.0], float("-inf")), ([float("nan")], None), ([-1.7e308, 1.7e308, 0.0], 0.0)])
def test_exact_median_with_values_that_are_no_numbers(spark, values, want):
    assert A.exact_median(spark.createDataFrame([(v,) for v in values], "v double"), "v") == want


def test_exact_quantiles_of_groups(spark):
    import random

    rng = random.Random(5)
    data = [("a", rng.gauss(0, 1) ** 9) for _ in range(700)] + [("b", float(rng.randint(0, 3))) for _ in range(300)] + [(None, 4.0)] + [
        ("c", float("inf")), ("c", float("-inf")), ("c", 2.0), ("d", None), ("d", float("nan")), ("e", 5e-324), ("e", 1e-323), ("e", 0.0), ("a", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: (r["n"], r["quantiles"]) for r in A.exact_quantiles(df, "v", (0.0, 0.37, 0.5, 1.0), ["k"], buckets=16).collect()}
    assert got.keys() == {"a", "b", "c", "e", None}
    assert got[None] == (1, [4.0] * 4) and got["c"] == (3, [float("-inf"), float("-inf"), 2.0, float("inf")])
    for k in "abe":
        values = sorted(v for key, v in data if key == k and v is not None)
        for q, g in zip((0.0, 0.37, 0.5, 1.0), got[k][1]):
            at = (len(values) - 1) * q
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert g == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12, abs=1e-323)
    assert A.exact_quantiles(df.where("false"), "v", (0.5,), ["k"]).count() == 0


def test_stations_by_state_with_their_total(spark):
    st = spark.createDataFrame([("WA", 1.0, -30.0, 115.0), ("WA", 3.0, -31.0, 116.0), ("SA", 10.0, -34.0, 138.0), ("NT", None, -20.0, 130.0)],
                               "state_name string, cropping_area double, latitude double, longitude double")
    got = rows(RG.station_stats_by_state(st), "state_name", "total_stations", "n_states", "area_p50", "lat_min")
    assert got == [("ALL", 4, 3, 3.0, -34.0), ("NT", 1, 1, None, -20.0), ("SA", 1, 1, 10.0, -34.0), ("WA", 2, 1, 2.0, -31.0)]


def test_membership_universe_and_tiers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(sets.membership(df, keys, "k"), "id", "side") == [(1, "in_target"), (2, "outside"), (3, "outside")]
    facts = spark.createDataFrame([("a", "wheat", 1.0), ("z", "wheat", 2.0), ("a", "rye", 3.0)], "k string, crop string, v double")
    every = sets.with_every(df.where("k IS NOT NULL"), facts, ["k"], "crop", ["wheat", "oats"])
    assert rows(every, "k", "crop", "v") == [("a", "oats", None), ("a", "wheat", 1.0), ("b", "oats", None), ("b", "wheat", None)]
    area = spark.createDataFrame([(1, 5.0), (2, 3.0), (3, 1.0), (4, None)], "id int, area double")
    assert rows(sets.tiers(area, "area", {"high": 5, "low": 3}, "none"), "id", "tier") == [(1, "high"), (2, "low"), (3, "none"), (4, "none")]
    assert rows(sets.tiers(area, "area", {"high": 5, "low": 3}, "none", keep=["low"]), "id") == [(2,)]


def test_extremes_by_two_keys(spark):
    df = spark.createDataFrame([("s", "x", 1, 5.0), ("s", "y", 1, 4.0), ("s", "z", 9, 1.0), ("t", "w", 2, 2.0)], "s string, n string, d int, p double")
    assert rows(topk.extremes(df, ["s"], ["d", "p"], "n")) == [("s", "y", "z"), ("t", "w", "w")]
