import math
import random
import statistics

import pytest
from tests.conftest import rows

from furrow.operators import ranking as R


def decile(values, target):
    below = sum(v < target for v in values)
    return max(1, min(10, math.ceil((below + 1) / len(values) * 10)))


@pytest.mark.parametrize("values,target,below,want", [
    (list(range(1, 22)), 1, 0, 1), (list(range(1, 22)), 21, 20, 10), (list(range(1, 22)), 22, 21, 10), ([5, 5, 5, 5], 5, 0, 3), ([1, None, 3], 2, 1, 10)])
def test_conventions(spark, values, target, below, want):
    base = spark.createDataFrame([("k", None if v is None else float(v)) for v in values], "k string, v double")
    got = R.pairwise_rank(spark.createDataFrame([("k", float(target))], "k string, v double"), base, ["k"], "v").first()
    n = sum(v is not None for v in values)
    assert (got["below"], got["decile"], got["n_hist_years"]) == (below, want, n)
    assert got["percentile_rank"] == pytest.approx(below / n * 100)


def test_empty_baseline_has_no_rank(spark):
    base = spark.createDataFrame([("other", 1.0)], "k string, v double")
    got = R.pairwise_rank(spark.createDataFrame([("k", 2.0)], "k string, v double"), base, ["k"], "v").first()
    assert got["decile"] is None and got["percentile_rank"] is None


SCHEMA = "state_name string, sa2_code string, month int, year int, rainfall_mm double, is_partial_month boolean"


def loo(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA)
    return R.leave_year_out(df, ["state_name", "sa2_code", "month"], **kw)


@pytest.mark.parametrize("years,flag", [(10, "insufficient_history(9)"), (11, "ok")])
def test_history_gate_counts_other_years(spark, years, flag):
    data = [("WA", "1", 5, 2000 + i, float(i), False) for i in range(years)]
    assert {r["climatology_quality_flag"] for r in loo(spark, data).collect()} == {flag}


def test_partial_and_null_rows_stay_out_of_baselines(spark):
    data = [("WA", "1", 5, 2000 + i, 10.0, False) for i in range(11)]
    data += [("WA", "1", 5, 2011, 1000.0, True), ("WA", "1", 5, 2012, None, None)]
    got = {r["year"]: r for r in loo(spark, data).collect()}
    assert got[2011]["climatology_quality_flag"] == "partial_month_no_decile" and got[2011]["rainfall_decile"] is None
    assert got[2012]["climatology_quality_flag"] == "null_rainfall"
    assert got[2000]["historical_year_count"] == 10 and got[2000]["historical_mean_mm"] == 10.0


def test_states_do_not_share_a_code(spark):
    data = [(s, "1", 5, 2000 + i, base + i, False) for s, base in (("WA", 0.0), ("SA", 100.0)) for i in range(12)]
    got = {(r["state_name"], r["year"]): r["rainfall_decile"] for r in loo(spark, data).collect()}
    assert got["WA", 2000] == got["SA", 2000] == 1 and got["WA", 2011] == got["SA", 2011] == 10


def test_zero_median_has_no_percent(spark):
    data = [("WA", "1", 1, 2000 + i, 0.0, False) for i in range(11)] + [("WA", "1", 1, 2011, 5.0, False)]
    got = {r["year"]: r for r in loo(spark, data).collect()}[2011]
    assert got["anomaly_mm"] == 5.0 and got["anomaly_pct"] is None


@pytest.mark.parametrize("baseline", ["others", "prior", (2003, 2012)])
def test_leave_year_out_matches_a_loop(spark, baseline):
    rnd = random.Random(7)
    data = [("WA", str(c), m, y, rnd.choice([None, *range(6)]), rnd.random() < 0.1) for c in range(4) for m in (1, 2) for y in range(2000, 2016)]
    data = [(s, c, m, y, None if v is None else float(v), p) for s, c, m, y, v, p in data]
    for r in loo(spark, data, min_history=3, baseline=baseline).collect():
        keep = {"others": lambda y: True, "prior": lambda y: y < r["year"]}.get(baseline, lambda y: 2003 <= y <= 2012) if not isinstance(baseline, tuple) \
            else (lambda y: baseline[0] <= y <= baseline[1])
        base = [v for _, c, m, y, v, p in data if (c, m) == (r["sa2_code"], r["month"]) and y != r["year"] and not p and v is not None and keep(y)]
        assert r["historical_year_count"] == len(base)
        if r["climatology_quality_flag"] == "ok":
            assert r["historical_median_mm"] == pytest.approx(statistics.median(base))
            assert r["historical_mean_mm"] == pytest.approx(statistics.mean(base))
            assert r["rainfall_decile"] == decile(base, r["rainfall_mm"])


def test_weighted_deciles_match_a_loop_over_masks(spark):
    rnd = random.Random(3)
    regions = {f"r{i}": float(rnd.randint(1, 50)) for i in range(5)}
    data = [("WA", c, 4, y, None if rnd.random() < 0.25 else float(rnd.randint(0, 40)), False) for c in regions for y in range(2000, 2014)]
    weights = spark.createDataFrame([("WA", c, w) for c, w in regions.items()], "state_name string, sa2_code string, weight double")
    got = R.weighted_deciles(spark.createDataFrame(data, SCHEMA), weights, min_history=5).collect()
    assert len(got) == 14
    for r in got:
        here = {c: v for _, c, _, y, v, _ in data if y == r["year"] and v is not None}
        area = sum(regions[c] for c in here)
        total = sum(here[c] * regions[c] for c in here) / area
        assert r["rainfall_mm_wt"] == pytest.approx(total)
        if area / sum(regions.values()) < 0.8:
            assert r["climatology_quality_flag"] == "low_coverage" and r["rainfall_decile"] is None
            continue
        base = []
        for y in range(2000, 2014):
            past = {c: v for _, c, _, yy, v, _ in data if yy == y and v is not None and c in here}
            if y != r["year"] and past:
                base.append(sum(past[c] * regions[c] for c in past) / sum(regions[c] for c in past))
        assert r["historical_year_count"] == len(base)
        assert r["historical_median_mm_wt"] == pytest.approx(statistics.median(base))
        assert r["rainfall_decile"] == decile(base, total)


def test_cell_percentile_ties_clamp_and_missing(spark):
    data = [(c, 5, 2000 + i, v) for c, vals in ((1, [1.0, 2.0, 3.0, 4.0]), (2, [None] * 4), (3, [5.0, 5.0, 5.0, 5.0])) for i, v in enumerate(vals)]
    data += [(1, 5, 2010, 9.0), (2, 5, 2010, 1.0), (3, 5, 2010, 5.0), (4, 5, 2010, None), (4, 5, 2000, 1.0)]
    got = {r["cell_id"]: r["percentile"] for r in R.cell_percentiles(spark.createDataFrame(data, "cell_id int, month int, year int, mm double"), 5, 2010, 2000, 2003).collect()}
    assert got == {1: 100.0, 2: None, 3: 25.0, 4: None}


def test_grid_class_needs_every_year(spark):
    data = [(1, 5, 2000 + i, float(i)) for i in range(4)] + [(1, 5, 2004, 9.0), (2, 5, 2000, 1.0), (2, 5, 2004, 0.5)]
    got = rows(R.grid_decile_class(spark.createDataFrame(data, "cell_id int, month int, year int, mm double"), 5, 2004, 2000, 2003), "cell_id", "decile_class")
    assert got == [(1, 6)]


def test_duplicate_keys_are_refused(spark):
    df = spark.createDataFrame([(1, 2000), (1, 2000)], "k int, year int")
    with pytest.raises(ValueError, match="duplicate"):
        R.require_unique(df, ["k", "year"])
