"""Registered queries against their SQL twins on the smallest data set, and plan checks."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents").split()
SAMPLE = ("i1_detect_events", "e1_rolling_total_station", "e10_deciles_other_years", "e11_weighted_deciles", "d8_season_features_station", "d24_sd_review",
          "c14_points_in_polygons", "c3_nearest_station", "i16_sowing_pressure", "i21_vintage_audit", "a11_upsert_last_wins", "j3_stream_rolling_totals")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="warehouse tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


# runs: the fold and the exchange on blocks, each shown twice and reused at run time, and the summaries by station
@pytest.mark.parametrize("name,exchanges", [("e5_consecutive_runs", 5), ("d8_season_features_station", 2), ("e1_rolling_total_station", 2)])
def test_one_exchange_beyond_the_daily_fold(spark, name, exchanges):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == exchanges


@pytest.mark.parametrize("name", ["c14_points_in_polygons", "c4_far_from_stations", "c3_nearest_station", "e11_weighted_deciles", "c12_as_of_guide"])
def test_no_nested_loops(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
