import datetime as dt
import random

import pytest
from tests.conftest import day, rows

from furrow.operators import timeseries as T
from furrow.plans import events as E

OBS = "station_id string, date date, min_temp double, max_temp double, rainfall double, min_temp_quality int, max_temp_quality int, rainfall_quality int"


def frame(spark, data):
    return spark.createDataFrame(data, "station_id string, date date, rainfall double")


def daily(start, values, station="s"):
    return [(station, day(start) + dt.timedelta(i), v) for i, v in enumerate(values)]


@pytest.mark.parametrize("block", [5, 16, 512])
def test_rolling_matches_a_loop_across_blocks(spark, block):
    rnd = random.Random(block)
    data = [(s, day("2020-01-01") + dt.timedelta(i), rnd.choice([None, 0.0, 1.5, 4.0])) for s in ("a", "b") for i in range(60) if rnd.random() > 0.08]
    got = {(r["station_id"], r["date"]): r for r in T.rolling_totals(frame(spark, data), (3, 5), block_days=block).collect()}
    assert len(got) == len(data)
    for s, d, _ in data:
        for n in (3, 5):
            win = [v for s2, d2, v in data if s2 == s and d - dt.timedelta(n - 1) <= d2 <= d]
            valid = [v for v in win if v is not None]
            want = sum(valid) if len(win) >= n and len(valid) >= n * 0.8 else None
            assert got[s, d][f"total_{n}d"] == want


def test_eighty_percent_gate(spark):
    values = [1.0] * 8 + [None] * 2
    got = {r["date"]: r["total_10d"] for r in T.rolling_totals(frame(spark, daily("2020-01-01", values)), (10,)).collect()}
    assert got[day("2020-01-10")] == 8.0
    values = [1.0] * 7 + [None] * 3
    got = {r["date"]: r["total_10d"] for r in T.rolling_totals(frame(spark, daily("2020-01-01", values)), (10,)).collect()}
    assert got[day("2020-01-10")] is None


def test_runs_keep_the_last_night_of_every_run(spark):
    dates = ["2026-08-01", "2026-08-02", "2026-08-03", "2026-08-06", "2026-08-08", "2026-08-09"]
    df = spark.createDataFrame([("s", day(d)) for d in dates], "station_id string, date date")
    got = rows(T.consecutive_runs(df), "date", "run_position", "run_length", "sequence_id")
    assert [g[1:] for g in got] == [(1, 3, "s_seq_1"), (2, 3, "s_seq_1"), (3, 3, "s_seq_1"), (1, 1, None), (1, 2, "s_seq_3"), (2, 2, "s_seq_3")]


@pytest.mark.parametrize("block", [1, 3, 7, 512])
def test_runs_cross_blocks(spark, block):
    rnd = random.Random(block)
    data = [(s, day("2020-01-01") + dt.timedelta(i)) for s, p in (("a", 0.9), ("b", 0.5), ("c", 1.0)) for i in range(40) if rnd.random() < p]
    data += [("d", day("1965-12-30")), ("d", day("1965-12-31")), ("d", day("2020-01-01"))]
    want, last = {}, {}
    for s, d in sorted(data):
        run = last[s][1] if s in last and (d - last[s][0]).days == 1 else []
        number = last[s][2] + (not run) if s in last else 1
        run.append(d)
        last[s] = (d, run, number)
        want[s, d] = (len(run), run, number)
    got = T.consecutive_runs(spark.createDataFrame([(*r, 1) for r in data], "station_id string, date date, _n int").drop("_n"), block_days=block).collect()
    assert len(got) == len(data)
    for r in got:
        position, run, number = want[r["station_id"], r["date"]]
        assert (r["run_position"], r["run_length"], r["sequence_id"]) == (position, len(run), f"{r['station_id']}_seq_{number}" if len(run) > 1 else None)


def test_a_range_takes_up_the_open_run(spark):
    data = [("s", day("2026-09-01") + dt.timedelta(i), 0.0, 20.0, 0.0, 0, 0, 0) for i in range(40)]
    obs = spark.createDataFrame(data, OBS)
    whole = {(r["date"], r["event_type"], r["severity"]): r for r in E.detect_events(obs, detected_at="2026-10-01").collect()}
    part = E.detect_events(obs, "2026-09-25", "2026-09-30", detected_at="2026-10-01").where("event_type = 'frost'").orderBy("date").collect()
    assert [r["consecutive_night"] for r in part] == [25, 26, 27, 28, 29, 30] and {r["sequence_id"] for r in part} == {"s_seq_1"}
    assert all(whole[r["date"], "frost", r["severity"]] == r for r in part)


def test_gaps_of_one_and_three_days(spark):
    df = spark.createDataFrame([("s", day(d)) for d in ("2026-01-01", "2026-01-02", "2026-01-04", "2026-01-08")], "station_id string, date date")
    assert [r[3] for r in rows(T.date_gaps(df))] == [1, 3]


def season(spark, events):
    data = [("s", day("2026-01-01") + dt.timedelta(i), 0.0) for i in range(365)]
    data = [(s, d, events.get(d.isoformat(), v)) for s, d, v in data]
    return T.autumn_break(frame(spark, data)).first()


@pytest.mark.parametrize("events,date,status", [
    ({}, None, "absent"), ({"2026-05-01": 10.0}, "2026-05-01", "early"), ({"2026-06-20": 30.0}, "2026-06-20", "late"),
    ({f"2026-05-{d:02d}": 5.0 for d in range(14, 20)}, "2026-05-18", "on_time"), ({"2026-03-31": 9.9, "2026-04-01": 9.9, "2026-03-30": 9.9}, None, "absent")])
def test_autumn_break(spark, events, date, status):
    got = season(spark, events)
    assert (got["autumn_break_date"] and got["autumn_break_date"].isoformat(), got["autumn_break_status"]) == (date, status)


def test_dry_spells_look_only_inside_april_to_october(spark):
    data = daily("2026-03-01", [0.0] * 45)
    got = T.dry_spell_days(frame(spark, data)).first()
    # the slice starts on 1 April, so the first full week ends on 7 April
    assert got["dry_spell_days_7d_lt_5mm"] == 14 - 6 and got["dry_spell_days_14d_lt_10mm"] == 1


def test_full_season_is_complete(spark):
    data = [("s", day("2025-01-01") + dt.timedelta(i), 2.0, 0) for i in range(365)]
    df = spark.createDataFrame(data, "station_id string, date date, rainfall double, rainfall_quality int")
    f = T.season_features(df).first()
    assert f["feature_quality_flag"] == "complete" and f["rainfall_total_apr_oct_mm"] == 428.0 and f["monthly_rainfall_feb_mm"] == 56.0
    assert f["season_coverage_ratio"] == 1.0 and f["data_quality_score"] == 1.0


def test_season_in_progress_and_missing_codes(spark):
    data = [("s", day("2026-01-01") + dt.timedelta(i), 2.0, 999 if i < 10 else 15) for i in range(150)] + [("DD_1_2", day("2026-01-01"), 1.0, 0)]
    df = spark.createDataFrame(data, "station_id string, date date, rainfall double, rainfall_quality int")
    f = T.season_features(df).collect()
    assert len(f) == 1 and f[0]["feature_quality_flag"] == "complete_to_date"
    assert f[0]["monthly_rainfall_jan_mm"] is None and f[0]["monthly_rainfall_feb_mm"] == 56.0


def obs(spark, data):
    return spark.createDataFrame(data, OBS)


def test_events_by_type(spark):
    rows_ = [("1", day("2026-09-05") + dt.timedelta(i), -3.0, 20.0, 0.0, 0, 0, 15) for i in range(8)]
    rows_ += [("2", day("2026-11-01"), 5.0, 36.0, 0.0, 0, 25, 0), ("3", day("2026-11-20"), 5.0, 20.0, 12.0, 0, 0, 0), ("3", day("2026-11-21"), 5.0, 20.0, 2.0, 0, 0, 0),
              ("3", day("2026-11-22"), 5.0, 20.0, 2.0, 0, 0, 0)]
    ev = E.detect_events(obs(spark, rows_))
    got = {(r["event_type"], r["severity"], r["accumulation_window"]): r for r in ev.collect()}
    frost = got["frost", "severe", None]
    assert frost["crop_stage"] == "flowering" and frost["threshold"] == -3.0 and frost["phenology_risk_multiplier"] == 3.0
    assert got["heat", "severe", None]["confidence"] == 0.7
    assert got["rainfall", "moderate", 1]["value"] == 12.0 and got["rainfall", "high", 3]["value"] == 16.0
    assert got["development_rain", "dry_spell", 7]["confidence"] == 0.8
    assert ev.where("event_type = 'development_rain' AND severity = 'moisture_stress'").count() == 0


def test_seeding_dryness_counts_only_from_may(spark):
    april = [("1", day("2026-04-01") + dt.timedelta(i), 5.0, 20.0, 0.0, 0, 0, 0) for i in range(40)]
    got = {(r["date"].month, r["crop_type"], r["severity"]) for r in E.seeding_events(obs(spark, april)).collect()}
    assert got == {(5, "wheat_barley", "inadequate"), (5, "lupins", "inadequate")}


def test_severe_tier_is_off_by_default(spark):
    wet = [("1", day("2026-12-01") + dt.timedelta(i), 5.0, 20.0, 12.0, 0, 0, 0) for i in range(3)]
    assert E.harvest_rain_events(obs(spark, wet)).where("severity = 'severe'").count() == 0
    assert E.harvest_rain_events(obs(spark, wet), severe_tier=True).where("severity = 'severe'").count() == 1


def test_windows_longer_than_a_time_block(spark):
    df = spark.sql("SELECT 'a' AS station_id, date_add(DATE '1990-01-01', CAST(id AS INT)) AS date, 1.0D AS rainfall FROM range(2400)")
    out = T.rolling_totals(df, (7, 800)).where("total_800d IS NOT NULL")
    assert out.count() == 1601 and out.where("total_800d <> 800").count() == 0
