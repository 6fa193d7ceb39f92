import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from tests.conftest import day, rows

from furrow.plans import quality as Q
from furrow.plans import vintage as V
from furrow.session import scratch_path
from furrow.sources import readers, sinks
from furrow.streaming import jobs as J

KEYED = "station_id string, date date, rainfall double, ingested_at timestamp"


def batch(spark, *data):
    return spark.createDataFrame([(s, day(d), v, dt.datetime.fromisoformat(t)) for s, d, v, t in data], KEYED)


def test_upsert_is_idempotent_and_last_wins(spark):
    path = scratch_path(spark, "t")
    first = batch(spark, ("a", "2025-12-31", 1.0, "2026-01-01"), ("a", "2026-01-01", 2.0, "2026-01-01"), ("b", "2026-01-01", 3.0, "2026-01-01"))
    sinks.upsert(first, path)
    newer = batch(spark, ("a", "2026-01-01", 9.0, "2026-01-02"), ("c", "2026-01-01", 5.0, "2026-01-02"), ("b", "2026-01-01", 0.0, "2025-01-01"))
    for _ in range(2):
        sinks.upsert(newer, path)
    got = rows(spark.read.parquet(path), "station_id", "date", "rainfall")
    assert got == [("a", day("2025-12-31"), 1.0), ("a", day("2026-01-01"), 9.0), ("b", day("2026-01-01"), 3.0), ("c", day("2026-01-01"), 5.0)]


def test_large_months_are_merged_in_slices(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_A_SLICE", 50)
    path = scratch_path(spark, "sliced")
    data = [(f"s{i}", "2026-01-01", float(i), "2026-02-01") for i in range(900)] + [("s1", "2026-02-01", 1.0, "2026-02-01")]
    sinks.upsert(batch(spark, *data, *data[:300]), path)
    newer = [(f"s{i}", "2026-01-01", -1.0, "2026-02-02") for i in range(0, 900, 3)]
    sinks.upsert(batch(spark, *newer), path)
    got = spark.read.parquet(path)
    want = [(s, day(d), -1.0 if d == "2026-01-01" and int(s[1:]) % 3 == 0 else v) for s, d, v, _ in data]
    assert rows(got, "station_id", "date", "rainfall") == sorted(want, key=repr)
    held = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(held) > 8 and max(held) < 300


def test_replace_date_touches_only_that_date(spark):
    path = scratch_path(spark, "r")
    sinks.replace_dates(batch(spark, ("a", "2026-01-01", 1.0, "2026-01-01"), ("b", "2026-01-02", 2.0, "2026-01-01")).drop("ingested_at"), path)
    sinks.replace_dates(batch(spark, ("z", "2026-01-02", 7.0, "2026-01-01")).drop("ingested_at"), path)
    assert rows(spark.read.parquet(path), "station_id", "rainfall") == [("a", 1.0), ("z", 7.0)]


def test_raw_feed_is_normalised(spark):
    raw = spark.createDataFrame([("8137", "2026-01-01", 1.5, 25), ("8137", "file made by", None, 0), ("DD_-31_117", "2026-01-02", 0.0, 0)],
                                "station_id string, `YYYY-MM-DD` string, daily_rain double, daily_rain_source int")
    got = rows(Q.normalise_raw(raw), "station_id", "rainfall", "rainfall_quality", "min_temp", "min_temp_quality", "min_temp_source")
    assert got == [("008137", 1.5, 25, None, 999, "missing"), ("DD_-31_117", 0.0, 0, None, 999, "missing")]
    missing, counts = Q.validate_feed(raw)
    assert missing == ["max_temp", "min_temp"] and counts.first()["daily_rain_observed"] == 2


def obs(spark, codes):
    data = [("s", day("2026-01-01") + dt.timedelta(i), 1.0, 1.0, 1.0, c, c, c) for i, c in enumerate(codes)]
    return spark.createDataFrame(data, readers.OBSERVATIONS)


@pytest.mark.parametrize("codes,score,cls", [([0] * 10, 1.0, "high"), ([0] * 7 + [35] * 3, 0.49, "poor"), ([15] * 10, 0.15, "poor"), ([0] * 3 + [25] * 7, 1.0, "high")])
def test_confidence_penalties(spark, codes, score, cls):
    got = Q.quality_report(obs(spark, codes)).first()
    assert got["confidence_score"] == pytest.approx(score) and got["overall_quality"] == cls


def test_value_not_row_is_dropped(spark):
    got = Q.filter_values(obs(spark, [0, 35, 999, 23, 15]), accept_interpolated=False)
    assert [r["rainfall"] for r in got.orderBy("date").collect()] == [1.0, None, None, 1.0, None]


def test_bad_number_fails_and_blank_is_null(spark):
    path = scratch_path(spark, "crops")
    spark.createDataFrame([("1", "11060", "wheat", ""), ("2", "11061", "", "5.5")], "sa2_code string, station_sa2_5dig16 string, crop string, area_ha string").write.csv(path, header=True)
    assert rows(readers.read_crop_context(spark, path), "crop", "area_ha") == [("wheat", None), (None, 5.5)]
    bad = scratch_path(spark, "bad")
    spark.createDataFrame([("1", "11060", "wheat", "np")], "sa2_code string, station_sa2_5dig16 string, crop string, area_ha string").write.csv(bad, header=True)
    with pytest.raises(Exception):
        readers.read_crop_context(spark, bad).collect()
    with pytest.raises(ValueError, match="lacks columns"):
        readers.read_crop_context(spark, path, required=("yield_t_ha",))


def test_grid_checks(spark):
    whole = [(c, y, m, 1.0) for c in (1, 2) for y in (2000, 2001) for m in range(1, 13)]
    schema = "cell_id int, year int, month int, mm double"
    assert readers.read_grid(spark.createDataFrame(whole + [(c, 2002, 5, 1.0) for c in (1, 2)], schema), 5, 2002, 2000, 2001).count() == 6
    with pytest.raises(ValueError, match="incomplete"):
        readers.read_grid(spark.createDataFrame([r for r in whole if r[1:3] != (2001, 7)] + [(1, 2002, 5, 1.0)], schema), 5, 2002, 2000, 2001)
    with pytest.raises(ValueError, match="coordinates"):
        readers.read_grid(spark.createDataFrame(whole + [(1, 2002, 5, 1.0)], schema), 5, 2002, 2000, 2001)


BLOCK = "\n```vintage\nstatus: {s}\nreport_date: 2026-05-20\ncoverage_month: 2026-05\nthrough_day: 19\nbaseline_years: [2005, 2025]\ndecile_method: rank_ceil_v1\n{x}```\n"


def test_report_audit(spark):
    ok = "Data through 2026-05-19, 19 of 31 days; May 13-19 front; dry to day 27." + BLOCK.format(s="frozen", x="")
    reports = {1: ok, 2: ok.replace("19 of 31", "27 of 31") + " x / 10", 3: "no block", 4: ok.replace("coverage_month: 2026-05\n", ""),
               5: ok.replace("frozen", "live"), 6: "a" * 50000 + " through day 7 " + BLOCK.format(s="live", x="inputs: [mtd, other]\n")}
    df = spark.createDataFrame(list(reports.items()), "report_id int, markdown string")
    hist = spark.createDataFrame([(2026, 5, 31)], "year int, month int, partial_month_through_day int")
    got = rows(V.audit(df, V.current_through_days(hist, "mtd")))
    assert got == sorted([
        (2, "prose coverage-day 27 does not match through_day 19"), (2, "prose contains '/ 10'"), (3, "missing vintage block"), (4, "missing required field 'coverage_month'"),
        (5, "live report must list 'inputs'"), (6, "prose coverage-day 7 does not match through_day 19"), (6, "live through_day 19 differs from current 31 in mtd"),
        (6, "cannot determine current through_day in other")], key=repr)


def test_blocks_in_list_form_and_other_months(spark):
    block = "\n```vintage\n# pinned\nstatus: 'live'  # for now\nreport_date: 2026-07-01\ncoverage_month: \"2026-06\"\nthrough_day: 19\nbaseline_years:\n  - 2005\n  - 2025\ninputs:\n- a.csv # first\n  # none here\n  - \"b.csv\"\ndecile_method: rank_ceil_v1\n```\n"
    texts = {1: "June 1–19, 19 of 30 days; Coverage through 2026-06-19; May 1-7; 8 of 31 days; Data through 2026-05-09." + block, 2: "June 1-18." + block,
             3: block.replace("inputs:\n- a.csv # first\n  # none here\n  - \"b.csv\"\n", "inputs: []\n"), 4: "```vintage\n\n```", 5: None, 6: ""}
    df = spark.createDataFrame(list(texts.items()), "report_id int, markdown string")
    parsed = {r["report_id"]: r for r in V.parse_blocks(df).withColumn("claims", V.coverage_days()).collect()}
    assert parsed[1]["inputs"] == ["a.csv", "b.csv"] and parsed[1]["claims"] == [19] and parsed[2]["claims"] == [18]
    assert (parsed[1]["status"], parsed[1]["coverage_month"], parsed[1]["baseline_years"]) == ("live", "2026-06", "[2005, 2025]")
    current = spark.createDataFrame([("a.csv", "2026-06", 19), ("b.csv", "2026-06", 20)], "input string, coverage_month string, current_through_day int")
    got = rows(V.audit(df.where("report_id < 4"), current))
    assert got == sorted([(1, "live through_day 19 differs from current 20 in b.csv"), (2, "live through_day 19 differs from current 20 in b.csv"),
                          (2, "prose coverage-day 18 does not match through_day 19"), (3, "live report must list 'inputs'")], key=repr)


def test_late_rows_replace_their_date_and_replays_change_nothing(spark):
    landing, table, ledger = scratch_path(spark, "land"), scratch_path(spark, "table"), scratch_path(spark, "ledger")
    first = batch(spark, ("a", "2026-01-01", 1.0, "2026-02-01"), ("b", "2026-01-01", 2.0, "2026-02-01"), ("a", "2026-02-01", 3.0, "2026-02-01"), ("b", "2026-02-01", 4.0, "2026-02-01"))
    second = batch(spark, ("a", "2026-02-01", 9.0, "2026-02-02"), ("a", "2026-02-02", 5.0, "2026-02-02"), ("b", "2026-01-01", 7.0, "2026-02-02"))
    write = J.late_data_writer(table, ledger)
    for number, rows_ in ((0, first), (1, second), (1, first), (0, second)):
        write(rows_, number)
    want = [("a", day("2026-02-01"), 9.0), ("a", day("2026-02-02"), 5.0), ("b", day("2026-01-01"), 7.0), ("b", day("2026-02-01"), 4.0)]
    assert rows(spark.read.parquet(table), "station_id", "date", "rainfall") == want
    first.coalesce(1).write.parquet(landing)
    J.start_late_data(J.read_stream(spark, landing, first.schema), table, ledger, scratch_path(spark, "ckpt")).awaitTermination()
    assert rows(spark.read.parquet(table), "station_id", "date", "rainfall") == want


def test_first_event_log_without_events(spark):
    path = scratch_path(spark, "log")
    none = spark.createDataFrame([], "station_id string, date date, event_type string")
    sinks.write_by_type(none, path, [day("2026-01-01")])
    sinks.write_by_type(spark.createDataFrame([("a", day("2026-01-01"), "frost"), ("a", day("2026-01-02"), "frost")], none.schema), path, [day("2026-01-01"), day("2026-01-02")])
    sinks.write_by_type(none, path, [day("2026-01-01")])
    assert rows(spark.read.parquet(path).select("date")) == [(day("2026-01-02"),)]


def test_ingest_reads_the_feed_once_and_ends_in_the_table(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    data = [("1", f"2026-01-{d:02d}", float(d), 0, 5.0, 0, 20.0, 0) for d in range(1, 11)] + [("2", f"2026-01-{d:02d}", 1.0, 999, 1.0, 999, 1.0, 999) for d in range(1, 5)]
    schema = "station_id string, `YYYY-MM-DD` string, daily_rain double, daily_rain_source int, min_temp double, min_temp_source int, max_temp double, max_temp_source int"
    raw = spark.createDataFrame(data, schema)
    raw = raw.mapInArrow(counted, raw.schema)
    path = scratch_path(spark, "ingest")
    got = Q.ingest(raw, f"{path}/t", f"{path}/q", f"{path}/runs", "r1", "2026-01-11 00:00:00", 0.5)
    assert got == {"records": 14, "accepted": 10, "stations": 1} and read.value == 14
    Q.ingest(raw, f"{path}/t", f"{path}/q", f"{path}/runs", "r1", "2026-01-11 00:00:00", 0.5)
    assert spark.read.parquet(f"{path}/t").count() == 10 and spark.read.parquet(f"{path}/q").count() == 4
    assert rows(spark.read.parquet(f"{path}/runs"), "run_id", "stations", "records") == [("r1", 1, 10)] * 2


def test_ingest_judges_rows_without_sorting_them(spark, monkeypatch):
    plans, parquet = [], DataFrameWriter.parquet

    def spied(self, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return parquet(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    raw = spark.createDataFrame([("1", "2026-01-01", 1.0, 0), ("2", "2026-01-01", 1.0, 999)], "station_id string, `YYYY-MM-DD` string, daily_rain double, daily_rain_source int")
    path, most = scratch_path(spark, "ingest"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        Q.ingest(raw, f"{path}/t", f"{path}/q", f"{path}/runs", "r1", "2026-01-11 00:00:00", 0.1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    judged = next(p for p in plans if "Join" in p)
    assert "ShuffledHashJoin" in judged and "Sort " not in judged


def test_stream_rolling_equals_batch(spark):
    from furrow.operators.timeseries import rolling_totals
    data = [(s, day("2026-01-01") + dt.timedelta(i), float(i % 5)) for s in ("a", "b") for i in range(20) if not (s == "b" and i == 7)]
    landing = scratch_path(spark, "land")
    df = spark.createDataFrame(data, "station_id string, date date, value double")
    df.select("station_id", F.col("date").cast("timestamp").alias("event_time"), "value").write.parquet(landing)
    s = J.read_stream(spark, landing, spark.read.parquet(landing).schema)
    got = J.run_to_files(J.rolling(s, 3), "roll").where("total IS NOT NULL AND date <= DATE'2026-01-17'")
    want = rolling_totals(df, (3,), value="value").where("total_3d IS NOT NULL AND date <= DATE'2026-01-17'")
    assert rows(got, "station_id", "date", "total") == rows(want, "station_id", "date", "total_3d")


def test_stream_ingest_drops_repeats(spark):
    landing, table = scratch_path(spark, "land"), scratch_path(spark, "table")
    b = batch(spark, ("a", "2026-01-01", 1.0, "2026-01-01"), ("a", "2026-01-01", 1.0, "2026-01-01"), ("b", "2026-01-02", 2.0, "2026-01-02")).withColumn("event_time", F.col("ingested_at"))
    b.write.parquet(landing)
    for _ in range(2):
        J.start_ingest(J.deduplicated(J.read_stream(spark, landing, b.schema)), table, scratch_path(spark, "ckpt")).awaitTermination()
    assert rows(spark.read.parquet(table), "station_id", "rainfall") == [("a", 1.0), ("b", 2.0)]


def test_positions_in_open_runs_after_every_delivery(spark):
    from furrow.operators.timeseries import consecutive_runs
    schema = "station_id string, event_time timestamp"
    at = lambda s, d: (s, dt.datetime.fromisoformat(d + "T05:00:00"))
    deliveries = [
        [at("a", "2026-05-01"), at("a", "2026-05-02"), at("a", "2026-05-02"), at("b", "2026-05-02"), (None, None)],
        [at("a", "2026-05-03"), at("b", "2026-05-04")],  # goes on with an open run; leaves a gap
        [at("b", "2026-05-03"), at("a", "2026-05-09")],  # fills that gap within the delay
        [at("c", "2026-05-20")],
        [],
    ]
    landing, out, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "positions"), scratch_path(spark, "ckpt")
    seen = []
    for new in deliveries:
        seen += [r for r in new if r[0]]
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = J.run_positions(J.read_stream(spark, landing, spark.createDataFrame([], schema).schema))
        J.append_updates(stream, out, checkpoint)
        nights = spark.createDataFrame(seen, schema).select("station_id", F.to_date("event_time").alias("date")).distinct()
        want = consecutive_runs(nights).select("station_id", "date", "run_position", "run_length")
        assert rows(J.latest_versions(stream, out, ("station_id", "date"))) == rows(want)
    # far behind the watermark: dropped, and the closed run stays as it was
    spark.createDataFrame([at("a", "2026-05-04")], schema).coalesce(1).write.mode("append").parquet(landing)
    J.append_updates(J.run_positions(J.read_stream(spark, landing, spark.createDataFrame([], schema).schema)), out, checkpoint)
    assert rows(J.latest_versions(stream, out, ("station_id", "date"))) == rows(want)


def test_report_finds_gaps_across_words_of_days(spark):
    import random

    rng, base = random.Random(3), day("1969-11-20")  # days before and after the epoch
    record = {s: sorted(rng.sample(range(400), n)) for s, n in (("a", 390), ("b", 30), ("c", 1))}
    record["d"] = [*range(100), *range(300, 310)]
    data = [(s, base + dt.timedelta(i), 1.0, 1.0, 1.0, 0, 0, 0) for s, days in record.items() for i in days for _ in range(1 + i % 2)]
    data += [("a", None, 1.0, 1.0, 1.0, 999, 999, 999), ("e", None, 1.0, 1.0, 1.0, 0, 0, 0), (None, base, 1.0, 1.0, 1.0, 0, 0, 0)]
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in readers.OBSERVATIONS)
    report = Q.quality_report(spark.createDataFrame(data, nullable))
    got = {r["station_id"]: r for r in report.collect()}
    assert got.keys() == {*"abcde"}
    for s, days in record.items():
        gaps = [b - a - 1 for a, b in zip(days, days[1:]) if b - a > 1]
        assert (got[s]["n_gaps"], got[s]["missing_days"]) == (len(gaps), sum(gaps))
        assert (got[s]["first_date"], got[s]["last_date"]) == (base + dt.timedelta(days[0]), base + dt.timedelta(days[-1]))
    assert (got["e"]["first_date"], got["e"]["n_gaps"], got["e"]["missing_days"]) == (None, 0, 0)
    assert got["a"]["record_count"] == sum(1 + i % 2 for i in record["a"]) + 1


def test_report_scans_once(spark, tmp_path):
    path = str(tmp_path / "obs")
    obs(spark, [0] * 10).write.parquet(path)
    plan = Q.quality_report(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") + plan.count("FileScan") <= 2 and "Join" not in plan


def test_season_summary(spark):
    from furrow.plans import digest as D

    data = [("a", day("2026-01-05"), "heat", "high", 41.0), ("b", day("2026-01-05"), "heat", "low", 36.0), ("a", day("2026-06-01"), "frost", "light", -1.0),
            ("b", day("2026-06-02"), "frost", "severe", -4.0), ("b", day("2026-07-02"), "development_rain", "dry_spell", 0.0), ("b", day("2025-07-02"), "frost", "severe", -9.0)]
    got = D.season_summary(spark.createDataFrame(data, "station_id string, date date, event_type string, severity string, value double"), 2026, 1).collect()
    assert {(r["month"], r["event_type"]): r["n_events"] for r in got if r["section"] == "month"} == {
        (1, "heat"): 2, (6, "frost"): 2, (7, "development_rain"): 1, (1, None): 2, (6, None): 2, (7, None): 1, (None, "heat"): 2, (None, "frost"): 2,
        (None, "development_rain"): 1, (None, None): 5}
    assert {(r["event_type"], r["station_id"], r["value"]) for r in got if r["section"] == "peak"} == {("heat", "a", 41.0), ("frost", "b", -4.0)}
    assert [(r["section"], r["rank"], r["station_id"], r["n_events"]) for r in got if r["section"] in ("stressed", "top")] == [("stressed", None, "b", 1), ("top", 1, "b", 3)]
