"""Cleaning, idempotent load, snapshot, run log, report."""

import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from zonewatch.functions import times
from zonewatch.operators import clean, daily, history
from zonewatch.plans import etl, report
from zonewatch.sensors import POLLUTION, SENSORS, TRAFFIC
from zonewatch.sources import tables


def message(minute, device="d1", zone="a", day=1, **fields):
    body = {"timestamp": f"2024-01-{day:02d}T08:{minute:02d}:00.000000+00:00", "device_id": device, "zone": zone}
    return {"type": "pollution", "co2_ppm": 400.0, "pm25": 5.0, "air_quality_index": 50} | body | fields


def put(root, sensor, messages, name="part"):
    folder = root / sensor
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages))


def load(spark, tmp_path, names=("pollution",)):
    return etl.run_all(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), names)


def processed(spark, tmp_path, name="pollution"):
    return tables.processed(spark, str(tmp_path / "lake"), name)


def test_copies_collapse_to_the_fullest_row_in_any_order(spark):
    schema = POLLUTION.schema
    copies = [("t", "d", "a", "pollution", None, 5.0, 9), ("t", "d", "a", "pollution", 400.0, 5.0, None),
              ("t", "d", "a", "pollution", 400.0, 5.0, 7)]
    for data in (copies, copies[::-1], copies[1:] + copies[:1]):
        df = spark.createDataFrame(data, schema)
        (only,) = rows(clean.one_per_key(df, ("timestamp", "device_id"), POLLUTION.required))
        assert (only["co2_ppm"], only["air_quality_index"]) == (400.0, 7)


def test_copies_of_a_hot_key_collapse_before_the_shuffle(spark):
    """A third of all rows share one key; each task must send one row for it."""
    base = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("timestamp"),
        F.lit("d").alias("device_id"),
        F.lit(1.0).alias("co2_ppm"),
        F.lit(1.0).alias("pm25"),
        F.col("id").alias("n"),
    )
    found = clean.one_per_key(base, ("timestamp", "device_id"), POLLUTION.required)
    assert found.count() == 20001
    assert rows(found.filter("timestamp = 'hot'"))[0]["n"] == 29997
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert plan.index("functions=[max") < plan.index("Exchange") < plan.index("partial_max")


def test_rejects_name_their_reason(spark):
    schema = POLLUTION.schema
    data = [(None,) * 7, ("2024-01-01T00:00:00Z", None, "a", "p", 1.0, 1.0, 1), (None, "d", "a", "p", 1.0, 1.0, 1),
            ("bad", "d", "a", "p", 1.0, 1.0, 1), ("2024-01-01T00:00:00Z", "d", None, "p", 1.0, 1.0, 1)]
    tagged = clean.tagged(spark.createDataFrame(data, schema))
    assert sorted(r["reject_reason"] for r in rows(clean.rejects(tagged))) == [
        "bad_time", "no_device", "no_time", "unreadable",
    ]
    (kept,) = rows(clean.without_rejects(tagged, POLLUTION))
    assert kept["zone"] is None and kept["date_partition"] == date(2024, 1, 1)


def test_known_keys_are_not_new(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "a"), ("2", "b")], "timestamp string, device_id string")
    known = spark.createDataFrame([("2", "a"), ("2", "a")], df.schema)
    assert sorted(map(tuple, clean.new_rows(df, known).collect())) == [("1", "a"), ("2", "b")]
    assert clean.new_rows(df, None).count() == 3


def test_day_filter_reads_exactly_the_days(spark, tmp_path):
    """The same form for any number of days: here every second one of 1,600, whose partitions alone are read."""
    df = spark.range(1600).select(F.expr("date_add(date'2000-01-01', cast(id as int))").alias("date_partition"), "id")
    assert clean.on_days(df, df.limit(0)).count() == 0
    assert clean.on_days(df, df.filter("id IN (10, 11, 500)")).count() == 3
    assert clean.on_days(df, df.filter("id % 2 = 0")).count() == 800
    df.filter("id < 40").write.partitionBy("date_partition").parquet(str(tmp_path / "t"))
    df.filter("id IN (3, 7)").write.parquet(str(tmp_path / "days"))
    found = clean.on_days(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "days")))
    assert found.count() == 2
    assert "dynamicpruning" in spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")


def test_a_load_over_many_days_touches_exactly_its_days(spark, tmp_path):
    stamp = "2000-01-01"
    def lines(step):  # noqa: ANN001, ANN202
        days = spark.range(0, 1500, step).select(F.expr(f"date_add(date'{stamp}', cast(id as int))").cast("string").alias("d"))
        return days.select(F.concat(F.lit('{"timestamp":"'), "d", F.lit('T08:00:00Z","device_id":"x"%s}')).alias("value"))
    body = ',"zone":"a","co2_ppm":1.0,"pm25":1.0,"air_quality_index":1'
    put_lines = lines(1).select(F.regexp_replace("value", "%s", body).alias("value"))
    put_lines.coalesce(2).write.text(str(tmp_path / "raw/pollution"))
    wide = {"spark.sql.shuffle.partitions": "2"}
    for key, value in wide.items():
        spark.conf.set(key, value)
    try:
        (first,) = load(spark, tmp_path)
        assert (first.rows, first.status, first.snapshot) == (1500, "SUCCESS", "SUCCESS")
        assert tables.aggregated(spark, str(tmp_path / "lake"), "pollution").count() == 1500
        assert load(spark, tmp_path)[0].rows == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_second_run_adds_nothing(spark, tmp_path):
    put(tmp_path / "raw", "pollution", [message(i) for i in range(10)] + [message(0), "not json", message(3, device="d2", pm25=None)])
    first, second = load(spark, tmp_path)[0], load(spark, tmp_path)[0]
    assert (first.status, first.rows, first.snapshot) == ("SUCCESS", 10, "SUCCESS")
    assert (second.status, second.rows, second.snapshot) == ("SUCCESS", 0, None)
    assert processed(spark, tmp_path).count() == 10
    bad = rows(spark.read.parquet(str(tmp_path / "lake/rejects/pollution")))
    assert [(r["reject_reason"], r["value"], r["batch"]) for r in bad] == [("unreadable", "not json", "all")]
    log = rows(spark.read.parquet(str(tmp_path / "lake/run_log")))
    assert sorted((r["status"], r["rows_processed"]) for r in log) == [("SUCCESS", 0), ("SUCCESS", 10)]


def test_late_files_touch_only_their_days(spark, tmp_path):
    put(tmp_path / "raw", "pollution", [message(i, day=d) for d in (1, 2) for i in range(3)])
    load(spark, tmp_path)
    put(tmp_path / "raw", "pollution", [message(9, day=2, co2_ppm=1000.0), message(9, day=3)], "late")
    assert load(spark, tmp_path)[0].rows == 2
    found = {r["date_partition"].day: r for r in rows(tables.aggregated(spark, str(tmp_path / "lake"), "pollution"))}
    assert {d: r["nb_mesures"] for d, r in found.items()} == {1: 3, 2: 4, 3: 1}
    assert found[2]["max_co2_ppm"] == 1000.0 and found[2]["avg_co2_ppm"] == pytest.approx(550.0)


def test_missing_and_empty_input_is_skipped_and_other_errors_are_reported(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw", "pollution", [])
    put(tmp_path / "raw", "traffic", [message(1)])
    monkeypatch.setattr(etl.clean, "new_rows", lambda *a: 1 / 0)
    found = {r.sensor: r.status for r in load(spark, tmp_path, None)}
    assert found["pollution"] == found["dechets"] == found["eclairage"] == "SKIPPED_NO_DATA"
    # The message lacks traffic's fields, so nothing is left to load, but the failure itself is reported.
    assert found["traffic"].startswith("FAILED: division by zero")
    assert tables.table_or_none(spark, str(tmp_path / "nowhere")) is None
    assert not tables.table_exists(spark, str(tmp_path / "nowhere"))


def test_a_lost_snapshot_is_made_up_for_by_the_next_run(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw", "pollution", [message(i) for i in range(4)])
    with monkeypatch.context() as patched:
        patched.setattr(etl, "refresh_snapshot", lambda *a: 1 / 0)
        assert load(spark, tmp_path)[0].snapshot.startswith("FAILED")
    assert tables.aggregated(spark, str(tmp_path / "lake"), "pollution") is None
    again = load(spark, tmp_path)[0]
    assert (again.rows, again.snapshot) == (0, "SUCCESS")
    (row,) = rows(tables.aggregated(spark, str(tmp_path / "lake"), "pollution"))
    assert row["nb_mesures"] == 4
    assert etl.pending_days(spark, str(tmp_path / "lake"), "pollution") is None


def test_incremental_load_reads_each_file_once(spark, tmp_path):
    raw, lake = tmp_path / "raw", tmp_path / "lake"
    put(raw, "pollution", [message(i) for i in range(3)], "one")
    etl.load_new_files(spark, str(raw), str(lake), POLLUTION, str(tmp_path / "state"))
    put(raw, "pollution", [message(i) for i in range(2, 5)], "two")
    etl.load_new_files(spark, str(raw), str(lake), POLLUTION, str(tmp_path / "state"))
    assert processed(spark, tmp_path).count() == 5
    (row,) = rows(tables.aggregated(spark, str(lake), "pollution"))
    assert row["nb_mesures"] == 5


def test_incremental_load_loses_nothing(spark, tmp_path, monkeypatch):
    """Numbers in other forms are kept, rejects stay per batch, failures are logged and raised, owed days are made up for."""
    raw, lake, state = tmp_path / "raw", tmp_path / "lake", str(tmp_path / "state")

    def call():
        etl.load_new_files(spark, str(raw), str(lake), POLLUTION, state)

    put(raw, "pollution", [message(0, air_quality_index=50.0), message(1, co2_ppm="410"), message(2, air_quality_index=1.5), "{"], "one")
    call()
    found = {r["timestamp"][14:16]: (r["co2_ppm"], r["air_quality_index"]) for r in rows(processed(spark, tmp_path))}
    assert found == {"00": (400.0, 50), "01": (410.0, 50)}
    put(raw, "pollution", [message(3) | {"timestamp": "12:30"}, message(4)], "two")
    with monkeypatch.context() as patched:
        patched.setattr(etl, "refresh_snapshot", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            call()
    bad = sorted((r["batch"], r["reject_reason"], r["value"][:1]) for r in rows(spark.read.parquet(str(lake / "rejects/pollution"))))
    assert bad == [(0, "bad_number", "{"), (0, "unreadable", "{"), (1, "bad_time", "{")]
    call()
    (row,) = rows(tables.aggregated(spark, str(lake), "pollution"))
    assert row["nb_mesures"] == 3
    log = rows(spark.read.parquet(str(lake / "run_log")))
    assert sorted((r["rows_processed"], r["snapshot_status"][:6]) for r in log if r["rows_processed"]) == [(1, "FAILED"), (2, "SUCCES")]
    with monkeypatch.context() as patched:
        patched.setattr(etl.clean, "new_rows", lambda *a: 1 / 0)
        put(raw, "pollution", [message(9)], "three")
        with pytest.raises(Exception, match="division by zero"):
            call()
    assert [r["status"][:6] for r in rows(spark.read.parquet(str(lake / "run_log"))) if r["snapshot_status"] is None and r["status"] != "SUCCESS"] == ["FAILED"]
    call()
    assert processed(spark, tmp_path).count() == 4


def test_a_time_without_a_day_has_none(spark):
    texts = ["12:30", "2024", "2024-05", "2024-05-13", "T10:00Z", "2024-05-13T14:32", "2024-05-13 14:32:00", "2024-05-13T14:32:00.5+02:00", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(times.event_time(F.col("t"))).collect()]
    assert [g is None for g in got] == [True] * 5 + [False] * 3 + [True] * 2
    assert got[7] == datetime(2024, 5, 13, 12, 32, 0, 500000)


def test_null_zone_is_stored_and_unknown_sensor_gives_nothing(spark, tmp_path):
    put(tmp_path / "raw", "pollution", [message(1, zone=None), message(2)])
    assert load(spark, tmp_path)[0].rows == 2
    assert {r["zone"] for r in rows(processed(spark, tmp_path))} == {None, "a"}
    assert daily.daily_by_name(processed(spark, tmp_path), "noise") is None


def test_report_on_full_partial_and_no_data(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    nothing = report.build(spark, lake)
    assert nothing.facts is None and "_Aucune donnée disponible._" in report.markdown(nothing)
    put(raw, "pollution", [message(1, zone="a", air_quality_index=80), message(2, zone="b", air_quality_index=20)])
    load(spark, tmp_path)
    half = report.build(spark, lake)
    assert {r["fact"]: r["subject"] for r in rows(half.facts)} == {"worst_zone": "a", "best_zone": "b"}
    cars = {"vehicles_per_min": 10, "avg_speed_kmh": 50.0, "type": "traffic"}
    put(raw, "traffic", [message(1, zone="a", **cars), message(2, zone="b", **cars | {"vehicles_per_min": 30})])
    load(spark, tmp_path, ("traffic",))
    whole = report.build(spark, lake)
    facts = {r["fact"]: r["value"] for r in rows(whole.facts)}
    assert facts["traffic_pollution_corr"] == pytest.approx(-1.0) and facts["peak_hour"] == pytest.approx(20.0)
    text = report.markdown(whole)
    assert "| a | 80.0 |" in text and "adapt_signals" in text
    stored = spark.read.parquet(f"{lake}/aggregated/analysis/traffic_pollution_correlation")
    assert stored.count() == 2


def test_peak_and_extremes_ignore_null_means(spark):
    ranking = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 2.0)], "zone string, avg_aqi double")
    (row,) = rows(history.zone_extremes(ranking))
    assert (row["worst_zone"], row["best_zone"]) == ("b", "b")
    profile = spark.createDataFrame([(5, None), (8, 3.0), (7, 3.0)], "heure int, avg_vehicles double")
    assert rows(history.peak_hour(profile))[0]["heure"] == 7


def test_the_report_reads_each_history_once(spark, tmp_path):
    air = spark.createDataFrame([("2024-01-01", "a", 1, 2.0, 3.0), ("2024-01-01", "a", 3, 4.0, None)], "date_partition string, zone string, air_quality_index int, co2_ppm double, pm25 double")
    cars = spark.createDataFrame([("2024-01-01", "a", 8, 5, 6.0)], "date_partition string, zone string, heure int, vehicles_per_min int, avg_speed_kmh double")
    bases = history.Bases(history.pollution_base(air), history.traffic_base(cars))
    (row,) = rows(history.pollution_by_zone(bases.pollution))
    assert (row["avg_aqi"], row["avg_co2"], row["avg_pm25"]) == (2.0, 3.0, 3.0)
    assert {r["fact"]: r["value"] for r in rows(history.facts_of(bases))} == {"worst_zone": 2.0, "best_zone": 2.0, "peak_hour": 5.0}


def test_schemas_keep_their_types():
    assert TRAFFIC.schema["vehicles_per_min"].dataType.simpleString() == "int"
    assert all(f.dataType.simpleString() == "string" for f in SENSORS["dechets"].text_schema)
