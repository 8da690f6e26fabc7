"""Sliding windows: brute force, batch against stream, late rows, restart, demo scenarios."""

from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from zonewatch.operators import alerts as ops
from zonewatch.operators import parse, windows
from zonewatch.plans import queries, testbed
from zonewatch.sensors import SENSORS, chosen
from zonewatch.streaming import jobs

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "sensor string, zone string, event_time timestamp, co2_ppm double, pm25 double, air_quality_index int"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def reading(minutes, co2, zone="a", pm25=1.0, aqi=1):
    return ("pollution", zone, at(minutes), co2, pm25, aqi)


def naive(t):
    return t.replace(tzinfo=None)


def brute(readings, size, slide):
    """(start, zone) -> co2 values."""
    found = defaultdict(list)
    for _, zone, t, co2, _, _ in readings:
        minute = (t - T0) / timedelta(minutes=1)
        start = int(minute // slide) * slide
        while start > minute - size:
            found[(naive(at(start)), zone)].append(co2)
            start -= slide
    return found


@pytest.mark.parametrize("size, slide", [(5, 1), (15, 5)])
def test_windows_match_brute_force(spark, size, slide):
    data = [reading(i * 0.7, float(i * 13 % 97), "ab"[i % 3 == 0]) for i in range(120)]
    data.append(reading(3, None))
    df = spark.createDataFrame(data, SCHEMA)
    found = windows.batch_windows(df, chosen(["pollution"]), f"{size} minutes", f"{slide} minutes")
    got = {(r["window_start"], r["zone"]): (r["nb_mesures"], r["avg_co2"]) for r in rows(found)}
    want = brute(data, size, slide)
    assert set(got) == set(want)
    for key, co2 in want.items():
        known = [c for c in co2 if c is not None]
        assert got[key][0] == len(co2)
        assert got[key][1] == pytest.approx(sum(known) / len(known), abs=1e-8)


def test_all_null_window_is_normal_and_keeps_its_row(spark):
    df = spark.createDataFrame([("pollution", "a", at(0), None, None, None)], SCHEMA)
    found = windows.graded(windows.batch_windows(df, chosen(["pollution"]), "5 minutes", "1 minute"), chosen(["pollution"]))
    assert {r["alert_level"] for r in rows(found)} == {"VERT"}
    assert found.count() == 5


def test_a_mean_on_the_threshold_keeps_its_level_whatever_the_order(spark):
    # 0.1 + 0.7 + 0.4 is 1.2 or 1.2000000000000002, depending on the order; the mean is 0.4.
    schema = "sensor string, zone string, event_time timestamp, luminosity_lux int, status string, power_kw double"
    for order in ([0.1, 0.7, 0.4], [0.7, 0.4, 0.1], [0.4, 0.1, 0.7]):
        data = [("eclairage", "a", at(0.1 * i), 50, "working", kw) for i, kw in enumerate(order)]
        df = spark.createDataFrame(data, schema).coalesce(1)
        assert {r["alert_level"] for r in rows(windows.alerts(df, chosen(["eclairage"])))} == {"ORANGE"}


def test_one_pass_over_all_sensors_equals_four_passes(spark):
    sf = "/root/testdata/sf0.001"
    kept = ("window_start", "zone", "type_capteur", "alert_level", "valeur_detectee", "nb_mesures")
    whole = queries.alerts_of(spark, sf).select(*kept)
    parts = None
    for name in SENSORS:
        part = queries.alerts_of(spark, sf, name).select(*kept)
        parts = part if parts is None else parts.unionByName(part)
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_min_count_and_own_grading(spark):
    df = spark.createDataFrame([reading(0, 900.0), reading(1, 900.0)], SCHEMA)
    assert windows.alerts(df, chosen(["pollution"])).count() == 6
    assert windows.alerts(df, chosen(["pollution"]), min_count=2).count() == 4
    calm = lambda found: found.withColumn("alert_level", F.lit("VERT"))
    assert windows.alerts(df, chosen(["pollution"]), grade=calm).count() == 0


def run_stream(spark, source, out, build, **options):
    """Drain a file stream of readings through ``build`` into a parquet table."""
    own = jobs.stream_session(spark, 2)
    stream = own.readStream.schema(SCHEMA).options(**options).parquet(str(source))
    query = (
        build(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", str(out / "rows"))
        .option("checkpointLocation", str(out / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert query.exception() is None
    return query


def pollution_windows(stream):
    return windows.zone_windows(stream, chosen(["pollution"]), "5 minutes", "1 minute", "5 minutes")


def save(spark, data, path):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def test_stream_emits_closed_windows_once_and_drops_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    save(spark, [reading(i, 100.0 + i) for i in range(32)], source)
    run_stream(spark, source, tmp_path, pollution_windows)
    first = {r["window_start"]: r["avg_co2"] for r in rows(spark.read.parquet(str(tmp_path / "rows")))}
    # Newest reading 00:31, delay 5 minutes: windows ending up to 00:26 are out.
    assert max(first) == naive(at(21)) and min(first) == naive(at(-4))

    # A restart from the checkpoint: a late row changes nothing, later rows close more windows.
    save(spark, [reading(5, 9999.0), reading(40, 1.0)], source)
    run_stream(spark, source, tmp_path, pollution_windows)
    found = rows(spark.read.parquet(str(tmp_path / "rows")))
    second = {r["window_start"]: r["avg_co2"] for r in found}
    assert len(found) == len(second)
    assert all(second[k] == v for k, v in first.items())
    assert max(second) == naive(at(30))


def test_stream_equals_batch_on_closed_windows(spark):
    sf = "/root/testdata/sf0.001"
    streamed = queries.stream_alerts("traffic")(spark, sf)
    newest = testbed.readings(spark, sf, "traffic").agg(F.max("event_time").cast("timestamp_ntz")).first()[0]
    batch = queries.sensor_alerts("traffic")(spark, sf).filter(F.col("window_end") <= newest - timedelta(minutes=5))
    batch = batch.select(*streamed.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


SCENARIOS = [
    ("pollution", {"co2_ppm": 950.0, "pm25": 10.0, "air_quality_index": 40}, {"co2_ppm": 420.0, "pm25": 10.0, "air_quality_index": 40}),
    ("traffic", {"vehicles_per_min": 80, "avg_speed_kmh": 40.0}, {"vehicles_per_min": 10, "avg_speed_kmh": 70.0}),
    ("eclairage", {"luminosity_lux": 2, "power_kw": 0.1, "status": "working"}, {"luminosity_lux": 400, "power_kw": 0.1, "status": "working"}),
    ("dechets", {"fill_percent": 95.0, "weight_kg": 20.0}, {"fill_percent": 10.0, "weight_kg": 12.0}),
]


@pytest.mark.parametrize("name, bad, good", SCENARIOS)
def test_demo_scenario_raises_and_resolves(spark, name, bad, good):
    """Six bad minutes every five seconds, then normal: red during, nothing ten minutes later."""
    sensor = SENSORS[name]
    lines = []
    for tick in range(0, 30 * 60, 5):
        stamp = (T0 + timedelta(seconds=tick)).isoformat()
        body = {"timestamp": stamp, "device_id": "d", "zone": "zone_industrielle", "type": name}
        lines.append((body | (bad if 300 <= tick < 660 else good),))
    import json

    sent = spark.createDataFrame([(json.dumps(b[0]),) for b in lines], "value string")
    found = windows.alerts(parse.decode(sent, sensor), (sensor,))
    red = sorted(r["window_start"] for r in rows(found) if r["alert_level"] == "ROUGE")
    assert red and red[0] >= naive(at(1)) and red[-1] < naive(at(11))
    (incident,) = rows(ops.incidents(found))
    assert incident["fin"] <= naive(at(16)) and incident["nb_rouge"] == len(red)
