"""Points, dashboards, alert handling, streaming sinks."""

import json
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from zonewatch.functions import routing
from zonewatch.operators import alerts as ops
from zonewatch.operators import bridge, dashboard, parse, points
from zonewatch.sensors import SENSORS, alert_topic, chosen, topic_of
from zonewatch.sources import streams
from zonewatch.streaming import jobs, sinks

T0 = datetime(2024, 1, 1)
ALERT_SCHEMA = (
    "window_start timestamp, window_end timestamp, zone string, alert_level string, alert_message string, "
    "type_capteur string, valeur_detectee double"
)
POINT_SCHEMA = "measurement string, zone string, device_id string, field string, value double, time timestamp"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def alert(minute, zone="a", level="ROUGE", sensor="traffic", value=70.0):
    return (at(minute), at(minute + 5), zone, level, "texte", sensor, value)


def alerts(spark, data):
    return spark.createDataFrame(data, ALERT_SCHEMA)


def test_lenient_points(spark):
    body = [
        ("eclairage", {"zone": "a", "luminosity_lux": "7", "power_kw": True, "timestamp": "bad"}),
        ("eclairage", {}),
        ("dechets", {"device_id": "d", "fill_percent": "x", "alert": "TRUE", "timestamp": "2024-01-01T10:00:00Z"}),
        ("pollution", [1]),
    ]
    df = spark.createDataFrame([(s, json.dumps(b)) for s, b in body] + [("traffic", "{bad"), (None, "{}")], "s string, value string")
    read = parse.decode_any(df, F.col("s"), text=True)
    found = points.reading_points(read, chosen(), arrival=F.lit(at(0)).cast("timestamp"))
    got = sorted((r["field"], r["zone"], r["device_id"], r["value"], r["time"]) for r in rows(found))
    assert got == [
        ("alert_flag", "unknown", "d", 1.0, at(600)),
        ("faulty_count", "a", "unknown", 0.0, at(0)),
        ("faulty_count", "unknown", "unknown", 0.0, at(0)),
        ("luminosity_lux", "a", "unknown", 7.0, at(0)),
        ("power_kw", "a", "unknown", 1.0, at(0)),
    ]


BLANKS = ["", "\n", "\t", " \r\n "]


@pytest.mark.parametrize("text", [False, True])
def test_objects_are_found_by_parsing(spark, text):
    """White space before an object does not matter; arrays, bare values and broken texts are no objects."""
    good = [b + '{"zone": "z"}' for b in BLANKS] + ["{}", '{"co2_ppm": "x"}']
    bad = ["[1]", '[{"zone": "z"}]', '"{}"', "5", "null", "", " ", "{bad", None]
    df = spark.createDataFrame([("pollution", v) for v in good + bad] + [(None, "{}")], "s string, value string")
    assert parse.decode_any(df, F.col("s"), text=text).count() == len(good)
    lost = rows(parse.unread(df, F.col("s")))
    assert sorted(str(r["value"]) for r in lost if r["reject_reason"] == "unreadable") == sorted(map(str, bad))
    assert [r["value"] for r in lost if r["reject_reason"] == "unknown_sensor"] == ["{}"]


def test_strict_path_nulls_mistyped_numbers(spark):
    sent = spark.createDataFrame([(json.dumps({"air_quality_index": "7", "co2_ppm": "2.5", "pm25": 1.5}),), ("nope",)], "value string")
    got = rows(parse.decode(sent, SENSORS["pollution"]))
    assert [(r["air_quality_index"], r["co2_ppm"], r["pm25"]) for r in got] == [(None, None, 1.5), (None, None, None)]


def test_range_includes_start_and_excludes_stop(spark):
    df = spark.createDataFrame([("m", "z", "d", "f", float(i), at(i)) for i in range(31)], POINT_SCHEMA)
    got = dashboard.in_range(df, F.lit(at(30)).cast("timestamp"), "30 minutes")
    assert sorted(r["value"] for r in rows(got)) == [float(i) for i in range(30)]


def test_latest_skips_nulls_and_panel_counts_faults(spark):
    series = ("eclairage", "z", "d")
    data = [(*series, "power_kw", 0.5, at(1)), (*series, "power_kw", None, at(2)), (*series, "power_kw", 0.1, at(0))]
    df = spark.createDataFrame(data, POINT_SCHEMA)
    assert [(r["value"], r["time"]) for r in rows(dashboard.latest(df))] == [(0.5, at(1))]
    faults = [(*series, "faulty_count", float(i == 0), at(i)) for i in range(4)]
    shown = dashboard.lighting_panel(spark.createDataFrame(faults, POINT_SCHEMA), F.lit(at(9)).cast("timestamp"))
    assert [(r["value"], r["colour"]) for r in rows(shown)] == [(0.25, "green")]


def test_pivot_gives_a_row_per_time(spark):
    data = [("m", "z", "d", f, float(i), at(i)) for i in range(3) for f in ("x", "y")]
    got = rows(dashboard.pivot_fields(spark.createDataFrame(data, POINT_SCHEMA), ("x", "y"), ("zone",)))
    assert sorted((r["x"], r["y"]) for r in got) == [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]


def test_newest_alerts_per_series_and_overall(spark):
    data = [alert(i, zone=z) for i in range(60) for z in "ab"]
    found = points.alert_points(alerts(spark, data))
    each = rows(dashboard.newest_per_series(found))
    assert len(each) == 100 and min(r["time"] for r in each) == at(10)
    assert len(rows(dashboard.newest(found))) == 50


def test_alert_without_value_gives_no_window_point_but_counts_on_arrival(spark):
    df = alerts(spark, [alert(0, value=None), alert(1)])
    assert points.alert_points(df).count() == 1
    arrived = points.arrival_points(ops.records(df), F.lit(at(9)).cast("timestamp"))
    assert sorted(r["valeur"] for r in rows(arrived)) == [0.0, 70.0]
    texts = sorted(r["value"] for r in rows(ops.packed(ops.records(df))))
    assert sum("valeur_detectee" in t for t in texts) == 1


def test_outbox_is_off_by_default_and_red_only(spark):
    records = ops.records(alerts(spark, [alert(0), alert(1, level="ORANGE"), alert(2, zone=None)]))
    assert ops.outbox(records).count() == 0
    sent = sorted(r["subject"] for r in rows(ops.outbox(records, enabled=True, label="ville")))
    assert sent == ["🚨 [ville] ALERTE ROUGE — ? (traffic)", "🚨 [ville] ALERTE ROUGE — A (traffic)"]


def test_counts_serving_and_display(spark):
    data = [alert(0), alert(1), alert(2, level="ORANGE"), alert(3, level=None), alert(4, level="VERT")]
    records = ops.records(alerts(spark, data))
    assert {r["alert_level"]: r["nb_alertes"] for r in rows(ops.counts(records))} == {"ROUGE": 2, "ORANGE": 1, "total": 3}
    assert {r["zone"] for r in rows(ops.display(records))} == {"A"}
    empty = {r["alert_level"]: r["nb_alertes"] for r in rows(ops.counts(records.limit(0)))}
    assert empty in ({}, {"total": 0})


def test_routes_and_latency(spark):
    records = ops.records(alerts(spark, [alert(0), alert(1, sensor="autre")]))
    got = {r["type_capteur"]: r["canal"] for r in rows(ops.routed(records))}
    assert got == {"traffic": "SMS + Radio", "autre": None}
    late = F.col("debut_fenetre") + F.expr("INTERVAL 7 SECONDS")
    got = rows(ops.latency(records, late))
    assert all(r["latence_max"] == 7.0 and r["objectif_atteint"] for r in got) and len(got) == 2


def brute_incidents(data, gap=10):
    found = []
    for key in sorted({(a[2], a[5]) for a in data}):
        last = None
        for a in sorted(x for x in data if (x[2], x[5]) == key):
            if last is None or a[0] - last > timedelta(minutes=gap):
                found.append([*key, a[0], a[1], 0])
            found[-1][3], found[-1][4], last = a[1], found[-1][4] + 1, a[0]
    return sorted(map(tuple, found))


@pytest.mark.parametrize("seed, chunk", [(1, "1 day"), (2, "1 hour"), (3, "30 minutes"), (4, "20 minutes")])
def test_incidents_match_brute_force_across_chunks(spark, seed, chunk):
    """Gaps of exactly ten minutes join; runs may span any number of chunks."""
    rng, data = random.Random(seed), []
    for zone in "ab":
        minute = 0
        for _ in range(80):
            minute += rng.choice([1, 1, 1, 2, 9, 10, 11, 25])
            data.append(alert(minute, zone=zone))
    got = rows(ops.incidents(alerts(spark, data), chunk=chunk))
    assert sorted((r["zone"], r["type_capteur"], r["debut"], r["fin"], r["nb_fenetres"]) for r in got) == brute_incidents(data)


def test_one_incident_over_many_chunks(spark):
    data = [alert(10 * i) for i in range(200)]
    (only,) = rows(ops.incidents(alerts(spark, data), chunk="1 hour"))
    assert only["nb_fenetres"] == 200 and only["resolu"] == at(2000)


def test_bridge_routes_every_message(spark):
    events = spark.createDataFrame(
        [('{"device_id":"waste_a"}', None), ("not json", "lighting_b"), ("{}", "unknown")], "value string, hub_device_id string"
    )
    sent, letters = bridge.split_routes(events, "p")
    assert sorted(r["topic"] for r in rows(sent)) == ["p-dechets", "p-eclairage"]
    assert [r["device"] for r in rows(letters)] == ["unknown"]


def test_topics_and_kafka_options(spark):
    assert (topic_of("traffic", "x"), alert_topic("x")) == ("x-traffic", "x-alerts")
    options = streams.kafka_options("h:1", ["x-a", "x-b"])
    assert options["subscribe"] == "x-a,x-b" and options["startingOffsets"] == "latest"
    df = spark.createDataFrame([("x-traffic",), ("other",)], "topic string")
    assert [r[0] for r in df.select(routing.sensor_of_topic(F.col("topic"), "x")).collect()] == ["traffic", None]


def test_hub_header_is_found(spark):
    headers = "array<struct<key:string,value:binary>>"
    df = spark.createDataFrame(
        [("{}", [("other", b"x"), (streams.HUB_DEVICE_HEADER, b"waste_1")]), ("{}", None)], f"value string, headers {headers}"
    )
    assert [r["hub_device_id"] for r in rows(streams.hub_device(df))] == ["waste_1", None]


# -- sinks ------------------------------------------------------------------------------------


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    sink = sinks.point_batches(str(tmp_path / "p"), "alerts")
    batch = alerts(spark, [alert(0), alert(1)])
    for _ in range(2):
        sink(batch, 7)
    sink(batch.limit(0), 8)
    found = spark.read.parquet(str(tmp_path / "p"))
    assert found.count() == 2 and {r["batch"] for r in rows(found)} == {7}
    assert {p.name.split("=")[0] for p in (tmp_path / "p").iterdir() if p.is_dir()} == {"date"}


def test_a_repeated_batch_keeps_its_arrival_time(spark, tmp_path):
    """So a batch that is repeated after midnight replaces its rows, also if partitions are replaced one by one."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        first = sinks.fixed_arrival(spark, str(tmp_path), 3)
        records = ops.records(alerts(spark, [alert(0), alert(1)]))
        for _ in range(2):
            assert sinks.fixed_arrival(spark, str(tmp_path), 3) == first
            sinks.write_batch(points.arrival_points(records, F.lit(first).cast("timestamp")), str(tmp_path / "p"), "arrivals", 3)
        assert spark.read.parquet(str(tmp_path / "p")).count() == 2
        assert sinks.fixed_arrival(spark, str(tmp_path), 4) > first
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_panels_read_the_days_of_their_range_only(spark, tmp_path):
    data = [("pollution", "z", "d", "aqi", float(i), at(10 * i)) for i in range(1000)]
    points_table = spark.createDataFrame(data, POINT_SCHEMA).withColumn("date", F.to_date("time"))
    points_table.write.partitionBy("measurement", "date").parquet(str(tmp_path / "p"))
    found = dashboard.aqi_panel(spark.read.parquet(str(tmp_path / "p")), F.lit(at(9990)).cast("timestamp"))
    assert [r["value"] for r in rows(found)] == [998.0]
    files = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in files and "date#" in files.split("PartitionFilters")[1].split("]")[0]
    read = spark.read.parquet(str(tmp_path / "p"))
    assert len(dashboard.in_range(read, F.lit(at(9990)).cast("timestamp"), "15 minutes").inputFiles()) >= 1


def test_adapters_plan_their_sources_and_sinks(spark, monkeypatch, tmp_path):
    """The broker sources are built from their options; a file stream stands in for the transport."""
    asked = []
    schema = "topic string, value binary, headers array<struct<key:string,value:binary>>"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))

    def messages(session, fmt, options, path=None, schema_=None):
        asked.append((fmt, options["subscribe"], options.get("kafka.group.id"), options.get("includeHeaders")))
        return session.readStream.schema(schema).parquet(str(tmp_path / "in"))

    monkeypatch.setattr(streams, "messages", messages)
    assert streams.sensor_topic(spark, "h:1", SENSORS["traffic"]).isStreaming
    assert "event_time" in streams.all_topics(spark, "h:1").columns
    assert streams.alert_messages(spark, "h:1", group="g").columns[0] == "debut_fenetre"
    assert streams.hub_events(spark, "h:1", "hub").columns == ["value", "hub_device_id"]
    assert asked == [
        ("kafka", "sensors-traffic", None, None),
        ("kafka", "sensors-pollution,sensors-traffic,sensors-eclairage,sensors-dechets", None, None),
        ("kafka", "sensors-alerts", "g", None),
        ("kafka", "hub", None, "true"),
    ]


def test_supervision_raises_what_a_query_raised(spark, tmp_path):
    own = jobs.stream_session(spark, 1)
    spark.range(3).write.parquet(str(tmp_path / "in"))

    def fail(batch, batch_id):
        raise ValueError("sink is gone")

    own.streams.resetTerminated()
    writer = own.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.foreachBatch(fail)
    writer.option("checkpointLocation", str(tmp_path / "state")).start()
    with pytest.raises(Exception, match="sink is gone"):
        jobs.supervise(own)
    own.streams.resetTerminated()


def test_rejects_of_a_stream_keep_their_text(spark, tmp_path):
    data = [("sensors-traffic", "not json"), ("other", "{}"), ("sensors-traffic", '{"device_id":"d","timestamp":"2024-01-01T00:00:00Z"}')]
    spark.createDataFrame(data, "topic string, value string").write.parquet(str(tmp_path / "in"))
    stream = jobs.stream_session(spark, 1).readStream.schema("topic string, value string").parquet(str(tmp_path / "in"))
    jobs.drain(jobs.reject_log(stream, str(tmp_path / "out"), str(tmp_path / "state"), trigger={"availableNow": True}))
    got = sorted((r["reject_reason"], r["value"]) for r in rows(spark.read.parquet(str(tmp_path / "out"))))
    assert got == [("unknown_sensor", "{}"), ("unreadable", "not json")]


def alert_stream(spark, tmp_path, data):
    ops.packed(ops.records(alerts(spark, data))).coalesce(1).write.mode("append").text(str(tmp_path / "topic"))
    own = jobs.stream_session(spark, 2)
    return ops.unpacked(own.readStream.text(str(tmp_path / "topic")))


def test_alert_engine_writes_points_and_outbox(spark, tmp_path):
    stream = alert_stream(spark, tmp_path, [alert(0), alert(1, level="ORANGE"), alert(2, level="VERT")])
    where = (str(tmp_path / "points"), str(tmp_path / "outbox"), str(tmp_path / "state"))
    jobs.drain(jobs.alert_engine(stream, *where, notify=True, trigger={"availableNow": True}))
    assert sorted(r["niveau"] for r in rows(spark.read.parquet(where[0]))) == ["ORANGE", "ROUGE"]
    assert spark.read.parquet(where[1]).count() == 1


def test_incident_stream_emits_ended_incidents_once(spark, tmp_path):
    data = [alert(i) for i in (0, 1, 11, 22)] + [alert(60)]
    stream = jobs.incidents(alert_stream(spark, tmp_path, data))
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    jobs.drain(query)
    got = sorted((r["debut"], r["nb_fenetres"], r["resolu"]) for r in rows(spark.read.parquet(str(tmp_path / "out"))))
    assert got == [(at(0), 3, at(21)), (at(22), 1, at(32))]


def test_running_counts_stay_complete_over_batches(spark, tmp_path):
    seen = []

    def keep(batch, batch_id):
        seen.append({r["alert_level"]: r["nb_alertes"] for r in rows(batch)})

    for data in ([alert(0), alert(1, level="ORANGE")], [alert(2)]):
        counted = ops.counts(alert_stream(spark, tmp_path, data))
        writer = counted.writeStream.outputMode("complete").foreachBatch(keep)
        jobs.drain(writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    assert seen[-1] == {"ROUGE": 2, "ORANGE": 1, "total": 3}


def test_pipeline_feeds_messages_points_and_console_from_one_query(spark, tmp_path, capfd):
    schema = "sensor string, zone string, event_time timestamp, vehicles_per_min int, avg_speed_kmh double"
    data = [("traffic", "a", at(i), 80, 50.0) for i in range(40)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in"))
    stream = jobs.stream_session(spark, 2).readStream.schema(schema).parquet(str(tmp_path / "in"))
    started = jobs.alert_pipeline(
        stream, chosen(["traffic"]), str(tmp_path / "points"), str(tmp_path / "state"),
        message_fmt="text", message_options={"path": str(tmp_path / "log")}, show=True, trigger={"availableNow": True},
    )
    for query in started:
        jobs.drain(query)
    sent = ops.unpacked(spark.read.text(str(tmp_path / "log")))
    stored = spark.read.parquet(str(tmp_path / "points"))
    # Newest reading 00:39: alert windows ending up to 00:34, trend windows ending up to 00:24.
    assert sent.count() == stored.filter("niveau = 'ROUGE'").count() == 34
    assert {r["time"] for r in rows(stored.filter("niveau = 'TENDANCE'"))} == {at(-10), at(-5), at(0), at(5)}


def test_console_writer(spark, tmp_path):
    stream = alert_stream(spark, tmp_path, [alert(0)])
    query = sinks.console(stream, str(tmp_path / "state")).trigger(availableNow=True).start()
    jobs.drain(query)
    assert query.lastProgress is not None
