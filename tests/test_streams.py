"""Incidents by timers, supervision, the point store, rollups, routes and latencies on streams."""

import json
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from zonewatch.operators import alerts as ops
from zonewatch.operators import dashboard, points, rollups
from zonewatch.plans import etl, queries
from zonewatch.sensors import SENSORS, alert_topic
from zonewatch.sources import streams, tables
from zonewatch.streaming import incidents, jobs, sinks
from zonewatch.streaming.store import PointStore, Record, _valid
from zonewatch.streaming.supervision import Supervisor

T0 = datetime(2024, 1, 1)
ALERT_SCHEMA = (
    "window_start timestamp, window_end timestamp, zone string, alert_level string, alert_message string, "
    "type_capteur string, valeur_detectee double"
)
POINT_SCHEMA = "measurement string, zone string, device_id string, field string, value double, time timestamp"
ONCE = {"availableNow": True}


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def alert(minute, zone="a", level="ROUGE", value=70.0):
    return (at(minute), at(minute + 5), zone, level, "texte", "traffic", value)


def send(spark, path, data):
    sent = ops.packed(ops.records(spark.createDataFrame(data, ALERT_SCHEMA))).coalesce(1)
    sent.write.mode("append").text(str(path))


# -- incidents --------------------------------------------------------------------------------


def test_runs_do_not_depend_on_the_order_of_windows():
    rng = random.Random(4)
    tracker = incidents.Tracker(10, 1)
    for _ in range(200):
        starts = [rng.randrange(120) for _ in range(rng.randrange(1, 30))]
        runs = []
        for s in starts:
            tracker._add(runs, incidents.Run(s, s, s + 5, 1, 0, float(s), False))
        want = []
        for s in sorted(starts):
            if not want or s > want[-1][1] + 10:
                want.append([s, s, 0])
            want[-1][1], want[-1][2] = s, want[-1][2] + 1
        assert [[r.debut, r.dernier, r.fenetres] for r in runs] == want


def test_incidents_go_on_over_batches_and_end_by_silence(spark, tmp_path):
    out, topic = str(tmp_path / "events"), tmp_path / "topic"
    send(spark, topic, [alert(11), alert(0), alert(1, zone="b", level="ORANGE", value=None)])
    own = jobs.stream_session(spark, 2)
    stream = ops.unpacked(own.readStream.text(str(topic)))

    def run(silence):
        return jobs.incident_log(stream, out, str(tmp_path / "state"), silence=silence)

    def events():
        return sorted((r["zone"], r["debut"], r["evenement"], r["nb_fenetres"], r["resolu"]) for r in rows(spark.read.parquet(out)))

    jobs.settled(run("1 hour"), 60, state=True)
    opened = [("a", at(0), "ouvert", None, None), ("a", at(0), "resolu", 1, at(10)), ("a", at(11), "ouvert", None, None), ("b", at(1), "ouvert", None, None)]
    assert events() == opened  # eleven minutes are more than the gap
    send(spark, topic, [alert(20), alert(29), alert(60, zone="c"), alert(-30, zone="b")])
    jobs.settled(run("1 second"), 60)
    late = [("b", at(-30), "ouvert", None, None), ("b", at(-30), "resolu", 1, at(-20))]
    late += [("b", at(1), "resolu", 1, at(11))]
    ended = [("a", at(11), "resolu", 3, at(39)), ("c", at(60), "ouvert", None, None), ("c", at(60), "resolu", 1, at(70))]
    found = set(events())
    assert {e for e in found if e[0] != "b"} == {e for e in opened if e[0] != "b"} | set(ended)
    assert set(late) <= found


# -- supervision ------------------------------------------------------------------------------


def test_a_query_is_started_again_until_it_is_given_up(spark, tmp_path):
    own = jobs.stream_session(spark, 1)
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = own.readStream.schema("id long").parquet(str(tmp_path / "in"))
    left = {"shaky": 2, "broken": 99}

    def starter(name):
        def sink(batch, batch_id):
            if left[name]:
                left[name] -= 1
                raise ValueError(f"{name} sink is gone")
            batch.write.mode("overwrite").parquet(str(tmp_path / name / f"batch={batch_id}"))

        writer = stream.writeStream.queryName(name).foreachBatch(sink).option("checkpointLocation", str(tmp_path / f"{name}-state"))
        return lambda: writer.trigger(availableNow=True).start()

    health = str(tmp_path / "health")
    supervisor = Supervisor(own, {n: starter(n) for n in left}, health, wait=0.05, most=3)
    with pytest.raises(RuntimeError, match="broken sink is gone"):
        supervisor.run(every=0.1)
    assert spark.read.parquet(str(tmp_path / "shaky")).count() == 5
    noted = {}
    for r in sorted(rows(spark.read.parquet(f"{health}/incidents")), key=lambda r: r["moment"]):
        noted.setdefault(r["requete"], []).append((r["evenement"], r["essai"]))
    assert noted["shaky"] == [("panne", 1), ("reprise", 1), ("panne", 2), ("reprise", 2), ("fin", 2)]
    assert noted["broken"] == [("panne", 1), ("reprise", 1), ("panne", 2), ("reprise", 2), ("panne", 3), ("abandon", 3)]
    (progress,) = [r for r in rows(spark.read.parquet(f"{health}/progress")) if r["lignes"]]
    assert (progress["requete"], progress["batch"], progress["lignes"]) == ("shaky", 0, 5)


# -- point store ------------------------------------------------------------------------------


def point(minute, value=1.0, zone="z"):
    return ("traffic", zone, "d", "f", float(value), at(minute))


def test_store_keeps_one_copy_and_compacts(spark, tmp_path):
    store = PointStore(spark, str(tmp_path / "s"), POINT_SCHEMA)
    assert store.read().count() == 0 and store.records() == []

    def add(minutes, query, number):
        store.append(spark.createDataFrame([point(m, m) for m in minutes], POINT_SCHEMA), query, number)

    for number, start in enumerate((0, 700, 1430, 2000)):
        add(range(start, start + 20), "q", number)
    add(range(5), "q", 1)  # the batch is repeated with other rows
    add([], "q", 4)
    add([2900], "other", 0)

    def values():
        return sorted(r["value"] for r in rows(store.read()))

    before = values()
    assert len(before) == 66 and before[:3] == [0.0, 0.0, 1.0]
    assert {r["value"] for r in rows(store.read(date(2024, 1, 3), date(2024, 1, 3)))} == {2900.0}
    reader = store.read()
    assert store.compact(date(2024, 1, 3)) and values() == before
    assert not store.compact(date(2024, 1, 3))
    live = [r for r in store.records() if r.query is not None]
    assert [(r.query, r.number) for r in live] == [("other", 0)]
    assert store.vacuum(timedelta(days=1)) == 0
    assert reader.count() == 66  # still reads its version
    assert store.vacuum(timedelta(0)) > 0 and values() == before
    assert len(list((tmp_path / "s" / "data").iterdir())) == 2
    add(range(5), "q", 1)  # a covered batch that comes once more is not counted again
    assert values() == before
    add([50], "q", 9)
    assert store.compact(again=True) and len(store.records()) == 1 and len(values()) == 67


def test_of_two_compactions_that_overlap_one_holds():
    batch = Record("batch-q-000000000001", "x", ("2024-01-01",), "q", 1)
    first = Record("merged-1", "m1", (), covers={"q": [[0, 3]]})
    second = Record("merged-2", "m2", (), covers={"q": [[2, 5]]})
    third = Record("merged-3", "m3", (), covers={"q": [[0, 9]]}, replaces=("merged-1",))
    assert _valid([batch, second, first]) == [first]
    assert _valid([batch, second, first, third]) == [third]
    assert _valid([batch]) == [batch]


def test_alert_points_go_to_a_store(spark, tmp_path):
    store = jobs.alert_store(spark, str(tmp_path / "s"))
    sink = sinks.point_batches(store, "alerts")
    for _ in range(2):
        sink(spark.createDataFrame([alert(0), alert(1)], ALERT_SCHEMA), 0)
    assert store.read().count() == 2


# -- rollups ----------------------------------------------------------------------------------


@pytest.mark.parametrize("back, seconds", [("15 minutes", 0), ("15 minutes", 37), ("30 minutes", 59), ("1 hour", 1)])
def test_panels_from_rollups_are_those_from_points(spark, back, seconds):
    rng = random.Random(seconds)
    data = [
        ("pollution", z, "d", f, float(rng.randrange(50)), T0 + timedelta(seconds=rng.randrange(7200)))
        for z in "ab" for f in ("aqi", "co2_ppm") for _ in range(400)
    ]
    data += [("pollution", "a", "d", "aqi", v, at(119)) for v in (3.0, 9.0)]
    df = spark.createDataFrame(data, POINT_SCHEMA).withColumn("date", F.to_date("time"))
    parts = [rollups.partials(df.filter(F.floor("value") % 3 == k)) for k in range(3)]
    rollup = rollups.merged(parts[0].union(parts[1])).union(parts[2]).withColumn("date", F.to_date("minute"))
    now = F.lit(at(119) + timedelta(seconds=seconds)).cast("timestamp")
    near, plain = rollups.near(rollup, df, now, back), dashboard.in_range(df, now, back)
    for every in ("1 minute", "5 minutes"):
        found, want = (sorted(map(tuple, dashboard.bucket_means(x, every).selectExpr("time", "zone", "field", "round(value, 9)").collect())) for x in (dashboard.in_range(near, now, back), plain))
        assert found == want
    assert sorted(map(tuple, dashboard.latest(near).collect())) == sorted(map(tuple, dashboard.latest(plain).collect()))


def test_turns_of_rollups_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    data = [(i, T0 + timedelta(seconds=60 * i), i, "click", 1.0, json.dumps({"k": i % 120})) for i in range(400)]
    events = spark.createDataFrame(data, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).repartition(6).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    monkeypatch.setattr(queries, "run_dir", lambda session, name: str(tmp_path / "run"))
    store, rollup, now = queries.rolled(spark, str(tmp_path / "sf"))
    for turn in range(3):
        assert len(list((tmp_path / "run" / "in" / f"turn={turn}").glob("*.parquet"))) > 1
    assert [(r.query, r.number) for r in store.records()] == [("points", n) for n in range(3)]
    counts = [spark.read.parquet(str(tmp_path / "run" / "lake" / "points" / "data" / f"folder={r.folder}")).select("time", "zone").distinct().count() for r in store.records()]
    assert counts == [240, 120, 40]
    assert rollup.read().agg(F.sum("n")).first()[0] == store.read().count() and now == at(399 / 60)


# -- routes, latency, topics ------------------------------------------------------------------


def test_routes_hold_per_batch_and_are_counted_before_they_are_broadcast(spark, tmp_path, monkeypatch):
    path, routes = str(tmp_path / "routes"), ops.route_table(spark)
    assert tables.newest_version(spark, path, ops.ROUTE_SCHEMA).count() == 0
    tables.add_version(routes, path)
    tables.add_version(routes.limit(0).union(routes.filter("type_capteur = 'traffic'").withColumn("canal", F.lit("Radio"))), path)
    newest = tables.newest_version(spark, path, ops.ROUTE_SCHEMA)
    assert {r["canal"] for r in rows(newest)} == {"Radio"}
    records = ops.records(spark.createDataFrame([alert(0), alert(1, level="VERT")], ALERT_SCHEMA))
    assert sorted(str(r["canal"]) for r in rows(ops.routed(records, newest))) == ["None", "Radio"]
    monkeypatch.setattr(ops, "BROADCAST_ROUTES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ops.routed(records, newest)
        assert "Broadcast" not in found._jdf.queryExecution().optimizedPlan().toString().replace("BroadcastExchange", "")
        assert found.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latency_adds_up_over_batches(spark):
    records = ops.records(spark.createDataFrame([alert(i) for i in range(3000)], ALERT_SCHEMA))
    arrival = F.col("debut_fenetre") + F.make_dt_interval(secs=(F.unix_timestamp("debut_fenetre") / 60 % 1000).cast("decimal(18,6)"))
    parts = [ops.latency_partials(records.filter(F.minute("debut_fenetre") % 4 == k), arrival) for k in range(4)]
    partials = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    (found,) = rows(ops.latency_report(partials, (0.5, 0.95)))
    (plain,) = rows(ops.latency(records, arrival))
    assert {k: v for k, v in found.items() if "_q" not in k} == plain
    exact = records.select(((F.unix_micros(arrival) - F.unix_micros("debut_fenetre")) / 1e6).alias("s")).agg(*[F.percentile("s", q) for q in (0.5, 0.95)]).first()
    assert found["latence_q50"] == pytest.approx(exact[0], abs=30) and found["latence_q95"] == pytest.approx(exact[1], abs=30)


def test_jobs_publish_to_one_topic_at_the_same_time(spark, tmp_path):
    topics, begun = streams.Folder(str(tmp_path / "topics")), tmp_path / "begun"

    def slow(part):
        begun.touch()
        time.sleep(5)
        yield from part

    late = spark.range(1).mapInPandas(slow, "id long").select(F.col("id").cast("string").alias("value"))
    with ThreadPoolExecutor(1) as pool:
        running = pool.submit(topics.publish, late, "t")
        while not begun.exists() and not running.done():
            time.sleep(0.05)
        topics.publish(spark.range(1, 3).select(F.col("id").cast("string").alias("value")), "t")
        running.result()
    query = topics.read(jobs.stream_session(spark, 1), "t").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    jobs.drain(query.option("checkpointLocation", str(tmp_path / "state")).trigger(**ONCE).start())
    assert sorted(bytes(r["value"]) for r in rows(spark.read.parquet(str(tmp_path / "out")))) == [b"0", b"1", b"2"]


def test_topics_in_folders(spark, tmp_path):
    topics = streams.Folder(str(tmp_path))
    body = json.dumps({"timestamp": "2024-01-01T00:00:00Z", "device_id": "d", "zone": "z", "vehicles_per_min": 7})
    topics.publish(spark.createDataFrame([(body,)], "value string"), "sensors-traffic", F.lit(at(3)))
    topics.publish(ops.as_messages(ops.records(spark.createDataFrame([alert(0)], ALERT_SCHEMA)), alert_topic()), alert_topic())
    (sent,) = rows(spark.read.parquet(str(tmp_path / alert_topic())))
    assert sent["key"] == b"a" and sent["topic"] == alert_topic() and sent["timestamp"] is not None
    own, seen = jobs.stream_session(spark, 1), {}

    def keep(name):
        return lambda batch, batch_id: seen.setdefault(name, []).extend(rows(batch))

    sources = {"reading": streams.sensor_topic(own, topics, SENSORS["traffic"]), "alert": streams.alert_messages(own, topics, keep=("timestamp",))}
    for name, stream in sources.items():
        jobs.drain(stream.writeStream.foreachBatch(keep(name)).option("checkpointLocation", str(tmp_path / f"state-{name}")).trigger(availableNow=True).start())
    assert seen["reading"][0]["vehicles_per_min"] == 7 and seen["reading"][0]["event_time"] == at(0)
    assert seen["alert"][0]["debut_fenetre"] == at(0) and seen["alert"][0]["timestamp"] == sent["timestamp"]


# -- load -------------------------------------------------------------------------------------


def test_a_call_without_new_files_is_logged(spark, tmp_path):
    lake, raw, sensor = str(tmp_path / "lake"), tmp_path / "raw", SENSORS["traffic"]
    state = str(tmp_path / "state")
    etl.load_new_files(spark, str(raw), lake, sensor, state)  # no folder
    (raw / "traffic").mkdir(parents=True)
    etl.load_new_files(spark, str(raw), lake, sensor, state)  # no file
    line = json.dumps({"timestamp": "2024-01-01T00:00:00Z", "device_id": "d", "zone": "z", "vehicles_per_min": 7, "avg_speed_kmh": 5.0})
    (raw / "traffic" / "a.json").write_text(f"{line}\n{line}\n")
    for _ in range(2):
        etl.load_new_files(spark, str(raw), lake, sensor, state)
    log = sorted(rows(spark.read.parquet(f"{lake}/run_log")), key=lambda r: r["timestamp"])
    assert [(r["status"], r["rows_processed"]) for r in log] == [(etl.NO_DATA, 0), (etl.NO_DATA, 0), (etl.SUCCESS, 1), (etl.NO_DATA, 0)]
