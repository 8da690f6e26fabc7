"""The registered queries: each takes (spark, table folder) and returns a DataFrame.

Times leave as wall-clock (UTC) timestamps. Plain means are rounded to six places for
comparison, after a shift far below that, because an exact half would otherwise go up or
down with the order of summation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.functions import bands, routing, times
from zonewatch.operators import alerts as ops
from zonewatch.operators import bridge, clean, daily, dashboard, history, parse, points, rollups, windows
from zonewatch.plans import etl, report, testbed
from zonewatch.sensors import SENSORS, alert_topic, chosen, topic_of, wide_schema
from zonewatch.session import prepare, run_dir, stored
from zonewatch.settings import TOPIC_PREFIX
from zonewatch.sources import streams, tables
from zonewatch.streaming import jobs, sinks
from zonewatch.streaming.supervision import Supervisor

Query = Callable[[SparkSession, str], DataFrame]
ALL = tuple(SENSORS)


def outward(rows: DataFrame, *means: str) -> DataFrame:
    """Wall-clock times and rounded means."""
    shown = []
    for name, kind in rows.dtypes:
        if kind == "timestamp":
            shown.append(f"cast(`{name}` AS timestamp_ntz) AS `{name}`")
        elif name in means:
            shown.append(f"round(`{name}` + 1e-9D, 6) AS `{name}`")
        else:
            shown.append(f"`{name}`")
    return rows.selectExpr(*shown)


# -- windows, alerts, trends ------------------------------------------------------------------


def alerts_of(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    sensors = chosen(names or ALL)
    return windows.alerts(testbed.readings(spark, sf_dir, *names), sensors)


def trends_of(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    sensors = chosen(names or ALL)
    return windows.trends(testbed.readings(spark, sf_dir, *names), sensors)


def sensor_alerts(name: str) -> Query:
    return lambda spark, sf_dir: outward(alerts_of(spark, sf_dir, name).drop("sensor"))


def sensor_trends(name: str) -> Query:
    return lambda spark, sf_dir: outward(trends_of(spark, sf_dir, name).drop("sensor"))


def all_alerts_union(spark, sf_dir):
    kept = ("window_start", "window_end", "zone", "alert_level", "alert_message", "type_capteur", "valeur_detectee")
    return outward(alerts_of(spark, sf_dir).select(*kept))


def alert_json(spark, sf_dir):
    return outward(ops.unpacked(ops.packed(ops.records(alerts_of(spark, sf_dir)))))


def alert_and_trend_points(spark, sf_dir):
    both = windows.alert_pipeline(testbed.readings(spark, sf_dir), chosen(ALL))
    return outward(ops.all_points(*both, points.alert_points))


def rule_attribution(spark, sf_dir):
    return outward(ops.attributed(alerts_of(spark, sf_dir), chosen(ALL)))


# -- parsing and cleaning ---------------------------------------------------------------------


def sent(body: Column) -> Column:
    """A message text as it would come from a source: made once, whatever is filtered on it later."""
    return F.explode(F.array(body)).alias("value")


def led(body: Column) -> Column:
    """A message body after the white space that JSON allows before it."""
    return F.concat(F.element_at(F.array(*[F.lit(x) for x in ("", "\n", "\t", " \r\n ")]), (F.col("event_id") % 4 + 1).cast("int")), body)


def topic_messages(spark, sf_dir) -> DataFrame:
    """All readings as messages on their topics, and other events on a topic nobody reads."""
    rows = testbed.readings(spark, sf_dir)
    body = F.to_json(F.struct(*wide_schema().fieldNames()))
    ours = rows.select("event_id", F.concat(F.lit(f"{TOPIC_PREFIX}-"), F.col("sensor")).alias("topic"), sent(led(body)))
    others = testbed.events(spark, sf_dir).filter(F.col("event_type") == "signup")
    return ours.unionByName(others.select("event_id", F.lit("other").alias("topic"), F.col("props").alias("value")))


def topic_readings(spark, sf_dir):
    return outward(streams.from_topics(topic_messages(spark, sf_dir), keep=("event_id",)))


def sensor_messages(name: str) -> Query:
    """JSON bytes to typed readings with event time, one sensor."""

    def query(spark, sf_dir):
        sensor = SENSORS[name]
        messages = testbed.messages(testbed.readings(spark, sf_dir, name), sensor)
        return outward(parse.decode(messages, sensor).drop("sensor"))

    return query


def time_texts(spark, sf_dir) -> DataFrame:
    """Event times written in ten ways; those without a date, or without a time, are no event times."""
    rows = testbed.events(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    way = F.col("event_id") % 10
    text = (
        F.when(way == 0, times.message_text(ts))
        .when(way == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .when(way == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX"))
        .when(way == 3, F.lit("bad"))
        .when(way == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx"))
        .when(way == 6, F.date_format(ts, "HH:mm"))
        .when(way == 7, F.date_format(ts, "yyyy"))
        .when(way == 8, F.date_format(ts, "yyyy-MM"))
        .when(way == 9, F.date_format(ts, "yyyy-MM-dd"))
    )
    return rows.select("event_id", text.alias("text"))


def event_times(spark, sf_dir):
    text = F.col("text")
    return outward(
        time_texts(spark, sf_dir).select(
            "event_id",
            times.event_time(text).alias("lenient"),
            times.event_time(text, strict=True).alias("strict"),
        )
    )


def rejected_readings(spark, sf_dir):
    rows = testbed.readings(spark, sf_dir, "pollution", clock="calendar").drop("event_time")
    way = F.col("event_id") % 7
    spoiled = rows.withColumns(
        {
            "timestamp": F.when(way == 3, F.lit("bad")).when(~way.isin(1, 4), F.col("timestamp")),
            "device_id": F.when(~way.isin(2, 4), F.col("device_id")),
            "zone": F.when(way != 4, F.col("zone")),
        }
    )
    found = clean.rejects(clean.tagged(spoiled))
    return found.select("event_id", "timestamp", "device_id", "zone", "reject_reason")


def cleaned(spark, sf_dir, name: str) -> DataFrame:
    sensor = SENSORS[name]
    return clean.clean(testbed.with_gaps(testbed.readings(spark, sf_dir, name, clock="calendar"), sensor), sensor)


def clean_readings(name: str) -> Query:
    return lambda spark, sf_dir: cleaned(spark, sf_dir, name).drop("sensor")


def incremental_ingest(spark, sf_dir):
    """All readings against a stored history that reaches to the middle of the month."""
    known = testbed.stored(spark, sf_dir, "pollution").filter(F.col("date_partition") < F.lit("2024-01-16"))
    return clean.new_rows(cleaned(spark, sf_dir, "pollution"), known).drop("sensor")


# -- batch load -------------------------------------------------------------------------------


def land_raw(spark: SparkSession, sf_dir: str, names=ALL, where: str = "true", root: str | None = None) -> str:
    """Readings with gaps and copies as raw JSON files, a folder per sensor. Counts are written as 12.0 on
    every seventh row. ``where`` chooses the rows by ``event_id``."""
    root = root or run_dir(spark, "raw")
    for name in names:
        sensor = SENSORS[name]
        rows = testbed.with_gaps(testbed.readings(spark, sf_dir, name, clock="calendar"), sensor).filter(where)
        counts = [f.name for f in sensor.fields if f.dataType.simpleString() == "int"]
        body = F.col("value").cast("string")
        for count in counts:
            body = F.when(F.col("event_id") % 7 == 0, F.regexp_replace(body, f'("{count}":[0-9]+)', "$1.0")).otherwise(body)
        testbed.messages(rows, sensor).select(body.alias("value")).write.mode("append").text(f"{root}/{name}")
    return root


def etl_snapshot(name: str) -> Query:
    """Raw files through the batch load, twice; the stored daily aggregates."""

    def query(spark, sf_dir):
        raw, lake = land_raw(prepare(spark), sf_dir, (name,)), run_dir(spark, "lake")
        for _ in range(2):
            etl.run_all(spark, raw, lake, (name,))
        found = etl.tables.aggregated(spark, lake, name)
        means = [alias for alias, call, _ in SENSORS[name].daily if call == "avg"]
        return outward(found, *means)

    return query


def etl_processed(name: str) -> Query:
    def query(spark, sf_dir):
        raw, lake = land_raw(prepare(spark), sf_dir, (name,)), run_dir(spark, "lake")
        etl.run_all(spark, raw, lake, (name,))
        return etl.tables.processed(spark, lake, name)

    return query


def logged(spark: SparkSession, lake: str) -> DataFrame:
    log = etl.tables.table(spark, f"{lake}/run_log")
    return log.select("sensor_type", "status", "rows_processed", "snapshot_status")


def run_log(spark, sf_dir):
    """Two loads of all sensors, the second without anything new."""
    raw, lake = land_raw(prepare(spark), sf_dir, ("pollution", "traffic")), run_dir(spark, "lake")
    for _ in range(2):
        etl.run_all(spark, raw, lake)
    return logged(spark, lake)


def daily_of(name: str) -> Query:
    def query(spark, sf_dir):
        means = [alias for alias, call, _ in SENSORS[name].daily if call == "avg"]
        return outward(daily.daily_by_name(testbed.stored(spark, sf_dir, name), name), *means)

    return query


# -- history ----------------------------------------------------------------------------------


def bases(spark: SparkSession, sf_dir: str) -> history.Bases:
    """Sums of both sensors, each from one scan of its readings."""
    air = history.pollution_base(testbed.stored(spark, sf_dir, "pollution"))
    cars = history.traffic_base(testbed.stored(spark, sf_dir, "traffic"))
    return history.Bases(stored(air, "pollution-base"), stored(cars, "traffic-base"))


def ranking(spark, sf_dir):
    return history.pollution_by_zone(history.pollution_base(testbed.stored(spark, sf_dir, "pollution")))


def profile(spark, sf_dir):
    return history.traffic_by_hour(history.traffic_base(testbed.stored(spark, sf_dir, "traffic")))


def paired(spark, sf_dir):
    return history.traffic_pollution_daily(
        history.pollution_base(testbed.stored(spark, sf_dir, "pollution")),
        history.traffic_base(testbed.stored(spark, sf_dir, "traffic")),
    )


def pollution_by_zone(spark, sf_dir):
    return outward(ranking(spark, sf_dir), "avg_aqi", "avg_co2", "avg_pm25")


def zone_extremes(spark, sf_dir):
    return outward(history.zone_extremes(ranking(spark, sf_dir)), "worst_aqi", "best_aqi")


def traffic_by_hour(spark, sf_dir):
    return outward(profile(spark, sf_dir), "avg_vehicles", "avg_speed")


def peak_hour(spark, sf_dir):
    return outward(history.peak_hour(profile(spark, sf_dir)), "avg_vehicles", "avg_speed")


def hour_table_head(spark, sf_dir):
    """The report's hourly table: its first ten hours."""
    return outward(profile(spark, sf_dir).limit(10), "avg_vehicles", "avg_speed")


def traffic_pollution_daily(spark, sf_dir):
    return outward(paired(spark, sf_dir), "avg_aqi", "avg_vehicles")


def traffic_pollution_corr(spark, sf_dir):
    return outward(history.traffic_pollution_corr(paired(spark, sf_dir)), "traffic_pollution_corr")


def facts(spark, sf_dir):
    return history.facts_of(bases(spark, sf_dir))


def report_facts(spark, sf_dir):
    return outward(facts(spark, sf_dir), "value")


def report_recommendations(spark, sf_dir):
    return history.recommendations(facts(spark, sf_dir))


def report_from_lake(spark, sf_dir):
    """Raw files through the batch load into the report, whose summaries are stored and read back."""
    names = ("pollution", "traffic")
    raw, lake = land_raw(prepare(spark), sf_dir, names), run_dir(spark, "lake")
    etl.run_all(spark, raw, lake, names)
    return outward(report.build(spark, lake).facts, "value")


# -- points and dashboards --------------------------------------------------------------------


def points_long(spark, sf_dir):
    return outward(points.reading_points(testbed.readings(spark, sf_dir), chosen(ALL)))


def untidy_messages(spark, sf_dir) -> DataFrame:
    """Messages as careless devices send them: numbers as text, missing tags, bad times, no JSON."""
    rows = testbed.readings(spark, sf_dir)
    way = F.col("event_id") % 11
    number = {"pollution": "air_quality_index", "traffic": "vehicles_per_min", "eclairage": "luminosity_lux"}
    fields = {}
    for field in wide_schema().fieldNames():
        fields[field] = F.col(field).cast("string")
    for field in number.values():
        plain = F.col(field).cast("string")
        fields[field] = (
            F.when(way == 1, F.concat(plain, F.lit(".0")))
            .when(way == 2, F.lit("n/a"))
            .when(way == 3, F.lit("5d"))
            .when(way == 4, F.lit("true"))
            .when(way == 5, F.lit(None).cast("string"))
            .otherwise(plain)
        )
    fields["zone"] = F.when(way != 6, F.col("zone"))
    fields["device_id"] = F.when(way != 7, F.col("device_id"))
    fields["timestamp"] = F.when(way == 8, "bad").when(way != 9, F.col("timestamp"))
    fields["status"] = F.when(way == 5, F.lit(None).cast("string")).otherwise(F.upper("status"))
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    value = F.when(F.col("event_id") % 23 == 0, "[1]").when(F.col("event_id") % 29 == 0, "{bad").otherwise(body)
    return rows.select("event_id", "sensor", sent(led(value)), F.col("event_time").alias("arrival"))


def points_lenient(spark, sf_dir):
    rows = parse.decode_any(untidy_messages(spark, sf_dir), F.col("sensor"), text=True, keep=("arrival",))
    return outward(points.reading_points(rows, chosen(ALL), arrival=F.col("arrival")))


def points_pivot(spark, sf_dir):
    fields = ("co2_ppm", "pm25", "aqi")
    long = points.reading_points(testbed.readings(spark, sf_dir, "pollution"), chosen(("pollution",)))
    return outward(dashboard.pivot_fields(long, fields, ("zone", "device_id")))


def panel(build, name: str, back: str, fields: tuple[str, ...], *means: str) -> Query:
    def query(spark, sf_dir):
        rows, now = testbed.recent(spark, sf_dir, back, name)
        return outward(build(points.reading_points(rows, chosen((name,)), fields), now), *means)

    return query


def stored_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """(the points that the stream stored, by measurement and day; the newest time as ``now``)."""
    out = run_dir(spark, "points")
    rows = stream_readings(spark, sf_dir, *ALL)
    jobs.drain(jobs.reading_points(rows, chosen(ALL), f"{out}/points", f"{out}/state", ONCE))
    now = testbed.events(spark, sf_dir).agg(F.max("ts")).select(testbed.dense(F.col("max(ts)"))).first()[0]
    return prepare(spark).read.parquet(f"{out}/points"), F.lit(now).cast("timestamp")


def stored_panel(build, *means: str) -> Query:
    def query(spark, sf_dir):
        points_table, now = stored_points(spark, sf_dir)
        return outward(build(points_table, now), *means)

    return query


def newest(spark: SparkSession, sf_dir: str) -> datetime:
    """The newest time on the dense clock."""
    return testbed.events(spark, sf_dir).agg(F.max("ts")).select(testbed.dense(F.col("max(ts)"))).first()[0]


def stored_alerts(spark, sf_dir) -> tuple[DataFrame, Column]:
    """(alert points of micro-batches, one of them repeated, compacted and cleared of old files; the newest time)."""
    found, now = points.alert_points(alerts_of(spark, sf_dir)), newest(spark, sf_dir)
    store = jobs.alert_store(spark, run_dir(spark, "points"))
    sink = sinks.point_batches(store, "alerts", lambda rows: rows)
    for batch_id, late in ((0, False), (1, True), (1, True)):
        sink(found.filter((F.col("time") >= F.lit(now) - F.expr("INTERVAL 3 hours")) == F.lit(late)), batch_id)
    store.compact()
    store.vacuum(timedelta(0))
    return store.read(), F.lit(now).cast("timestamp")


def rolled(spark: SparkSession, sf_dir: str):
    """(points, minute rollups, newest time) as the stream keeps them: three micro-batches, of which the later ones
    bring points of all the minutes that the first one has written; the rollups are compacted."""
    out, rows = run_dir(spark, "rollups"), testbed.readings(prepare(spark), sf_dir)
    own = backfill(spark)
    stream, (store, rollup) = None, jobs.point_stores(own, f"{out}/lake")
    for turn, digits in enumerate(((0, 1, 2, 3, 4, 5), (6, 7, 8), (9,))):
        rows.filter((F.col("event_id") % 10).isin(*digits)).write.parquet(f"{out}/in/turn={turn}")
        stream = stream or own.readStream.schema(rows.schema).parquet(f"{out}/in/*")
        # A run takes all files that came since the last one as one micro-batch, so a turn may be written by many tasks.
        jobs.drain(jobs.rolled_points(stream, chosen(ALL), store, rollup, f"{out}/state", ONCE))
    rollup.compact()
    return store, rollup, newest(spark, sf_dir)


def rollup_panel(build, back: str, *means: str) -> Query:
    """A panel from minute rollups."""

    def query(spark, sf_dir):
        store, rollup, now = rolled(spark, sf_dir)
        days = ((now - timedelta(hours=2)).date(), now.date())
        at = F.lit(now).cast("timestamp")
        return outward(build(rollups.near(rollup.read(*days), store.read(*days), at, back), at), *means)

    return query


def dash_active_alerts_stored(spark, sf_dir):
    found, now = stored_alerts(spark, sf_dir)
    return outward(dashboard.alert_table(dashboard.newest_per_series(dashboard.active_alerts(found, now))))


def active(spark, sf_dir) -> DataFrame:
    rows, now = testbed.recent(spark, sf_dir, "2 hours", *ALL)
    found = points.alert_points(windows.alerts(rows, chosen(ALL)))
    return dashboard.active_alerts(found, now)


def dash_active_alerts(spark, sf_dir):
    return outward(dashboard.alert_table(dashboard.newest_per_series(active(spark, sf_dir))))


def dash_active_alerts_top50(spark, sf_dir):
    return outward(dashboard.alert_table(dashboard.newest(active(spark, sf_dir))))


def threshold_bands(spark, sf_dir):
    fields = ("aqi", "vehicles_per_min", "fill_percent", "faulty_count", "power_kw")
    long = points.reading_points(testbed.readings(spark, sf_dir), chosen(ALL), fields)
    return (
        dashboard.with_colour(long)
        .groupBy("measurement", "zone", "field", "colour")
        .agg(F.count(F.lit(1)).alias("nb_points"))
    )


def congestion_check(spark, sf_dir):
    """Carried congestion, wrong on every 19th reading, against the band of the count."""
    carried = F.when(F.col("event_id") % 19 == 0, "high").otherwise(F.col("congestion"))
    rows = testbed.stored(spark, sf_dir, "traffic").withColumn("band", bands.congestion(F.col("vehicles_per_min")))
    return rows.withColumn("congestion", carried).groupBy("heure", "band").agg(
        F.count(F.lit(1)).alias("nb"), F.count_if(F.col("band") != F.col("congestion")).alias("nb_ecarts")
    )


def bin_check(spark, sf_dir):
    """The carried full-bin mark, wrong on every 17th reading, against the fill level."""
    carried = F.when(F.col("event_id") % 17 == 0, "true").otherwise(F.col("alert"))
    rows = testbed.stored(spark, sf_dir, "dechets").withColumn("plein", bands.bin_full(F.col("fill_percent")))
    return rows.withColumn("alert", carried).groupBy("zone", "plein").agg(
        F.count(F.lit(1)).alias("nb"), F.count_if(F.col("plein") != F.col("alert")).alias("nb_ecarts")
    )


# -- device bridge ----------------------------------------------------------------------------


def hub_rows(source: DataFrame) -> DataFrame:
    """Hub events with message headers: a third without a hub id, a third with ``unknown``, the rest in upper case."""
    parts = {kind: SENSORS[name].device_prefix for name, kind in testbed.EVENT_TYPES.items()}
    prefix = F.lit("other")
    for kind, part in parts.items():
        prefix = F.when(F.col("event_type") == kind, part).otherwise(prefix)
    device = F.concat(prefix, F.lit("_"), testbed.zone_of(F.col("user_id")))
    way = F.col("event_id") % 3
    hub_id = F.when(way == 0, F.upper(device)).otherwise("unknown").cast("binary").alias("value")
    other = F.struct(F.lit("content-type").alias("key"), F.lit("json").cast("binary").alias("value"))
    named = F.struct(F.lit(streams.HUB_DEVICE_HEADER).alias("key"), hub_id)
    events = source.select(
        "event_id",
        F.to_json(F.struct(device.alias("device_id"), F.col("value"))).alias("value"),
        F.when(way == 2, F.array(other)).otherwise(F.array(other, named)).alias("headers"),
    )
    return streams.hub_device(events, keep=("event_id",))


def device_routing(spark, sf_dir):
    found = bridge.resolved(hub_rows(testbed.events(spark, sf_dir)))
    return found.select("event_id", "device", "sensor")


def dead_letters(spark, sf_dir):
    _, letters = bridge.split_routes(hub_rows(testbed.events(spark, sf_dir)))
    return letters.groupBy("device").agg(F.count(F.lit(1)).alias("nb"))


# -- alerts downstream ------------------------------------------------------------------------


def records_of(spark, sf_dir) -> DataFrame:
    return ops.records(alerts_of(spark, sf_dir))


def arrival() -> Column:
    """A repeatable arrival time: five minutes after the window, plus its minute in seconds."""
    late = F.make_dt_interval(secs=F.minute("debut_fenetre").cast("decimal(18,6)"))
    return F.col("fin_fenetre") + F.expr("INTERVAL 5 minutes") + late


def routed_alerts(spark, sf_dir):
    kept = ("debut_fenetre", "zone", "type_capteur", "alert_level", "destinataire", "canal", "delai_max_min")
    return outward(ops.routed(records_of(spark, sf_dir)).select(*kept))


def notification_outbox(spark, sf_dir):
    return outward(ops.outbox(records_of(spark, sf_dir), enabled=True))


def alert_display(spark, sf_dir):
    return outward(ops.display(records_of(spark, sf_dir)))


def alert_counts(spark, sf_dir):
    return ops.counts(records_of(spark, sf_dir))


def alert_latency(spark, sf_dir):
    return outward(ops.latency(records_of(spark, sf_dir), arrival()), "latence_moy")


def alert_arrival_points(spark, sf_dir):
    return outward(points.arrival_points(records_of(spark, sf_dir), arrival()))


def alert_incidents(spark, sf_dir):
    return outward(ops.incidents(alerts_of(spark, sf_dir)))


# -- streams ----------------------------------------------------------------------------------

ONCE = {"availableNow": True}


def backfill(spark: SparkSession) -> SparkSession:
    """A stream session as wide as the session's own shuffles: a query takes a whole table in one micro-batch."""
    return jobs.stream_session(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stream_readings(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return testbed.as_readings(testbed.event_stream(backfill(spark), sf_dir), chosen(names))


def stream_alerts(name: str) -> Query:
    """Alert stream of one sensor into a file table, read back."""

    def query(spark, sf_dir):
        out = run_dir(spark, "stream")
        found = windows.alerts(stream_readings(spark, sf_dir, name), chosen((name,)))
        writer = found.drop("sensor").writeStream.format("parquet").outputMode("append").trigger(**ONCE)
        jobs.drain(writer.option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").start())
        return outward(prepare(spark).read.parquet(f"{out}/rows"))

    return query


def stream_pipeline_points(spark, sf_dir):
    """Alerts and trends of all sensors through the fan-out into one point table."""
    out = run_dir(spark, "stream")
    started = jobs.alert_pipeline(
        stream_readings(spark, sf_dir, *ALL), chosen(ALL), f"{out}/points", f"{out}/state", trigger=ONCE
    )
    for query in started:
        jobs.drain(query)
    found = prepare(spark).read.parquet(f"{out}/points")
    return outward(found.select("time", "zone", "niveau", "type", "valeur"))


def stream_lagging_sensor(spark, sf_dir):
    """Alerts of two sensors, one of which is read three hours behind the other: files of three hours
    each, a file per micro-batch. Each sensor has a watermark of its own, so none of the slow one's alerts is lost."""
    out, names = run_dir(spark, "stream"), ("pollution", "dechets")
    rows = testbed.readings(prepare(spark), sf_dir, *names)
    step = F.floor((F.unix_micros("event_time") - F.lit(testbed.EPOCH)) / F.lit(3 * 3_600_000_000))
    turn = (step + F.when(F.col("sensor") == "dechets", 1).otherwise(0)).cast("int")
    # Spark reads files in the order of their times, so they are written one turn after another.
    for (number,) in sorted(rows.select(turn.alias("t")).distinct().collect()):
        rows.filter(turn == number).coalesce(1).write.parquet(f"{out}/in/turn={number:03d}")
    own = backfill(spark)
    stream = own.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{out}/in/*")
    where = (f"{out}/points", f"{out}/state")
    started = jobs.alert_pipeline(stream, chosen(names), *where, message_fmt="text", message_options={"path": f"{out}/log"}, trigger=ONCE)
    for query in started:
        jobs.drain(query)
    return outward(ops.unpacked(prepare(spark).read.text(f"{out}/log")))


def stream_rejects(spark, sf_dir):
    """Untidy messages on the topics of a stream: what gives no reading, with its raw text and reason."""
    out = run_dir(spark, "stream")
    topic = F.concat(F.lit(f"{TOPIC_PREFIX}-"), F.col("sensor"))
    lost = untidy_messages(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 31 == 0, "other").otherwise(topic).alias("topic"), "value")
    lost.write.parquet(f"{out}/in")
    stream = backfill(spark).readStream.schema(lost.schema).parquet(f"{out}/in")
    jobs.drain(jobs.reject_log(stream, f"{out}/rejects", f"{out}/state", trigger=ONCE))
    found = prepare(spark).read.parquet(f"{out}/rejects")
    return found.groupBy("topic", "sensor", "reject_reason").agg(F.count(F.lit(1)).alias("nb"), F.count("value").alias("nb_textes"))


def stream_alert_log(spark, sf_dir):
    """Alert messages written as JSON text by the stream, parsed back."""
    out = run_dir(spark, "stream")
    found = windows.alerts(stream_readings(spark, sf_dir, "dechets"), chosen(("dechets",)))
    jobs.drain(sinks.alert_log(found, "text", {"path": f"{out}/log"}, f"{out}/state").trigger(**ONCE).start())
    return outward(ops.unpacked(prepare(spark).read.text(f"{out}/log")))


def stream_points(spark, sf_dir):
    out = run_dir(spark, "stream")
    rows = stream_readings(spark, sf_dir, *ALL)
    jobs.drain(jobs.reading_points(rows, chosen(ALL), f"{out}/points", f"{out}/state", ONCE))
    found = prepare(spark).read.parquet(f"{out}/points")
    return outward(found.select(*points.POINT_COLUMNS))


def published_alerts(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """A stream of alert records over messages published by the batch pipeline."""
    ops.packed(records_of(spark, sf_dir)).write.text(f"{out}/topic")
    return ops.unpacked(backfill(spark).readStream.text(f"{out}/topic"))


def stream_alert_counts(spark, sf_dir):
    """Running counts of the job, kept in memory (as it refreshes them for a display) and read at the end."""
    out, name = run_dir(spark, "stream"), "counts_" + uuid.uuid4().hex
    records = published_alerts(spark, sf_dir, out)
    jobs.drain(jobs.alert_counts(records, "memory", name, f"{out}/state", trigger=ONCE))
    return records.sparkSession.table(name)


def stream_incidents(spark, sf_dir):
    out = run_dir(spark, "stream")
    ended = jobs.incidents(published_alerts(spark, sf_dir, out))
    writer = ended.writeStream.format("parquet").outputMode("append").trigger(**ONCE)
    jobs.drain(writer.option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").start())
    return outward(spark.read.parquet(f"{out}/rows"))


def stream_incidents_resolved(spark, sf_dir):
    """Incidents that open and end; after the last alert the topic is silent, and timers end what is open."""
    out = run_dir(spark, "stream")
    query = jobs.incident_log(published_alerts(spark, sf_dir, out), f"{out}/events", f"{out}/state", silence="2 seconds")
    jobs.settled(query)
    return outward(prepare(spark).read.parquet(f"{out}/events"))


def stream_supervised(spark, sf_dir):
    """Alerts of a query whose sink fails twice; the supervisor starts it again from its checkpoint."""
    out, failures = run_dir(spark, "stream"), [1, 2]
    found = windows.alerts(stream_readings(spark, sf_dir, "traffic"), chosen(("traffic",))).drop("sensor")

    def sink(batch: DataFrame, batch_id: int) -> None:
        if failures:
            raise RuntimeError(f"failure {failures.pop(0)}")
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    def start():
        writer = found.writeStream.queryName("alerts_traffic").foreachBatch(sink).option("checkpointLocation", f"{out}/state")
        return writer.trigger(**ONCE).start()

    Supervisor(found.sparkSession, {"alerts_traffic": start}, f"{out}/health", wait=0.1).run(every=0.2)
    return outward(prepare(spark).read.parquet(f"{out}/rows").drop("batch"))


#: From this hour on, red alerts take another route.
NEW_ROUTE_HOUR = 6


def stream_routed_alerts(spark, sf_dir):
    """Alerts in two parts through a running route; between them the route table gets a new version."""
    out = run_dir(prepare(spark), "stream")
    records, early = records_of(spark, sf_dir), F.hour("debut_fenetre") < NEW_ROUTE_HOUR
    routes = ops.route_table(spark)
    red = F.col("alert_level") == "ROUGE"
    changed = routes.withColumns({"canal": F.when(red, "Astreinte").otherwise(F.col("canal")), "delai_max_min": F.when(red, 1).otherwise(F.col("delai_max_min"))})
    stream = None
    for table, part in ((routes, records.filter(early)), (changed, records.filter(~early))):
        ops.packed(part).write.mode("append").text(f"{out}/topic")
        tables.add_version(table, f"{out}/routes")
        stream = stream or ops.unpacked(backfill(spark).readStream.text(f"{out}/topic"))
        jobs.drain(jobs.alert_routing(stream, f"{out}/routes", f"{out}/rows", f"{out}/state", ONCE))
    kept = ("debut_fenetre", "zone", "type_capteur", "alert_level", "destinataire", "canal", "delai_max_min")
    return outward(spark.read.parquet(f"{out}/rows").select(*kept))


def stream_latency(spark, sf_dir):
    """Latency from the time at which messages arrived, which they carry, over two micro-batches."""
    out = run_dir(prepare(spark), "stream")
    topics = streams.Folder(f"{out}/topics", files_per_batch=1)
    sent = ops.packed(records_of(spark, sf_dir).withColumn("timestamp", arrival()), "timestamp", "debut_fenetre")
    for part in (0, 1):
        topics.publish(sent.filter(F.minute("debut_fenetre") % 2 == part).coalesce(1), alert_topic())
    records = streams.alert_messages(backfill(spark), topics, keep=("timestamp",))
    jobs.drain(jobs.latency_log(records, "timestamp", f"{out}/partials", f"{out}/state", ONCE))
    return outward(ops.latency_report(spark.read.parquet(f"{out}/partials")), "latence_moy")


def stream_alert_topic(spark, sf_dir):
    """Readings from their topics, alerts of each sensor to the alert topic, records read from there."""
    out = run_dir(prepare(spark), "stream")
    topics = streams.Folder(f"{out}/topics")
    for name in ALL:
        topics.publish(testbed.messages(testbed.readings(spark, sf_dir, name), SENSORS[name]), topic_of(name))
    own = backfill(spark)
    readings = {s.name: streams.sensor_topic(own, topics, s) for s in chosen(ALL)}
    started = jobs.alert_pipeline(readings, chosen(ALL), jobs.alert_store(own, f"{out}/points"), f"{out}/state", message_options=topics, trigger=ONCE)
    for query in started:
        jobs.drain(query)
    writer = streams.alert_messages(own, topics).writeStream.format("parquet").trigger(**ONCE)
    jobs.drain(writer.option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state/records").start())
    return outward(spark.read.parquet(f"{out}/rows"))


def stream_bridge(spark, sf_dir):
    """Device events through the bridge into topic folders; messages per topic."""
    out = run_dir(spark, "stream")
    source = hub_rows(testbed.event_stream(backfill(spark), sf_dir))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.select("topic", "value").write.mode("overwrite").partitionBy("topic").text(f"{out}/topics/batch={batch_id}")

    jobs.drain(jobs.device_bridge(source, publish, f"{out}/letters", f"{out}/state", trigger=ONCE))
    published = prepare(spark).read.text(f"{out}/topics")
    letters = spark.read.parquet(f"{out}/letters")
    counted = published.groupBy("topic").agg(F.count(F.lit(1)).alias("nb"))
    return counted.unionByName(letters.agg(F.count(F.lit(1)).alias("nb")).select(F.lit("none").alias("topic"), "nb"))


def stream_landing(spark, sf_dir):
    """Readings landed as raw JSON by the stream, read back under the fixed schema."""
    out = run_dir(spark, "stream")
    rows = stream_readings(spark, sf_dir, *ALL)
    body = F.to_json(F.struct(*wide_schema().fieldNames()))
    messages = rows.select("sensor", body.alias("value"))
    jobs.drain(sinks.raw_landing(messages, f"{out}/raw", f"{out}/state").trigger(**ONCE).start())
    return etl.tables.raw_readings(prepare(spark), f"{out}/raw", SENSORS["dechets"])


SPOILED = ("not json", '{"device_id":"d","timestamp":"12:30"}', '{"timestamp":"2024-01-01T00:00:00Z"}', "[1]")


def loaded_twice(spark: SparkSession, sf_dir: str, names=ALL) -> str:
    """Raw files that arrive in two parts, each with lines that cannot be stored, through the incremental job."""
    raw, lake = run_dir(prepare(spark), "raw"), run_dir(spark, "lake")
    for part in (0, 1):
        land_raw(spark, sf_dir, names, f"event_id % 2 = {part}", raw)
        for name in names:
            bad = [(line,) for line in SPOILED[part:]]
            spark.createDataFrame(bad, "value string").coalesce(1).write.mode("append").text(f"{raw}/{name}")
            etl.load_new_files(spark, raw, lake, SENSORS[name], f"{lake}/state/{name}")
    return lake


def stream_load(name: str) -> Query:
    """The stored daily aggregates after two incremental loads."""

    def query(spark, sf_dir):
        found = etl.tables.aggregated(spark, loaded_twice(spark, sf_dir, (name,)), name)
        means = [alias for alias, call, _ in SENSORS[name].daily if call == "avg"]
        return outward(found, *means)

    return query


def load_rejects(spark, sf_dir):
    """Rejects of both loads, with their raw text."""
    lake, parts = loaded_twice(spark, sf_dir, ("pollution", "traffic")), []
    for name in ("pollution", "traffic"):
        parts.append(prepare(spark).read.parquet(f"{lake}/rejects/{name}").select(F.lit(name).alias("sensor"), "batch", "value", "reject_reason"))
    return parts[0].unionByName(parts[1])


def load_run_log(spark, sf_dir):
    """The run log of the incremental job: a row per batch."""
    return logged(spark, loaded_twice(spark, sf_dir, ("eclairage", "dechets")))


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name in ALL:
        found[f"alerts_{name}_5min"] = sensor_alerts(name)
        found[f"trends_{name}_15min"] = sensor_trends(name)
        found[f"messages_{name}"] = sensor_messages(name)
        found[f"clean_{name}"] = clean_readings(name)
        found[f"daily_{name}"] = daily_of(name)
        found[f"etl_snapshot_{name}"] = etl_snapshot(name)
        found[f"etl_processed_{name}"] = etl_processed(name)
        found[f"stream_alerts_{name}"] = stream_alerts(name)
        found[f"stream_load_{name}"] = stream_load(name)
    plain = (
        all_alerts_union, alert_json, alert_and_trend_points, rule_attribution,
        topic_readings, event_times, rejected_readings, incremental_ingest, run_log,
        pollution_by_zone, zone_extremes, traffic_by_hour, peak_hour, hour_table_head,
        traffic_pollution_daily, traffic_pollution_corr, report_facts, report_recommendations,
        report_from_lake,
        points_long, points_lenient, points_pivot, threshold_bands, congestion_check, bin_check,
        dash_active_alerts, dash_active_alerts_top50, device_routing, dead_letters,
        routed_alerts, notification_outbox, alert_display, alert_counts, alert_latency,
        alert_arrival_points, alert_incidents,
        dash_active_alerts_stored, load_rejects, load_run_log,
        stream_pipeline_points, stream_lagging_sensor, stream_rejects, stream_alert_log, stream_points,
        stream_alert_counts, stream_incidents, stream_bridge, stream_landing,
        stream_incidents_resolved, stream_supervised, stream_routed_alerts, stream_latency, stream_alert_topic,
    )
    for query in plain:
        found[query.__name__] = query
    found["dash_aqi_latest"] = panel(dashboard.aqi_panel, "pollution", "15 minutes", ("aqi",), "value")
    found["dash_traffic_ts"] = panel(dashboard.traffic_panel, "traffic", "30 minutes", ("vehicles_per_min",), "value")
    found["dash_pollution_ts"] = panel(
        dashboard.pollution_panel, "pollution", "30 minutes", ("co2_ppm", "pm25"), "value"
    )
    found["dash_fill_latest"] = panel(dashboard.fill_panel, "dechets", "1 hour", ("fill_percent",), "value")
    found["dash_lighting_latest"] = panel(
        dashboard.lighting_panel, "eclairage", "30 minutes", ("faulty_count", "power_kw"), "value"
    )
    stored_panels = {
        "dash_aqi_latest": dashboard.aqi_panel,
        "dash_traffic_ts": dashboard.traffic_panel,
        "dash_pollution_ts": dashboard.pollution_panel,
        "dash_fill_latest": dashboard.fill_panel,
        "dash_lighting_latest": dashboard.lighting_panel,
    }
    ranges = {"dash_aqi_latest": "15 minutes", "dash_fill_latest": "1 hour"}
    for name, build in stored_panels.items():
        found[f"{name}_stored"] = stored_panel(build, "value")
        found[f"{name}_rollup"] = rollup_panel(build, ranges.get(name, "30 minutes"), "value")
    return found
