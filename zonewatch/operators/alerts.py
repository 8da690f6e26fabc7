"""What happens to alerts: records, counts, latency, routing, notification, incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonewatch import settings
from zonewatch.functions import grading
from zonewatch.sensors import by_sensor
from zonewatch.settings import GREEN, ORANGE, RED

RECORD_COLUMNS = (
    "debut_fenetre",
    "fin_fenetre",
    "zone",
    "alert_level",
    "alert_message",
    "type_capteur",
    "valeur_detectee",
)
RECORD_SCHEMA = (
    "debut_fenetre timestamp, fin_fenetre timestamp, zone string, alert_level string, "
    "alert_message string, type_capteur string, valeur_detectee double"
)
INCIDENT_KEYS = ("zone", "type_capteur")
ROUTE_SCHEMA = "type_capteur string, alert_level string, destinataire string, canal string, delai_max_min int"
BROADCAST_ROUTES = 10_000


def records(alerts: DataFrame) -> DataFrame:
    """Alerts in their published form."""
    renamed = alerts.withColumnRenamed("window_start", "debut_fenetre").withColumnRenamed("window_end", "fin_fenetre")
    return renamed.select(*RECORD_COLUMNS)


def packed(alert_records: DataFrame, *keep: str) -> DataFrame:
    """One JSON text per record in ``value``; null fields are left out of the text."""
    return alert_records.select(*keep, F.to_json(F.struct(*RECORD_COLUMNS)).alias("value"))


def as_messages(alert_records: DataFrame, topic: str) -> DataFrame:
    """Records as messages of a topic, keyed by zone: a zone's alerts stay in order."""
    return packed(alert_records.select("*", F.col("zone").cast("binary").alias("key")), "key").select(F.lit(topic).alias("topic"), "key", F.col("value").cast("binary").alias("value"))


def unpacked(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records from published messages, with the columns ``keep`` of the message."""
    return messages.select(*keep, F.from_json(F.col("value").cast("string"), RECORD_SCHEMA).alias("a")).select(*keep, "a.*")


def serving(alert_records: DataFrame) -> DataFrame:
    """Records that call for action; a missing level counts as normal."""
    return alert_records.filter(F.coalesce(F.col("alert_level"), F.lit(GREEN)).isin(ORANGE, RED))


def all_points(alert_rows: DataFrame, trend_rows: DataFrame, to_points) -> DataFrame:
    """Alerts and trends together, in point form."""
    return to_points(alert_rows).unionByName(to_points(trend_rows), allowMissingColumns=True)


def attributed(alerts: DataFrame, sensors) -> DataFrame:
    """One row per alert window and numbered rule that fired, with the value that fired it."""
    fired = alerts.withColumn("rule", F.explode(by_sensor(grading.fired_rules, sensors))).filter("rule IS NOT NULL")
    return fired.select("window_start", "window_end", "zone", "type_capteur", "rule.*")


def route_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(settings.ROUTES), ROUTE_SCHEMA)


def routed(alerts: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Alerts with recipient, channel and allowed delay. The built-in route table has a fixed eight rows; a given one is
    counted, up to ``BROADCAST_ROUTES``, before it is broadcast, and joined by a shuffle beyond that."""
    if routes is None:
        routes = F.broadcast(route_table(alerts.sparkSession))
    elif routes.limit(BROADCAST_ROUTES + 1).count() <= BROADCAST_ROUTES:
        routes = F.broadcast(routes)
    return alerts.join(routes, ["type_capteur", "alert_level"], "left")


def display(alert_records: DataFrame) -> DataFrame:
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("?"))

    return serving(alert_records).select(
        shown("alert_level").alias("niveau"),
        F.upper(shown("zone")).alias("zone"),
        shown("type_capteur").alias("capteur"),
        shown("alert_message").alias("message"),
        F.col("valeur_detectee").alias("valeur"),
        F.col("debut_fenetre").alias("debut"),
    )


def outbox(alert_records: DataFrame, enabled: bool = False, label: str = settings.TOPIC_PREFIX) -> DataFrame:
    """Notifications for red alerts, ready for a mail service. Off unless enabled."""
    red = alert_records.filter((F.col("alert_level") == RED) & F.lit(enabled))
    zone = F.coalesce(F.col("zone"), F.lit("?"))
    sensor = F.coalesce(F.col("type_capteur"), F.lit("?"))
    return red.select(
        F.format_string("🚨 [%s] ALERTE ROUGE — %s (%s)", F.lit(label), F.upper(zone), sensor).alias("subject"),
        zone.alias("zone"),
        sensor.alias("capteur"),
        F.coalesce(F.col("alert_message"), F.lit("Alerte critique")).alias("message"),
        F.col("valeur_detectee").alias("valeur"),
        F.col("debut_fenetre").alias("debut"),
    )


def counts(alert_records: DataFrame) -> DataFrame:
    """Alerts per level and in total.

    On a table the levels are counted first, so the total is made from a handful of rows;
    on a stream the rollup is the one stateful aggregation.
    """
    level = F.coalesce(F.col("alert_level"), F.lit("total")).alias("alert_level")
    ours = serving(alert_records)
    if ours.isStreaming:
        return ours.rollup("alert_level").agg(F.count(F.lit(1)).alias("nb_alertes")).select(level, "nb_alertes")
    per_level = ours.groupBy("alert_level").agg(F.count(F.lit(1)).alias("n"))
    totals = per_level.rollup("alert_level").agg(F.sum("n").alias("nb_alertes"))
    return totals.select(level, F.coalesce("nb_alertes", F.lit(0)).cast("long").alias("nb_alertes"))


def latency(alert_records: DataFrame, arrival: Column) -> DataFrame:
    """Seconds from window start to arrival per sensor, and whether the worst meets the target."""
    micros = F.unix_micros(arrival) - F.unix_micros(F.col("debut_fenetre"))
    seconds = alert_records.select("type_capteur", (micros / F.lit(1e6)).alias("s"))
    return seconds.groupBy("type_capteur").agg(
        F.count("s").alias("nb_alertes"),
        F.min("s").alias("latence_min"),
        F.avg("s").alias("latence_moy"),
        F.max("s").alias("latence_max"),
        (F.max("s") < settings.LATENCY_TARGET_SECONDS).alias("objectif_atteint"),
    )


def latency_partials(alert_records: DataFrame, arrival: Column) -> DataFrame:
    """Latencies of a micro-batch per sensor in a form that adds up: number, extremes, sum, and a sketch of quantiles."""
    micros = F.unix_micros(arrival) - F.unix_micros(F.col("debut_fenetre"))
    seconds = alert_records.select("type_capteur", (micros / F.lit(1e6)).alias("s")).filter("s IS NOT NULL")
    return seconds.groupBy("type_capteur").agg(
        F.count("s").alias("nb"),
        F.min("s").alias("least"),
        F.max("s").alias("most"),
        F.sum("s").alias("total"),
        F.kll_sketch_agg_double("s").alias("sketch"),
    )


def latency_report(partials: DataFrame, quantiles: tuple[float, ...] = ()) -> DataFrame:
    """The same columns as ``latency`` from partials of any number of micro-batches, and the wanted quantiles. For those, a
    sensor's sketches meet in one row, some kilobytes per micro-batch."""
    rest = F.slice("sketches", F.lit(2), F.size("sketches"))
    merge = F.reduce(rest, F.col("sketches")[0], lambda a, b: F.kll_sketch_merge_double(a, b))
    found = partials.groupBy("type_capteur").agg(
        F.sum("nb").alias("nb_alertes"),
        F.min("least").alias("latence_min"),
        F.try_divide(F.sum("total"), F.sum("nb")).alias("latence_moy"),
        F.max("most").alias("latence_max"),
        *([F.collect_list("sketch").alias("sketches")] if quantiles else []),
    )
    shown = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"latence_q{100 * q:g}") for q in quantiles]
    if quantiles:
        found = found.withColumn("sketch", merge)
    goal = (F.col("latence_max") < settings.LATENCY_TARGET_SECONDS).alias("objectif_atteint")
    return found.select("type_capteur", "nb_alertes", "latence_min", "latence_moy", "latence_max", goal, *shown)


def incidents(alerts: DataFrame, gap: str = settings.INCIDENT_GAP, chunk: str = "1 day") -> DataFrame:
    """Runs of alert windows per zone and sensor; a run ends when no window starts within ``gap``.

    A zone's whole history never meets in one task. Runs are built inside time chunks first.
    Only the first and last run of a chunk can touch a neighbour chunk, so only those, at most
    two per chunk, are merged along the series; all others are final. ``chunk`` must exceed ``gap``.
    """
    step = F.expr(f"INTERVAL {gap}")
    keys = list(INCIDENT_KEYS)
    chunked = alerts.select(
        *keys,
        F.window("window_start", chunk).start.alias("chunk"),
        "window_start",
        "window_end",
        (F.col("alert_level") == RED).cast("long").alias("red"),
        "valeur_detectee",
    )
    in_chunk = W.partitionBy(*keys, "chunk").orderBy("window_start")
    opens = F.lag("window_start").over(in_chunk) + step < F.col("window_start")
    runs = (
        chunked.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("opens").over(in_chunk))
        .groupBy(*keys, "chunk", "run")
        .agg(
            F.min("window_start").alias("first_start"),
            F.max("window_start").alias("last_start"),
            F.max("window_end").alias("last_end"),
            F.count(F.lit(1)).alias("nb_fenetres"),
            F.sum("red").alias("nb_rouge"),
            F.max("valeur_detectee").alias("valeur_max"),
        )
        .withColumn("runs", F.max("run").over(W.partitionBy(*keys, "chunk")))
    )
    at_edge = (F.col("run") == 1) | (F.col("run") == F.col("runs"))
    # An inner run is its own group; the runs at chunk edges share one group per series.
    grouped = runs.withColumn("own", F.when(~at_edge, F.col("first_start")))
    along = W.partitionBy(*keys, "own").orderBy("first_start")
    reopens = F.lag("last_start").over(along) + step < F.col("first_start")
    merged = (
        grouped.withColumn("opens", F.coalesce(reopens, F.lit(True)).cast("int"))
        .withColumn("incident", F.sum("opens").over(along))
        .groupBy(*keys, "own", "incident")
        .agg(
            F.min("first_start").alias("first_start"),
            F.max("last_start").alias("last_start"),
            F.max("last_end").alias("last_end"),
            F.sum("nb_fenetres").alias("nb_fenetres"),
            F.sum("nb_rouge").alias("nb_rouge"),
            F.max("valeur_max").alias("valeur_max"),
        )
    )
    return merged.select(
        *keys,
        F.col("first_start").alias("debut"),
        F.col("last_end").alias("fin"),
        (F.col("last_start") + step).alias("resolu"),
        "nb_fenetres",
        "nb_rouge",
        "valeur_max",
    )
