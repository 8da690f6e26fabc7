"""SQL twins of the registered queries, for DuckDB over the same tables.

Written out from the definitions, not generated from the Spark code, so that the two can disagree.
"""

from __future__ import annotations

# Readings of the four sensors. ``et`` is the dense clock, ``ts`` the calendar one.
READINGS = """
WITH ev AS (
  SELECT event_id, event_type, ts, "value" AS v, user_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    ['centre_ville', 'zone_industrielle', 'residentiel', 'peripherie'][CAST(user_id % 4 AS INTEGER) + 1] AS zone,
    make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60) AS et
  FROM events),
pollution AS (
  SELECT event_id, ts, et, zone, 'pollution_' || zone AS device_id,
    350 + 5 * v AS co2_ppm, CAST(0.8 AS DOUBLE) * k AS pm25, 5 * k AS air_quality_index
  FROM ev WHERE event_type = 'view'),
traffic AS (
  SELECT event_id, ts, et, zone, 'traffic_' || zone AS device_id,
    k AS vehicles_per_min, least(v, CAST(120 AS DOUBLE)) AS avg_speed_kmh,
    CASE WHEN k > 100 THEN 'critical' WHEN k > 70 THEN 'high' WHEN k > 40 THEN 'medium' ELSE 'low' END AS congestion
  FROM ev WHERE event_type = 'click'),
eclairage AS (
  SELECT event_id, ts, et, zone, 'lighting_' || zone AS device_id,
    k AS luminosity_lux, CASE WHEN event_id % 20 = 0 THEN 'faulty' ELSE 'working' END AS status,
    floor(least(v, CAST(120 AS DOUBLE)) / 2 + CAST(0.5 AS DOUBLE)) / 100 AS power_kw
  FROM ev WHERE event_type = 'error'),
dechets AS (
  SELECT event_id, ts, et, zone, 'waste_' || zone AS device_id,
    k + CAST(0.5 AS DOUBLE) AS fill_percent,
    floor(CAST(12 AS DOUBLE) * (k + CAST(0.5 AS DOUBLE)) + CAST(0.5 AS DOUBLE)) / 10 AS weight_kg,
    CASE WHEN k + CAST(0.5 AS DOUBLE) > 90 THEN 'true' ELSE 'false' END AS alert
  FROM ev WHERE event_type = 'purchase')"""

MEANS = {
    "pollution": "round(avg(co2_ppm), 9) AS avg_co2, round(avg(pm25), 9) AS avg_pm25, "
    "round(avg(air_quality_index), 9) AS avg_aqi",
    "traffic": "round(avg(vehicles_per_min), 9) AS avg_vehicules, round(avg(avg_speed_kmh), 9) AS avg_vitesse",
    "eclairage": "round(avg(luminosity_lux), 9) AS avg_luminosite, round(avg(power_kw), 9) AS avg_conso, "
    "CAST(sum(CASE WHEN status = 'faulty' THEN 1 ELSE 0 END) AS BIGINT) AS nb_faulty",
    "dechets": "round(avg(fill_percent), 9) AS avg_remplissage, round(avg(weight_kg), 9) AS avg_poids",
}
HEADLINE = {
    "pollution": "avg_co2",
    "traffic": "avg_vehicules",
    "eclairage": "avg_luminosite",
    "dechets": "avg_remplissage",
}
LEVEL = {
    "pollution": """CASE WHEN avg_co2 >= 801 OR avg_pm25 >= 76 OR avg_aqi >= 301 THEN 'ROUGE'
      WHEN avg_co2 >= 601 OR avg_pm25 >= 36 OR avg_aqi >= 151 THEN 'ORANGE' ELSE 'VERT' END""",
    "traffic": """CASE WHEN avg_vehicules >= 61 OR avg_vitesse <= 10 THEN 'ROUGE'
      WHEN avg_vehicules >= 41 OR avg_vitesse <= 30 THEN 'ORANGE' ELSE 'VERT' END""",
    "eclairage": """CASE WHEN nb_faulty >= 1 OR avg_luminosite <= 5 OR avg_conso >= CAST(0.55 AS DOUBLE) THEN 'ROUGE'
      WHEN avg_luminosite <= 10 OR avg_conso >= CAST(0.40 AS DOUBLE) THEN 'ORANGE' ELSE 'VERT' END""",
    "dechets": """CASE WHEN avg_remplissage >= 91 OR avg_poids >= 81 THEN 'ROUGE'
      WHEN avg_remplissage >= 76 OR avg_poids >= 61 THEN 'ORANGE' ELSE 'VERT' END""",
}
TEXT = {
    "pollution": (
        "CRITIQUE pollution - CO2 eleve 5min - Service Environnement",
        "Elevation pollution - Surveillance renforcee",
    ),
    "traffic": (
        "Chaos routier soutenu 5min - Notification Police municipale",
        "Embouteillage - Ralentissement detecte",
    ),
    "eclairage": (
        "Panne eclairage detectee (status=faulty) - Intervention technique urgente",
        "Anomalie eclairage - Surveillance necessaire",
    ),
    "dechets": (
        "Poubelle saturee - Collecte immediate - Notification Voirie",
        "Poubelle presque pleine - Planifier collecte sous 2h",
    ),
}
SENSORS = ("pollution", "traffic", "eclairage", "dechets")


def windows(sensor: str, size: int, slide: int, source: str | None = None) -> str:
    return f"""
      SELECT time_bucket(to_minutes({slide}), et) - to_minutes(CAST(i * {slide} AS INTEGER)) AS window_start,
        time_bucket(to_minutes({slide}), et) - to_minutes(CAST(i * {slide} AS INTEGER)) + to_minutes({size}) AS window_end,
        zone, count(*) AS nb_mesures, {MEANS[sensor]}
      FROM {source or sensor}, range({size // slide}) AS t(i) GROUP BY ALL"""


def alerts(sensor: str, source: str | None = None) -> str:
    red, orange = TEXT[sensor]
    return f"""
    SELECT *, CASE alert_level WHEN 'ROUGE' THEN '{red}' ELSE '{orange}' END AS alert_message,
      '{sensor}' AS type_capteur, CAST({HEADLINE[sensor]} AS DOUBLE) AS valeur_detectee
    FROM (SELECT *, {LEVEL[sensor]} AS alert_level FROM ({windows(sensor, 5, 1, source)}))
    WHERE alert_level <> 'VERT'"""


def trends(sensor: str) -> str:
    return f"""
    SELECT *, '{sensor}' AS type_capteur, CAST({HEADLINE[sensor]} AS DOUBLE) AS valeur_detectee,
      'TENDANCE' AS alert_level
    FROM ({windows(sensor, 15, 5)})"""


COMMON = "window_start, window_end, zone, alert_level, alert_message, type_capteur, valeur_detectee"


def every_alert(suffix: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {COMMON} FROM ({alerts(s, s + suffix)})" for s in SENSORS)


ALERTS = f"{READINGS},\nalerts AS ({every_alert()})"
RECORDS = f"""{READINGS},
records AS (SELECT window_start AS debut_fenetre, window_end AS fin_fenetre, * EXCLUDE (window_start, window_end)
  FROM ({every_alert()}))"""
ARRIVAL = "fin_fenetre + INTERVAL 5 MINUTE + to_seconds(minute(debut_fenetre))"


def mean(column: str, alias: str) -> str:
    return f"round(avg({column}) + CAST(1e-9 AS DOUBLE), 6) AS {alias}"


FAULTS = "CAST(sum(CASE WHEN status = 'faulty' THEN 1 ELSE 0 END) AS BIGINT) AS nb_faulty"
DAILY = {
    "pollution": f"{mean('co2_ppm', 'avg_co2_ppm')}, {mean('pm25', 'avg_pm25')}, "
    f"{mean('air_quality_index', 'avg_aqi')}, max(co2_ppm) AS max_co2_ppm, max(air_quality_index) AS max_aqi",
    "traffic": f"{mean('vehicles_per_min', 'avg_vehicles_per_min')}, {mean('avg_speed_kmh', 'avg_speed_kmh')}, "
    "max(vehicles_per_min) AS max_vehicles_per_min, min(avg_speed_kmh) AS min_speed_kmh",
    "eclairage": f"{mean('luminosity_lux', 'avg_luminosity_lux')}, {mean('power_kw', 'avg_power_kw')}, {FAULTS}",
    "dechets": f"{mean('fill_percent', 'avg_fill_percent')}, {mean('weight_kg', 'avg_weight_kg')}, "
    "max(fill_percent) AS max_fill_percent, max(weight_kg) AS max_weight_kg",
}
FIELDS = {
    "pollution": ("co2_ppm", "pm25", "air_quality_index"),
    "traffic": ("vehicles_per_min", "avg_speed_kmh", "congestion"),
    "eclairage": ("luminosity_lux", "status", "power_kw"),
    "dechets": ("fill_percent", "weight_kg", "alert"),
}
REQUIRED = {
    "pollution": ("co2_ppm", "pm25"),
    "traffic": ("vehicles_per_min", "avg_speed_kmh"),
    "eclairage": ("luminosity_lux",),
    "dechets": ("fill_percent",),
}


def daily(sensor: str, source: str | None = None) -> str:
    return f"""SELECT CAST(ts AS DATE) AS date_partition, zone, count(*) AS nb_mesures, {DAILY[sensor]}
FROM {source or sensor} GROUP BY ALL"""


def iso(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def cleaned(sensor: str) -> str:
    """One row per (timestamp, device): copies and poorer copies first, then nulls dropped."""
    first, rest = FIELDS[sensor][0], ", ".join(FIELDS[sensor][1:])
    assert REQUIRED[sensor][0] == first
    filled = " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in REQUIRED[sensor])
    present = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED[sensor])
    holed = f"CASE WHEN event_id % 17 <> 0 THEN {first} END AS {first}"
    return f"""
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY ts, device_id ORDER BY {filled} DESC, event_id DESC) AS place
    FROM (
      SELECT event_id, ts, device_id, zone, {holed}, {rest} FROM {sensor}
      UNION ALL SELECT event_id, ts, device_id, zone, {holed}, {rest} FROM {sensor} WHERE event_id % 10 = 0
      UNION ALL SELECT event_id, ts, device_id, zone, NULL, {rest} FROM {sensor} WHERE event_id % 10 = 5))
  WHERE place = 1 AND {present}"""


def clean_rows(sensor: str, where: str = "") -> str:
    return f"""SELECT event_id, {iso('ts')} AS "timestamp", device_id, zone, '{sensor}' AS "type",
  {", ".join(FIELDS[sensor])}, CAST(ts AS DATE) AS date_partition, CAST(hour(ts) AS INTEGER) AS heure
FROM kept {where}"""


def history(pollution: str = "pollution", traffic: str = "traffic") -> str:
    """Report tables over the named readings, as further parts of a WITH clause."""
    return f"""ranking AS (SELECT zone, avg(air_quality_index) AS avg_aqi, avg(co2_ppm) AS avg_co2, avg(pm25) AS avg_pm25
  FROM {pollution} GROUP BY zone),
profile AS (SELECT CAST(hour(ts) AS INTEGER) AS heure, avg(vehicles_per_min) AS avg_vehicles,
    avg(avg_speed_kmh) AS avg_speed FROM {traffic} GROUP BY ALL),
paired AS (SELECT * FROM
  (SELECT CAST(ts AS DATE) AS date_partition, zone, avg(air_quality_index) AS avg_aqi FROM {pollution} GROUP BY ALL)
  JOIN (SELECT CAST(ts AS DATE) AS date_partition, zone, avg(vehicles_per_min) AS avg_vehicles FROM {traffic} GROUP BY ALL)
  USING (date_partition, zone)),
linked AS (SELECT CASE WHEN isfinite(c) THEN c END AS c FROM (SELECT corr(avg_vehicles, avg_aqi) AS c FROM paired)),
facts AS (
  SELECT * FROM (SELECT 'worst_zone' AS fact, zone AS subject, avg_aqi AS "value" FROM ranking
    WHERE avg_aqi IS NOT NULL ORDER BY avg_aqi DESC, zone LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'best_zone', zone, avg_aqi FROM ranking
    WHERE avg_aqi IS NOT NULL ORDER BY avg_aqi, zone LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'peak_hour', CAST(heure AS VARCHAR), avg_vehicles FROM profile
    WHERE avg_vehicles IS NOT NULL ORDER BY avg_vehicles DESC, heure LIMIT 1)
  UNION ALL SELECT 'traffic_pollution_corr', NULL, c FROM linked WHERE c IS NOT NULL)"""


HISTORY = f"{READINGS},\n{history()}"


def rounded(column: str, alias: str | None = None) -> str:
    return f"round({column} + CAST(1e-9 AS DOUBLE), 6) AS {alias or column}"


POINT_FIELDS = {
    "pollution": (("co2_ppm", "co2_ppm"), ("pm25", "pm25"), ("aqi", "air_quality_index")),
    "traffic": (("vehicles_per_min", "vehicles_per_min"), ("avg_speed_kmh", "avg_speed_kmh")),
    "eclairage": (
        ("luminosity_lux", "luminosity_lux"),
        ("power_kw", "power_kw"),
        ("faulty_count", "CASE WHEN lower(coalesce(status, '')) = 'faulty' THEN 1 ELSE 0 END"),
    ),
    "dechets": (
        ("fill_percent", "fill_percent"),
        ("weight_kg", "weight_kg"),
        ("alert_flag", "CASE WHEN lower(coalesce(alert, '')) = 'true' THEN 1 ELSE 0 END"),
    ),
}


def point_rows() -> str:
    parts = []
    for sensor in SENSORS:
        for field, source in POINT_FIELDS[sensor]:
            parts.append(
                f"SELECT '{sensor}' AS measurement, coalesce(zone, 'unknown') AS zone, "
                f"coalesce(device_id, 'unknown') AS device_id, '{field}' AS field, "
                f'CAST({source} AS DOUBLE) AS "value", et AS "time" FROM {sensor}'
            )
    return f'SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE "value" IS NOT NULL'


POINTS = f"{READINGS},\npoints AS ({point_rows()}),\nclock AS (SELECT max(et) AS now FROM ev)"
COLOUR = """CASE
  WHEN field = 'aqi' THEN CASE WHEN "value" >= 300 THEN 'red' WHEN "value" >= 200 THEN 'orange'
    WHEN "value" >= 100 THEN 'yellow' ELSE 'green' END
  WHEN field = 'vehicles_per_min' THEN CASE WHEN "value" >= 61 THEN 'red' WHEN "value" >= 41 THEN 'orange' ELSE 'green' END
  WHEN field = 'fill_percent' THEN CASE WHEN "value" >= 90 THEN 'red' WHEN "value" >= 70 THEN 'yellow' ELSE 'green' END
  WHEN field = 'faulty_count' THEN CASE WHEN "value" >= 1 THEN 'red' ELSE 'green' END
  WHEN field = 'power_kw' THEN CASE WHEN "value" >= CAST(0.55 AS DOUBLE) THEN 'red'
    WHEN "value" >= CAST(0.40 AS DOUBLE) THEN 'orange' ELSE 'green' END END AS colour"""


def bucketed(measurement: str, fields: tuple[str, ...], back: str, every: int) -> str:
    names = ", ".join(f"'{f}'" for f in fields)
    return f"""{POINTS},
means AS (SELECT time_bucket(to_minutes({every}), "time") AS "time", measurement, zone, device_id, field,
    avg("value") AS "value"
  FROM points, clock
  WHERE measurement = '{measurement}' AND field IN ({names}) AND "time" >= now - INTERVAL {back} AND "time" < now
  GROUP BY ALL),
latest AS (SELECT * FROM means
  QUALIFY row_number() OVER (PARTITION BY measurement, zone, device_id, field ORDER BY "time" DESC) = 1)"""


def panel_rows(source: str, extra: str = COLOUR) -> str:
    return f'SELECT "time", measurement, zone, device_id, field, {rounded(chr(34) + "value" + chr(34))}, {extra} FROM {source}'


ACTIVE = f"""{READINGS},
clock AS (SELECT max(et) AS now FROM ev),
{", ".join(f"{s}_near AS (SELECT {s}.* FROM {s}, clock WHERE et >= now - INTERVAL 2 HOUR)" for s in SENSORS)},
active AS (SELECT window_start, zone, alert_level, type_capteur, valeur_detectee FROM ({every_alert("_near")}), clock
  WHERE window_start >= now - INTERVAL 2 HOUR AND window_start < now AND valeur_detectee IS NOT NULL)"""
ACTIVE_COLUMNS = """window_start AS "Heure", zone AS "Zone", alert_level AS "Niveau", type_capteur AS "Capteur",
  valeur_detectee AS "Valeur mesurée", CASE alert_level WHEN 'ROUGE' THEN 'red' ELSE 'orange' END AS colour"""

# The hub's device id by event: a third in upper case, a third "unknown", a third missing.
HUB = f"""{READINGS},
hub AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'pollution' WHEN 'click' THEN 'traffic'
    WHEN 'error' THEN 'lighting' WHEN 'purchase' THEN 'waste' ELSE 'other' END || '_' || zone AS payload_id FROM ev),
resolved AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper(payload_id) ELSE payload_id END AS device FROM hub),
routed AS (SELECT *, CASE WHEN lower(device) LIKE '%pollution%' THEN 'pollution'
    WHEN lower(device) LIKE '%traffic%' THEN 'traffic'
    WHEN lower(device) LIKE '%eclairage%' OR lower(device) LIKE '%lighting%' THEN 'eclairage'
    WHEN lower(device) LIKE '%dechets%' OR lower(device) LIKE '%waste%' THEN 'dechets' END AS sensor FROM resolved)"""

ROUTES = """(VALUES
  ('pollution', 'ROUGE', 'Service Environnement + Mairie', 'Email + SMS', 2),
  ('pollution', 'ORANGE', 'Service Environnement', 'Dashboard', 5),
  ('traffic', 'ROUGE', 'Police municipale + Service Voirie', 'SMS + Radio', 1),
  ('traffic', 'ORANGE', 'Centre de régulation trafic', 'Dashboard', 5),
  ('dechets', 'ROUGE', 'Service de Voirie (collecte)', 'Email + App mobile', 10),
  ('dechets', 'ORANGE', 'Planification Voirie', 'Dashboard', 30),
  ('eclairage', 'ROUGE', 'Service technique municipal', 'Email + Astreinte', 15),
  ('eclairage', 'ORANGE', 'Service technique municipal', 'Dashboard', 60))
  AS r(type_capteur, alert_level, destinataire, canal, delai_max_min)"""

RULES = {
    "pollution": (
        ("P1", "ROUGE", "CRITIQUE pollution - CO2 élevé 5min - Service Environnement", "avg_co2 >= 801", "avg_co2"),
        ("P2", "ROUGE", "CRITIQUE pollution - PM2.5 dangereux - Service Environnement", "avg_pm25 >= 76", "avg_pm25"),
        ("P3", "ROUGE", "AQI dangereux - Population à risque - Alerte publique", "avg_aqi >= 301", "avg_aqi"),
        ("P4", "ORANGE", "Élévation CO2 - Surveillance renforcée", "avg_co2 >= 601", "avg_co2"),
        ("P5", "ORANGE", "Élévation PM2.5 - Surveiller l''évolution", "avg_pm25 >= 36", "avg_pm25"),
        ("P6", "ORANGE", "Qualité d''air dégradée - Surveillance active", "avg_aqi >= 151", "avg_aqi"),
    ),
    "traffic": (
        ("T1", "ROUGE", "Chaos routier soutenu - Dérivation obligatoire - Police municipale",
         "avg_vehicules >= 61 OR avg_vitesse <= 10", "CASE WHEN avg_vehicules >= 61 THEN avg_vehicules ELSE avg_vitesse END"),
        ("T2", "ORANGE", "Embouteillage détecté - Ralentissement en cours",
         "avg_vehicules >= 41 OR avg_vitesse <= 30", "CASE WHEN avg_vehicules >= 41 THEN avg_vehicules ELSE avg_vitesse END"),
    ),
    "eclairage": (
        ("E0", "ROUGE", "Panne éclairage détectée (status=faulty) - Intervention technique urgente",
         "nb_faulty >= 1", "nb_faulty"),
        ("E1", "ROUGE", "Panne éclairage soutenue - Intervention technique urgente",
         "avg_luminosite <= 5 OR avg_conso >= CAST(0.55 AS DOUBLE)",
         "CASE WHEN avg_luminosite <= 5 THEN avg_luminosite ELSE avg_conso END"),
        ("E2", "ORANGE", "Anomalie éclairage - Surveillance nécessaire",
         "avg_luminosite <= 10 OR avg_conso >= CAST(0.40 AS DOUBLE)",
         "CASE WHEN avg_luminosite <= 10 THEN avg_luminosite ELSE avg_conso END"),
    ),
    "dechets": (
        ("D1", "ROUGE", "Poubelle saturée - Collecte immédiate - Notification Voirie",
         "avg_remplissage >= 91 OR avg_poids >= 81", "CASE WHEN avg_remplissage >= 91 THEN avg_remplissage ELSE avg_poids END"),
        ("D2", "ORANGE", "Poubelle presque pleine - Planifier collecte sous 2h",
         "avg_remplissage >= 76 OR avg_poids >= 61", "CASE WHEN avg_remplissage >= 76 THEN avg_remplissage ELSE avg_poids END"),
    ),
}


def attribution() -> str:
    parts = []
    for sensor in SENSORS:
        for rule, level, text, condition, value in RULES[sensor]:
            parts.append(
                f"SELECT window_start, window_end, zone, type_capteur, '{rule}' AS rule_id, '{level}' AS rule_level, "
                f"'{text}' AS rule_message, CAST({value} AS DOUBLE) AS fired_value FROM a_{sensor} WHERE {condition}"
            )
    named = ",\n".join(f"a_{s} AS ({alerts(s)})" for s in SENSORS)
    return f"{READINGS},\n{named}\n{' UNION ALL '.join(parts)}"


def incidents(where: str = "") -> str:
    """A new incident opens when a window starts more than ten minutes after the one before."""
    return f"""{ALERTS},
marked AS (SELECT *, CASE WHEN window_start - lag(window_start) OVER w <= INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS opens
  FROM alerts WINDOW w AS (PARTITION BY zone, type_capteur ORDER BY window_start)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY zone, type_capteur ORDER BY window_start) AS incident FROM marked),
ended AS (SELECT zone, type_capteur, incident, min(window_start) AS debut, max(window_end) AS fin,
    max(window_start) + INTERVAL 10 MINUTE AS resolu, count(*) AS nb_fenetres,
    CAST(sum(CASE WHEN alert_level = 'ROUGE' THEN 1 ELSE 0 END) AS BIGINT) AS nb_rouge,
    max(valeur_detectee) AS valeur_max
  FROM numbered GROUP BY ALL)
SELECT * EXCLUDE (incident) FROM ended {where}"""


def typed(sensor: str) -> str:
    return f"""SELECT {iso('et')} AS "timestamp", device_id, zone, '{sensor}' AS "type", {", ".join(FIELDS[sensor])},
  et AS event_time FROM {sensor}"""


def wide() -> str:
    parts = []
    for sensor in SENSORS:
        columns = [c if s == sensor else f"NULL AS {c}" for s in SENSORS for c in FIELDS[s]]
        parts.append(
            f"SELECT event_id, '{sensor}' AS sensor, {iso('et')} AS \"timestamp\", device_id, zone, "
            f"'{sensor}' AS \"type\", {', '.join(columns)}, et AS event_time FROM {sensor}"
        )
    return " UNION ALL ".join(parts)


def lenient_points() -> str:
    """Points of the untidy messages, by the way each event id spoils its message."""

    def spoiled(column: str) -> str:
        return (
            f"CASE event_id % 11 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 1 WHEN 5 THEN NULL "
            f"ELSE CAST({column} AS DOUBLE) END"
        )

    untidy = {"air_quality_index", "vehicles_per_min", "luminosity_lux"}
    parts = []
    for sensor in SENSORS:
        for field, source in POINT_FIELDS[sensor]:
            if field == "faulty_count":
                source = "CASE WHEN event_id % 11 <> 5 AND status = 'faulty' THEN 1 ELSE 0 END"
            value = spoiled(source) if source in untidy else source
            parts.append(
                f"SELECT '{sensor}' AS measurement, CASE WHEN event_id % 11 = 6 THEN 'unknown' ELSE zone END AS zone, "
                f"CASE WHEN event_id % 11 = 7 THEN 'unknown' ELSE device_id END AS device_id, '{field}' AS field, "
                f'CAST({value} AS DOUBLE) AS "value", et AS "time" FROM {sensor} '
                "WHERE event_id % 23 <> 0 AND event_id % 29 <> 0"
            )
    return f'{READINGS}\nSELECT * FROM ({" UNION ALL ".join(parts)}) WHERE "value" IS NOT NULL'


def closed(sensor: str, delay: int = 5) -> str:
    """Bounds a stream's windows: its watermark ends ``delay`` minutes before its newest reading."""
    return f"WHERE window_end <= (SELECT max(et) FROM {sensor}) - INTERVAL {delay} MINUTE"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    for s in SENSORS:
        sql[f"alerts_{s}_5min"] = f"{READINGS}\n{alerts(s)}"
        sql[f"trends_{s}_15min"] = f"{READINGS}\n{trends(s)}"
        sql[f"messages_{s}"] = f"{READINGS}\n{typed(s)}"
        sql[f"clean_{s}"] = f"{READINGS},\nkept AS ({cleaned(s)})\n{clean_rows(s)}"
        sql[f"daily_{s}"] = f"{READINGS}\n{daily(s)}"
        sql[f"etl_snapshot_{s}"] = f"{READINGS},\nkept AS ({cleaned(s)})\n{daily(s, 'kept')}"
        sql[f"stream_load_{s}"] = sql[f"etl_snapshot_{s}"]
        sql[f"stream_alerts_{s}"] = f"{READINGS}\nSELECT * FROM ({alerts(s)}) {closed(s)}"
        sql[f"etl_processed_{s}"] = f"""{READINGS},\nkept AS ({cleaned(s)})
SELECT * EXCLUDE (event_id) FROM ({clean_rows(s)})"""
    sql["load_rejects"] = """SELECT s AS sensor, b AS batch, v AS "value", r AS reject_reason
FROM (VALUES ('pollution'), ('traffic')) AS t(s), (VALUES (0, 'not json', 'unreadable'), (0, '{"device_id":"d","timestamp":"12:30"}', 'bad_time'),
  (0, '{"timestamp":"2024-01-01T00:00:00Z"}', 'no_device'), (0, '[1]', 'unreadable'), (1, '{"device_id":"d","timestamp":"12:30"}', 'bad_time'),
  (1, '{"timestamp":"2024-01-01T00:00:00Z"}', 'no_device'), (1, '[1]', 'unreadable')) AS u(b, v, r)"""
    halves = " UNION ALL ".join(
        f"SELECT '{s}' AS s, event_id % 2 AS part, count(*) AS n FROM k_{s} GROUP BY ALL" for s in ("eclairage", "dechets")
    )
    sql["load_run_log"] = f"""{READINGS}, k_eclairage AS ({cleaned("eclairage")}), k_dechets AS ({cleaned("dechets")})
SELECT s AS sensor_type, 'SUCCESS' AS status, n AS rows_processed, 'SUCCESS' AS snapshot_status FROM ({halves})"""
    sql["stream_rejects"] = f"""{READINGS},
m AS ({" UNION ALL ".join(f"SELECT event_id, '{s}' AS s FROM {s}" for s in SENSORS)}),
r AS (SELECT CASE WHEN event_id % 31 = 0 THEN NULL ELSE s END AS sensor,
    CASE WHEN event_id % 31 = 0 THEN 'unknown_sensor' WHEN event_id % 23 = 0 OR event_id % 29 = 0 THEN 'unreadable'
      WHEN event_id % 11 = 7 THEN 'no_device' WHEN event_id % 11 = 9 THEN 'no_time' WHEN event_id % 11 = 8 THEN 'bad_time' END AS reject_reason FROM m)
SELECT CASE WHEN sensor IS NULL THEN 'other' ELSE 'sensors-' || sensor END AS topic, sensor, reject_reason, count(*) AS nb, count(*) AS nb_textes
FROM r WHERE reject_reason IS NOT NULL GROUP BY ALL"""
    sql["stream_lagging_sensor"] = f"""{READINGS}
SELECT window_start AS debut_fenetre, window_end AS fin_fenetre, zone, alert_level, alert_message, type_capteur, valeur_detectee FROM (
  {" UNION ALL ".join(f"SELECT {COMMON} FROM ({alerts(s)}) {closed(s)}" for s in ("pollution", "dechets"))})"""
    sql["run_log"] = f"""{READINGS}, k1 AS ({cleaned("pollution")}), k2 AS ({cleaned("traffic")}),
loaded AS (SELECT 'pollution' AS s, count(*) AS n FROM k1 UNION ALL SELECT 'traffic', count(*) FROM k2)
SELECT s AS sensor_type, 'SUCCESS' AS status, n AS rows_processed, 'SUCCESS' AS snapshot_status FROM loaded
UNION ALL SELECT s, 'SUCCESS', 0, NULL FROM loaded
UNION ALL SELECT s, 'SKIPPED_NO_DATA', 0, NULL FROM (VALUES ('eclairage'), ('dechets'), ('eclairage'), ('dechets')) AS t(s)"""
    sql["all_alerts_union"] = f"{ALERTS}\nSELECT * FROM alerts"
    sql["alert_json"] = f"{RECORDS}\nSELECT * FROM records"
    trend_rows = " UNION ALL ".join(
        f"SELECT window_start, zone, alert_level, type_capteur, valeur_detectee FROM ({trends(s)})" for s in SENSORS
    )
    point_columns = "window_start AS \"time\", zone, alert_level AS niveau, type_capteur AS \"type\", valeur_detectee AS valeur"
    sql["alert_and_trend_points"] = f"""{ALERTS}, both_rows AS (
  SELECT window_start, zone, alert_level, type_capteur, valeur_detectee FROM alerts UNION ALL {trend_rows})
SELECT {point_columns}, 'window' AS source FROM both_rows WHERE valeur_detectee IS NOT NULL"""
    sql["rule_attribution"] = attribution()
    sql["topic_readings"] = f"{READINGS}\n{wide()}"
    sql["event_times"] = """SELECT event_id,
  CASE event_id % 10 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN date_trunc('second', ts)
    WHEN 4 THEN date_trunc('milliseconds', ts) END AS lenient,
  CASE event_id % 10 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 4 THEN date_trunc('milliseconds', ts) END AS strict
FROM events"""
    sql["rejected_readings"] = f"""{READINGS}
SELECT event_id, CASE event_id % 7 WHEN 3 THEN 'bad' WHEN 1 THEN NULL WHEN 4 THEN NULL ELSE {iso("ts")} END AS "timestamp",
  CASE WHEN event_id % 7 NOT IN (2, 4) THEN device_id END AS device_id,
  CASE WHEN event_id % 7 <> 4 THEN zone END AS zone,
  CASE event_id % 7 WHEN 4 THEN 'unreadable' WHEN 2 THEN 'no_device' WHEN 1 THEN 'no_time' ELSE 'bad_time' END AS reject_reason
FROM pollution WHERE event_id % 7 IN (1, 2, 3, 4)"""
    sql["incremental_ingest"] = f"""{READINGS},\nkept AS ({cleaned("pollution")}),
known AS (SELECT DISTINCT ts, device_id FROM pollution WHERE ts < TIMESTAMP '2024-01-16 00:00:00')
{clean_rows("pollution", "WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.ts = kept.ts AND known.device_id = kept.device_id)")}"""
    sql["pollution_by_zone"] = f"""{HISTORY}
SELECT zone, {rounded("avg_aqi")}, {rounded("avg_co2")}, {rounded("avg_pm25")} FROM ranking"""
    sql["zone_extremes"] = f"""{HISTORY}
SELECT w.subject AS worst_zone, {rounded('w."value"', "worst_aqi")}, b.subject AS best_zone, {rounded('b."value"', "best_aqi")}
FROM facts w, facts b WHERE w.fact = 'worst_zone' AND b.fact = 'best_zone'"""
    hours = f"heure, {rounded('avg_vehicles')}, {rounded('avg_speed')}"
    sql["traffic_by_hour"] = f"{HISTORY}\nSELECT {hours} FROM profile"
    sql["peak_hour"] = f"{HISTORY}\nSELECT {hours} FROM profile ORDER BY profile.avg_vehicles DESC, heure LIMIT 1"
    sql["hour_table_head"] = f"{HISTORY}\nSELECT {hours} FROM profile ORDER BY heure LIMIT 10"
    sql["traffic_pollution_daily"] = f"""{HISTORY}
SELECT date_partition, zone, {rounded("avg_aqi")}, {rounded("avg_vehicles")} FROM paired"""
    sql["traffic_pollution_corr"] = f"{HISTORY}\nSELECT {rounded('c', 'traffic_pollution_corr')} FROM linked"
    sql["report_facts"] = f'{HISTORY}\nSELECT fact, subject, {rounded(chr(34) + "value" + chr(34))} FROM facts'
    sql["report_from_lake"] = f"""{READINGS}, kept_p AS ({cleaned("pollution")}), kept_t AS ({cleaned("traffic")}),
{history("kept_p", "kept_t")}
SELECT fact, subject, {rounded('"value"')} FROM facts"""
    sql["report_recommendations"] = f"""{HISTORY}
SELECT CASE fact WHEN 'worst_zone' THEN 'monitor_zone' WHEN 'peak_hour' THEN 'adapt_signals' ELSE 'cross_peaks' END AS action,
  subject FROM facts WHERE fact <> 'best_zone'"""
    sql["points_long"] = f"{POINTS}\nSELECT * FROM points"
    sql["stream_points"] = sql["points_long"]
    sql["points_lenient"] = lenient_points()
    sql["points_pivot"] = f"""{READINGS}
SELECT et AS "time", zone, device_id, max(co2_ppm) AS co2_ppm, max(pm25) AS pm25,
  max(CAST(air_quality_index AS DOUBLE)) AS aqi FROM pollution GROUP BY ALL"""
    sql["threshold_bands"] = f"""{POINTS}
SELECT measurement, zone, field, {COLOUR}, count(*) AS nb_points FROM points
WHERE field IN ('aqi', 'vehicles_per_min', 'fill_percent', 'faulty_count', 'power_kw') GROUP BY ALL"""
    sql["congestion_check"] = f"""{READINGS}
SELECT CAST(hour(ts) AS INTEGER) AS heure, congestion AS band, count(*) AS nb,
  count(*) FILTER (WHERE event_id % 19 = 0 AND congestion <> 'high') AS nb_ecarts FROM traffic GROUP BY ALL"""
    sql["bin_check"] = f"""{READINGS}
SELECT zone, CASE WHEN fill_percent > 90 THEN 'true' ELSE 'false' END AS plein, count(*) AS nb,
  count(*) FILTER (WHERE event_id % 17 = 0 AND fill_percent <= 90) AS nb_ecarts FROM dechets GROUP BY ALL"""
    sql["dash_aqi_latest"] = f"{bucketed('pollution', ('aqi',), '15 MINUTE', 1)}\n{panel_rows('latest')}"
    sql["dash_traffic_ts"] = f"{bucketed('traffic', ('vehicles_per_min',), '30 MINUTE', 1)}\n{panel_rows('means')}"
    label = "CASE field WHEN 'co2_ppm' THEN 'CO₂ (ppm)' ELSE 'PM2.5 (µg/m³)' END AS label"
    sql["dash_pollution_ts"] = (
        f"{bucketed('pollution', ('co2_ppm', 'pm25'), '30 MINUTE', 1)}\n{panel_rows('means', label)}"
    )
    sql["dash_lighting_latest"] = (
        f"{bucketed('eclairage', ('faulty_count', 'power_kw'), '30 MINUTE', 5)}\n{panel_rows('latest')}"
    )
    sql["dash_fill_latest"] = f"""{POINTS},
latest AS (SELECT points.* FROM points, clock WHERE measurement = 'dechets' AND field = 'fill_percent'
  AND "time" >= now - INTERVAL 1 HOUR AND "time" < now
  QUALIFY row_number() OVER (PARTITION BY zone, device_id ORDER BY "time" DESC, "value" DESC) = 1)
{panel_rows("latest")}"""
    sql["dash_active_alerts"] = f"""{ACTIVE}
SELECT {ACTIVE_COLUMNS} FROM active
QUALIFY row_number() OVER (PARTITION BY zone, alert_level, type_capteur ORDER BY window_start DESC) <= 50"""
    sql["dash_active_alerts_top50"] = f"""{ACTIVE}
SELECT {ACTIVE_COLUMNS} FROM active ORDER BY window_start DESC, zone, alert_level, type_capteur LIMIT 50"""
    sql["device_routing"] = f"{HUB}\nSELECT event_id, device, sensor FROM routed"
    sql["dead_letters"] = f"{HUB}\nSELECT device, count(*) AS nb FROM routed WHERE sensor IS NULL GROUP BY device"
    sql["stream_bridge"] = f"""{HUB}
SELECT coalesce('sensors-' || sensor, 'none') AS topic, count(*) AS nb FROM routed GROUP BY ALL"""
    sql["routed_alerts"] = f"""{RECORDS}
SELECT debut_fenetre, zone, type_capteur, alert_level, destinataire, canal, delai_max_min
FROM records LEFT JOIN {ROUTES} USING (type_capteur, alert_level)"""
    sql["notification_outbox"] = f"""{RECORDS}
SELECT '🚨 [sensors] ALERTE ROUGE — ' || upper(zone) || ' (' || type_capteur || ')' AS subject, zone,
  type_capteur AS capteur, alert_message AS message, valeur_detectee AS valeur, debut_fenetre AS debut
FROM records WHERE alert_level = 'ROUGE'"""
    sql["alert_display"] = f"""{RECORDS}
SELECT alert_level AS niveau, upper(zone) AS zone, type_capteur AS capteur, alert_message AS message,
  valeur_detectee AS valeur, debut_fenetre AS debut FROM records"""
    sql["alert_counts"] = f"""{ALERTS}
SELECT coalesce(alert_level, 'total') AS alert_level, count(*) AS nb_alertes FROM alerts GROUP BY ROLLUP (alert_level)"""
    sql["stream_alert_counts"] = sql["alert_counts"]
    sql["alert_latency"] = f"""{RECORDS}, late AS (
  SELECT type_capteur, (epoch_us({ARRIVAL}) - epoch_us(debut_fenetre)) / CAST(1e6 AS DOUBLE) AS s FROM records)
SELECT type_capteur, count(*) AS nb_alertes, min(s) AS latence_min, {mean("s", "latence_moy")}, max(s) AS latence_max,
  max(s) < 10 AS objectif_atteint FROM late GROUP BY ALL"""
    sql["alert_arrival_points"] = f"""{RECORDS}
SELECT {ARRIVAL} AS "time", zone, alert_level AS niveau, type_capteur AS "type",
  coalesce(valeur_detectee, 0) AS valeur, 'arrival' AS source FROM records"""
    sql["alert_incidents"] = incidents()
    sql["stream_incidents"] = incidents(
        "WHERE resolu <= (SELECT max(window_start) FROM alerts) - INTERVAL 5 MINUTE"
    )
    sql["stream_alert_log"] = f"""{READINGS}
SELECT window_start AS debut_fenetre, window_end AS fin_fenetre, zone, alert_level, alert_message, type_capteur,
  valeur_detectee FROM ({alerts("dechets")}) {closed("dechets")}"""
    # Every sensor has a watermark of its own.
    stream_rows = " UNION ALL ".join(
        f"SELECT {COMMON} FROM ({alerts(s)}) {closed(s)} UNION ALL SELECT window_start, window_end, zone, alert_level, NULL, "
        f"type_capteur, valeur_detectee FROM ({trends(s)}) {closed(s, 15)}"
        for s in SENSORS
    )
    sql["stream_pipeline_points"] = f"{READINGS}\nSELECT {point_columns} FROM ({stream_rows})"
    for name in ("dash_aqi_latest", "dash_traffic_ts", "dash_pollution_ts", "dash_fill_latest", "dash_lighting_latest"):
        sql[f"{name}_stored"] = sql[f"{name}_rollup"] = sql[name]
    sql["stream_incidents_resolved"] = f"""WITH i AS ({incidents()})
SELECT zone, type_capteur, 'resolu' AS evenement, debut, fin, resolu, nb_fenetres, nb_rouge, valeur_max FROM i
UNION ALL SELECT zone, type_capteur, 'ouvert', debut, NULL, NULL, NULL, NULL, NULL FROM i"""
    sql["stream_supervised"] = sql["stream_alerts_traffic"]
    sql["stream_routed_alerts"] = f"""{RECORDS}
SELECT debut_fenetre, zone, type_capteur, alert_level, destinataire,
  CASE WHEN hour(debut_fenetre) >= 6 AND alert_level = 'ROUGE' THEN 'Astreinte' ELSE canal END AS canal,
  CASE WHEN hour(debut_fenetre) >= 6 AND alert_level = 'ROUGE' THEN 1 ELSE delai_max_min END AS delai_max_min
FROM records LEFT JOIN {ROUTES} USING (type_capteur, alert_level)"""
    sql["stream_latency"] = sql["alert_latency"]
    sql["stream_alert_topic"] = f"""{READINGS}
SELECT window_start AS debut_fenetre, window_end AS fin_fenetre, zone, alert_level, alert_message, type_capteur, valeur_detectee FROM (
  {" UNION ALL ".join(f"SELECT {COMMON} FROM ({alerts(s)}) {closed(s)}" for s in SENSORS)})"""
    # Stored alerts come from all windows, also those that begin before the newest two hours of readings.
    sql["dash_active_alerts_stored"] = f"""{ALERTS}, clock AS (SELECT max(et) AS now FROM ev),
active AS (SELECT window_start, zone, alert_level, type_capteur, valeur_detectee FROM alerts, clock
  WHERE window_start >= now - INTERVAL 2 HOUR AND window_start < now AND valeur_detectee IS NOT NULL)
SELECT {ACTIVE_COLUMNS} FROM active
QUALIFY row_number() OVER (PARTITION BY zone, alert_level, type_capteur ORDER BY window_start DESC) <= 50"""
    sql["stream_landing"] = f"{READINGS}\nSELECT * EXCLUDE (event_time) FROM ({typed('dechets')})"
    return sql
