"""Zones, thresholds, messages, routing matrix, colour steps.

Everything in this file is a value that results depend on, stated as plain data.
"""

from __future__ import annotations

# Zones, in index order.
ZONES = ("centre_ville", "zone_industrielle", "residentiel", "peripherie")

# Alert levels.
GREEN = "VERT"
ORANGE = "ORANGE"
RED = "ROUGE"
TREND = "TENDANCE"

# Sliding windows and watermarks (size, slide, delay).
ALERT_WINDOW = ("5 minutes", "1 minute", "5 minutes")
TREND_WINDOW = ("15 minutes", "5 minutes", "15 minutes")

# Grading limits as (metric, comparison, orange bound, red bound).
LIMITS = {
    "pollution": (
        ("avg_co2", ">=", 601, 801),
        ("avg_pm25", ">=", 36, 76),
        ("avg_aqi", ">=", 151, 301),
    ),
    "traffic": (
        ("avg_vehicules", ">=", 41, 61),
        ("avg_vitesse", "<=", 30, 10),
    ),
    "eclairage": (
        ("nb_faulty", ">=", None, 1),
        ("avg_luminosite", "<=", 10, 5),
        ("avg_conso", ">=", 0.40, 0.55),
    ),
    "dechets": (
        ("avg_remplissage", ">=", 76, 91),
        ("avg_poids", ">=", 61, 81),
    ),
}

# Alert texts per sensor and level.
MESSAGES = {
    "pollution": {
        RED: "CRITIQUE pollution - CO2 eleve 5min - Service Environnement",
        ORANGE: "Elevation pollution - Surveillance renforcee",
        GREEN: "Normal",
    },
    "traffic": {
        RED: "Chaos routier soutenu 5min - Notification Police municipale",
        ORANGE: "Embouteillage - Ralentissement detecte",
        GREEN: "Circulation normale",
    },
    "eclairage": {
        RED: "Panne eclairage detectee (status=faulty) - Intervention technique urgente",
        ORANGE: "Anomalie eclairage - Surveillance necessaire",
        GREEN: "Fonctionnement normal",
    },
    "dechets": {
        RED: "Poubelle saturee - Collecte immediate - Notification Voirie",
        ORANGE: "Poubelle presque pleine - Planifier collecte sous 2h",
        GREEN: "Normal",
    },
}

# Numbered rules as (id, level, ((metric, comparison, bound), ...), text).
RULES = {
    "pollution": (
        ("P1", RED, (("avg_co2", ">=", 801),), "CRITIQUE pollution - CO2 élevé 5min - Service Environnement"),
        ("P2", RED, (("avg_pm25", ">=", 76),), "CRITIQUE pollution - PM2.5 dangereux - Service Environnement"),
        ("P3", RED, (("avg_aqi", ">=", 301),), "AQI dangereux - Population à risque - Alerte publique"),
        ("P4", ORANGE, (("avg_co2", ">=", 601),), "Élévation CO2 - Surveillance renforcée"),
        ("P5", ORANGE, (("avg_pm25", ">=", 36),), "Élévation PM2.5 - Surveiller l'évolution"),
        ("P6", ORANGE, (("avg_aqi", ">=", 151),), "Qualité d'air dégradée - Surveillance active"),
    ),
    "traffic": (
        ("T1", RED, (("avg_vehicules", ">=", 61), ("avg_vitesse", "<=", 10)),
         "Chaos routier soutenu - Dérivation obligatoire - Police municipale"),
        ("T2", ORANGE, (("avg_vehicules", ">=", 41), ("avg_vitesse", "<=", 30)),
         "Embouteillage détecté - Ralentissement en cours"),
    ),
    "eclairage": (
        ("E0", RED, (("nb_faulty", ">=", 1),),
         "Panne éclairage détectée (status=faulty) - Intervention technique urgente"),
        ("E1", RED, (("avg_luminosite", "<=", 5), ("avg_conso", ">=", 0.55)),
         "Panne éclairage soutenue - Intervention technique urgente"),
        ("E2", ORANGE, (("avg_luminosite", "<=", 10), ("avg_conso", ">=", 0.40)),
         "Anomalie éclairage - Surveillance nécessaire"),
    ),
    "dechets": (
        ("D1", RED, (("avg_remplissage", ">=", 91), ("avg_poids", ">=", 81)),
         "Poubelle saturée - Collecte immédiate - Notification Voirie"),
        ("D2", ORANGE, (("avg_remplissage", ">=", 76), ("avg_poids", ">=", 61)),
         "Poubelle presque pleine - Planifier collecte sous 2h"),
    ),
}

# Routing matrix as (type_capteur, alert_level, destinataire, canal, delai_max_min).
ROUTES = (
    ("pollution", RED, "Service Environnement + Mairie", "Email + SMS", 2),
    ("pollution", ORANGE, "Service Environnement", "Dashboard", 5),
    ("traffic", RED, "Police municipale + Service Voirie", "SMS + Radio", 1),
    ("traffic", ORANGE, "Centre de régulation trafic", "Dashboard", 5),
    ("dechets", RED, "Service de Voirie (collecte)", "Email + App mobile", 10),
    ("dechets", ORANGE, "Planification Voirie", "Dashboard", 30),
    ("eclairage", RED, "Service technique municipal", "Email + Astreinte", 15),
    ("eclairage", ORANGE, "Service technique municipal", "Dashboard", 60),
)

# Dashboard colour steps as (lowest colour, ((from value, colour), ...)).
COLOUR_STEPS = {
    "aqi": ("green", ((100, "yellow"), (200, "orange"), (300, "red"))),
    "vehicles_per_min": ("green", ((41, "orange"), (61, "red"))),
    "fill_percent": ("green", ((70, "yellow"), (90, "red"))),
    "faulty_count": ("green", ((1, "red"),)),
    "power_kw": ("green", ((0.40, "orange"), (0.55, "red"))),
}
LEVEL_COLOURS = {RED: "red", ORANGE: "orange"}

# Dashboard display names.
FIELD_LABELS = {
    "co2_ppm": "CO₂ (ppm)",
    "pm25": "PM2.5 (µg/m³)",
    "power_kw": "Consommation (kW)",
    "faulty_count": "Pannes détectées",
}
ALERT_TABLE_LABELS = {
    "time": "Heure",
    "zone": "Zone",
    "niveau": "Niveau",
    "type": "Capteur",
    "valeur": "Valeur mesurée",
}

# Bands carried inside readings.
CONGESTION_STEPS = ("low", ((40, "medium"), (70, "high"), (100, "critical")))
FULL_BIN_ABOVE = 90

# Device name parts per sensor, tested in this order.
DEVICE_PARTS = (
    ("pollution", ("pollution",)),
    ("traffic", ("traffic",)),
    ("eclairage", ("eclairage", "lighting")),
    ("dechets", ("dechets", "waste")),
)

# Topics are "<prefix>-<sensor>" and "<prefix>-alerts"; set the prefix of your broker.
TOPIC_PREFIX = "sensors"
ALERT_TOPIC_SUFFIX = "alerts"
LATENCY_TARGET_SECONDS = 10
INCIDENT_GAP = "10 minutes"
