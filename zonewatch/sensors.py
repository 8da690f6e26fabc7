"""The four sensor kinds: message schema, keys, window metrics, daily metrics, point fields."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from zonewatch import settings

ID_COLUMNS = ("timestamp", "device_id")
PREFIX = ("timestamp", "device_id", "zone", "type")
SERIES = ("measurement", "zone", "device_id", "field")


FAULTY = "CASE WHEN status = 'faulty' THEN 1 ELSE 0 END"


@dataclass(frozen=True, eq=False)
class Sensor:
    """One sensor kind. ``averages`` maps a window metric to the reading field it averages."""

    name: str
    fields: tuple[StructField, ...]
    required: tuple[str, ...]
    averages: dict[str, str]
    headline: str
    daily: tuple[tuple[str, str, str], ...]
    point_fields: dict[str, str]
    device_prefix: str
    counts_faults: bool = False

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in PREFIX] + list(self.fields))

    @property
    def text_schema(self) -> StructType:
        """The same fields read as text, for paths that convert values leniently."""
        return StructType([StructField(f.name, StringType()) for f in self.schema])

    @property
    def limits(self):
        return settings.LIMITS[self.name]

    @property
    def messages(self) -> dict[str, str]:
        return settings.MESSAGES[self.name]

    @property
    def rules(self):
        return settings.RULES[self.name]


def _number(name: str) -> StructField:
    return StructField(name, DoubleType())


def _count(name: str) -> StructField:
    return StructField(name, IntegerType())


def _text(name: str) -> StructField:
    return StructField(name, StringType())


# Field names of the messages, and the names that windows, daily tables and points carry.
POLLUTION = Sensor(
    name="pollution",
    fields=(_number("co2_ppm"), _number("pm25"), _count("air_quality_index")),
    required=("co2_ppm", "pm25"),
    averages={"avg_co2": "co2_ppm", "avg_pm25": "pm25", "avg_aqi": "air_quality_index"},
    headline="avg_co2",
    daily=(
        ("avg_co2_ppm", "avg", "co2_ppm"),
        ("avg_pm25", "avg", "pm25"),
        ("avg_aqi", "avg", "air_quality_index"),
        ("max_co2_ppm", "max", "co2_ppm"),
        ("max_aqi", "max", "air_quality_index"),
    ),
    point_fields={"co2_ppm": "co2_ppm", "pm25": "pm25", "aqi": "air_quality_index"},
    device_prefix="pollution",
)

TRAFFIC = Sensor(
    name="traffic",
    fields=(_count("vehicles_per_min"), _number("avg_speed_kmh"), _text("congestion")),
    required=("vehicles_per_min", "avg_speed_kmh"),
    averages={"avg_vehicules": "vehicles_per_min", "avg_vitesse": "avg_speed_kmh"},
    headline="avg_vehicules",
    daily=(
        ("avg_vehicles_per_min", "avg", "vehicles_per_min"),
        ("avg_speed_kmh", "avg", "avg_speed_kmh"),
        ("max_vehicles_per_min", "max", "vehicles_per_min"),
        ("min_speed_kmh", "min", "avg_speed_kmh"),
    ),
    point_fields={"vehicles_per_min": "vehicles_per_min", "avg_speed_kmh": "avg_speed_kmh"},
    device_prefix="traffic",
)

LIGHTING = Sensor(
    name="eclairage",
    fields=(_count("luminosity_lux"), _text("status"), _number("power_kw")),
    required=("luminosity_lux",),
    averages={"avg_luminosite": "luminosity_lux", "avg_conso": "power_kw"},
    headline="avg_luminosite",
    daily=(
        ("avg_luminosity_lux", "avg", "luminosity_lux"),
        ("avg_power_kw", "avg", "power_kw"),
        ("nb_faulty", "faults", "status"),
    ),
    point_fields={"luminosity_lux": "luminosity_lux", "power_kw": "power_kw", "faulty_count": "status"},
    device_prefix="lighting",
    counts_faults=True,
)

WASTE = Sensor(
    name="dechets",
    fields=(_number("fill_percent"), _number("weight_kg"), _text("alert")),
    required=("fill_percent",),
    averages={"avg_remplissage": "fill_percent", "avg_poids": "weight_kg"},
    headline="avg_remplissage",
    daily=(
        ("avg_fill_percent", "avg", "fill_percent"),
        ("avg_weight_kg", "avg", "weight_kg"),
        ("max_fill_percent", "max", "fill_percent"),
        ("max_weight_kg", "max", "weight_kg"),
    ),
    point_fields={"fill_percent": "fill_percent", "weight_kg": "weight_kg", "alert_flag": "alert"},
    device_prefix="waste",
)

SENSORS: dict[str, Sensor] = {s.name: s for s in (POLLUTION, TRAFFIC, LIGHTING, WASTE)}


def chosen(names: Iterable[str] | None = None) -> tuple[Sensor, ...]:
    """Sensors by name, all four by default; an unknown name is an error."""
    return tuple(SENSORS[n] for n in (names or SENSORS))


def wide_schema(text: bool = False) -> StructType:
    """One schema that holds any sensor's message: the shared prefix, then every field once."""
    merged: dict[str, StructField] = {}
    for sensor in SENSORS.values():
        for field in sensor.text_schema if text else sensor.schema:
            merged.setdefault(field.name, field)
    return StructType(list(merged.values()))


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def case_by_sensor(choose, sensors: Iterable[Sensor]) -> str:
    """SQL text of ``choose(sensor)`` for each row's own sensor; the bare text when there is only one."""
    sensors = tuple(sensors)
    if len(sensors) == 1:
        return choose(sensors[0])
    return "CASE sensor " + " ".join(f"WHEN '{s.name}' THEN {choose(s)}" for s in sensors) + " END"


def by_sensor(choose, sensors: Iterable[Sensor]) -> Column:
    """The same for columns."""
    sensors = tuple(sensors)
    if len(sensors) == 1:
        return choose(sensors[0])
    chain = F
    for sensor in sensors:
        chain = chain.when(F.col("sensor") == sensor.name, choose(sensor))
    return chain


def topic_of(sensor: str, prefix: str = settings.TOPIC_PREFIX) -> str:
    return f"{prefix}-{sensor}"


def alert_topic(prefix: str = settings.TOPIC_PREFIX) -> str:
    return f"{prefix}-{settings.ALERT_TOPIC_SUFFIX}"
