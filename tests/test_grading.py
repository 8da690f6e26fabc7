"""Times, bands, thresholds, rules, correlation."""

import itertools

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonewatch.functions import bands, grading, routing, stats, times, values
from zonewatch.sensors import SENSORS

METRICS = {
    "pollution": ("avg_co2", "avg_pm25", "avg_aqi"),
    "traffic": ("avg_vehicules", "avg_vitesse"),
    "eclairage": ("avg_luminosite", "avg_conso", "nb_faulty"),
    "dechets": ("avg_remplissage", "avg_poids"),
}


def at_least(v, bound):
    return v is not None and v >= bound


def at_most(v, bound):
    return v is not None and v <= bound


def expected_level(sensor, m):
    """Plain reading of the rules; an unknown comparison counts as not met."""
    if sensor == "pollution":
        co2, pm, aqi = m
        if at_least(co2, 801) or at_least(pm, 76) or at_least(aqi, 301):
            return "ROUGE"
        return "ORANGE" if at_least(co2, 601) or at_least(pm, 36) or at_least(aqi, 151) else "VERT"
    if sensor == "traffic":
        cars, speed = m
        if at_least(cars, 61) or at_most(speed, 10):
            return "ROUGE"
        return "ORANGE" if at_least(cars, 41) or at_most(speed, 30) else "VERT"
    if sensor == "eclairage":
        lux, kw, faulty = m
        if at_least(faulty, 1) or at_most(lux, 5) or at_least(kw, 0.55):
            return "ROUGE"
        return "ORANGE" if at_most(lux, 10) or at_least(kw, 0.40) else "VERT"
    fill, weight = m
    if at_least(fill, 91) or at_least(weight, 81):
        return "ROUGE"
    return "ORANGE" if at_least(fill, 76) or at_least(weight, 61) else "VERT"


def levels(spark, sensor, metric_rows):
    schema = "i int, " + ", ".join(f"{m} double" for m in METRICS[sensor])
    df = spark.createDataFrame([(i, *m) for i, m in enumerate(metric_rows)], schema)
    found = df.select("i", F.expr(grading.severity(SENSORS[sensor])).alias("level")).collect()
    return [level for _, level in sorted(found)]


@pytest.mark.parametrize("sensor", METRICS)
def test_levels_around_every_threshold(spark, sensor):
    around = {}
    for metric, _, lo, hi in SENSORS[sensor].limits:
        bounds = [b for b in (lo, hi) if b is not None]
        around[metric] = [None] + [b + d for b in bounds for d in (-0.001, 0, 0.001)]
    cases = list(itertools.product(*[around[m] for m in METRICS[sensor]]))
    cases = [tuple(None if v is None else float(v) for v in c) for c in cases]
    assert levels(spark, sensor, cases) == [expected_level(sensor, c) for c in cases]


@pytest.mark.parametrize("sensor", METRICS)
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_levels_of_any_values(spark, sensor, data):
    value = st.one_of(st.none(), st.floats(-10, 1000, allow_nan=False))
    cases = data.draw(st.lists(st.tuples(*[value] * len(METRICS[sensor])), min_size=20, max_size=60))
    assert levels(spark, sensor, cases) == [expected_level(sensor, c) for c in cases]


def test_rules_name_the_metric_that_fired(spark):
    df = spark.createDataFrame([(2.0, 0.6, 0), (50.0, 0.45, 3)], "avg_luminosite double, avg_conso double, nb_faulty long")
    found = rows(df.select(F.inline(grading.fired_rules(SENSORS["eclairage"]))).filter("rule_id IS NOT NULL"))
    assert [(r["rule_id"], r["fired_value"]) for r in found] == [("E1", 2.0), ("E2", 2.0), ("E0", 3.0), ("E2", 0.45)]


def test_message_times(spark):
    texts = [
        ("2024-05-13T14:32:00Z", True, False),
        ("2024-05-13T14:32:00+00:00", True, False),
        ("2024-05-13T14:32:00.123456+00:00", True, True),
        ("2024-05-13T14:32:00.123+00:00", True, True),
        ("2024-05-13T14:32:00.123456Z", True, True),
        ("bad", False, False),
        (None, False, False),
    ]
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(texts)], "i int, t string")
    found = df.select(
        "i", times.event_time(F.col("t")).isNotNull(), times.event_time(F.col("t"), strict=True).isNotNull()
    ).collect()
    assert [tuple(r)[1:] for r in sorted(found)] == [t[1:] for t in texts]


def test_lenient_numbers(spark):
    cases = [
        ("7", 7.0), ("185.0", 185.0), (" 2.5 ", 2.5), ("1e3", 1000.0), ("-4", -4.0), ("5.", 5.0), ("true", 1.0),
        ("FALSE", 0.0), ("5d", None), ("5f", None), ("NaN", None), ("Infinity", None), ("abc", None), ("", None), (None, None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    found = sorted(df.select("i", values.number(F.col("t"))).collect())
    assert [r[1] for r in found] == [c[1] for c in cases]


def test_flags_and_tags_are_never_null(spark):
    df = spark.createDataFrame([(0, "FAULTY"), (1, None), (2, "ok")], "i int, s string")
    found = sorted(df.select("i", values.flag(F.col("s"), "faulty"), values.tag(F.col("s"))).collect())
    assert [tuple(r)[1:] for r in found] == [(1.0, "FAULTY"), (0.0, "unknown"), (0.0, "ok")]


def test_bands(spark):
    df = spark.createDataFrame([(float(v),) for v in (40, 41, 70, 71, 100, 101)], "v double")
    found = [r[0] for r in df.select(bands.congestion(F.col("v"))).collect()]
    assert found == ["low", "medium", "medium", "high", "high", "critical"]
    df = spark.createDataFrame([(99.9,), (100.0,), (300.0,), (None,)], "v double")
    assert [r[0] for r in df.select(bands.colour("aqi", F.col("v"))).collect()] == ["green", "yellow", "red", None]


def test_device_routing(spark):
    cases = [
        ("Pollution_x", None, "pollution"), ("TRAFFIC-1", "p", "traffic"), ("my-lighting", None, "eclairage"),
        ("unknown", "waste_z", "dechets"), (None, "eclairage1", "eclairage"), ("unknown", None, None),
        ("pollution_waste", None, "pollution"),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, hub string, payload string")
    device = routing.device_id(F.col("hub"), F.col("payload"))
    found = sorted(df.select("i", routing.sensor_of_device(device)).collect())
    assert [r[1] for r in found] == [c[2] for c in cases]


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([], None),
        ([(1.0, 2.0)], None),
        ([(1.0, 2.0), (1.0, 3.0)], None),
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1.0),
        ([(1.0, 6.0), (2.0, 4.0), (3.0, 2.0), (9.0, None)], -1.0),
    ],
)
def test_correlation_is_null_where_undefined(spark, pairs, expected):
    df = spark.createDataFrame(pairs, "x double, y double")
    found = df.agg(stats.correlation(F.col("x"), F.col("y"))).first()[0]
    assert found is None if expected is None else abs(found - expected) < 1e-12
