"""Threshold grading of window metrics, compiled to plain expressions.

Null metrics keep three-valued logic: an unknown comparison never raises a level
and never hides one that another metric raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewatch.sensors import Sensor, quoted
from zonewatch.settings import GREEN, ORANGE, RED


def _test(metric: str, comparison: str, bound) -> str:
    return f"{metric} {comparison} {bound}D"


def _any_of(conditions) -> str:
    return " OR ".join(_test(*c) for c in conditions)


def severity(sensor: Sensor) -> str:
    """SQL text of the level."""
    red = [(m, c, hi) for m, c, _, hi in sensor.limits if hi is not None]
    orange = [(m, c, lo) for m, c, lo, _ in sensor.limits if lo is not None]
    return f"CASE WHEN {_any_of(red)} THEN '{RED}' WHEN {_any_of(orange)} THEN '{ORANGE}' ELSE '{GREEN}' END"


def message(sensor: Sensor) -> str:
    """SQL text of the message for the row's ``alert_level``."""
    texts = {level: quoted(text) for level, text in sensor.messages.items()}
    return f"CASE alert_level WHEN '{RED}' THEN {texts[RED]} WHEN '{ORANGE}' THEN {texts[ORANGE]} ELSE {texts[GREEN]} END"


def fired_rules(sensor: Sensor) -> Column:
    """Array with an entry per numbered rule: (rule, level, message, value) if it holds, else null.

    ``value`` is the first metric of the rule whose own comparison holds.
    """
    entries = []
    for rule, level, conditions, text in sensor.rules:
        fired = F.coalesce(*[F.when(F.expr(_test(*c)), F.col(c[0]).cast("double")) for c in conditions])
        entries.append(
            F.when(
                F.expr(_any_of(conditions)),
                F.struct(
                    F.lit(rule).alias("rule_id"),
                    F.lit(level).alias("rule_level"),
                    F.lit(text).alias("rule_message"),
                    fired.alias("fired_value"),
                ),
            )
        )
    return F.array(*entries)
