"""Step bands: dashboard colours and the derived bands that readings carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonewatch import settings


def step_band(value: Column, lowest: str, steps, above: bool = False) -> Column:
    """Name of the highest step the value reaches (``above``: strictly exceeds); null stays null."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in sorted(steps, reverse=True):
        chain = chain.when(value > bound if above else value >= bound, name)
    return chain.otherwise(lowest)


def colour(field: str, value: Column) -> Column:
    lowest, steps = settings.COLOUR_STEPS[field]
    return step_band(value, lowest, steps)


def field_colour(field: Column, value: Column) -> Column:
    """Colour by the row's own field name; null for a field without steps."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for name in settings.COLOUR_STEPS:
        chain = chain.when(field == name, colour(name, value))
    return chain


def level_colour(level: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, shade in settings.LEVEL_COLOURS.items():
        chain = chain.when(level == name, shade)
    return chain


def field_label(field: Column) -> Column:
    """Display name of a field, the field itself when it has none."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, label in settings.FIELD_LABELS.items():
        chain = chain.when(field == name, label)
    return chain.otherwise(field)


def congestion(vehicles: Column) -> Column:
    return step_band(vehicles, *settings.CONGESTION_STEPS, above=True)


def bin_full(fill: Column) -> Column:
    return F.when(fill > settings.FULL_BIN_ABOVE, "true").otherwise("false")

