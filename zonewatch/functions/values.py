"""Lenient conversions for the point path: a value that cannot be a number becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"


def number(value: Column) -> Column:
    """Double from text; JSON ``true``/``false`` count as 1/0, anything else that is no number is null.

    A number ends in a digit, a point or a blank, all below the letters. That leaves out ``NaN``,
    ``Infinity`` and the ``5d`` form that a cast would take.
    """
    text = value.cast("string")
    word = F.lower(F.trim(text))
    return (
        F.when(F.ascii(F.right(text, F.lit(1))) < ord("A"), text.try_cast("double"))
        .when(word == "true", F.lit(1.0))
        .when(word == "false", F.lit(0.0))
    )


def flag(value: Column, expected: str) -> Column:
    """1.0 when the text equals ``expected`` in any case, else 0.0, never null."""
    return F.when(F.lower(F.coalesce(value, F.lit(""))) == expected, F.lit(1.0)).otherwise(F.lit(0.0))


def tag(value: Column) -> Column:
    return F.coalesce(value, F.lit(UNKNOWN))
