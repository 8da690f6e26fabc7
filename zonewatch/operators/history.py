"""Historical analysis: zone ranking, hourly profile, traffic-pollution correlation, report facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewatch.functions.stats import correlation
from zonewatch.operators.daily import DAY_KEYS


@dataclass(frozen=True)
class Bases:
    """What all findings are made from: sums of each sensor per day and zone (traffic: and hour)."""

    pollution: DataFrame | None
    traffic: DataFrame | None


def _sums(rows: DataFrame, keys: tuple[str, ...], **fields: str) -> DataFrame:
    totals = [F.sum(F.col(f).cast("double")).alias(f"{name}_sum") for name, f in fields.items()]
    counts = [F.count(f).alias(f"{name}_n") for name, f in fields.items()]
    return rows.groupBy(*keys).agg(*totals, *counts)


def pollution_base(pollution: DataFrame) -> DataFrame:
    """The one pass over the pollution readings."""
    return _sums(pollution, DAY_KEYS, aqi="air_quality_index", co2="co2_ppm", pm25="pm25")


def traffic_base(traffic: DataFrame) -> DataFrame:
    """The one pass over the traffic readings."""
    return _sums(traffic, (*DAY_KEYS, "heure"), vehicles="vehicles_per_min", speed="avg_speed_kmh")


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(f"avg_{name}")


def pollution_by_zone(base: DataFrame) -> DataFrame:
    """Mean air quality per zone, worst first."""
    return base.groupBy("zone").agg(_mean("aqi"), _mean("co2"), _mean("pm25")).orderBy(F.desc_nulls_last("avg_aqi"), "zone")


def traffic_by_hour(base: DataFrame) -> DataFrame:
    """Mean traffic per hour of day, in day order."""
    return base.groupBy("heure").agg(_mean("vehicles"), _mean("speed")).orderBy("heure")


def zone_extremes(ranking: DataFrame) -> DataFrame:
    """Worst and best zone of a ranking as one row; ties go to the first name."""
    measured = ranking.filter(F.col("avg_aqi").isNotNull())
    worst = F.min_by(F.struct("zone", "avg_aqi"), F.struct(-F.col("avg_aqi"), "zone"))
    best = F.min_by(F.struct("zone", "avg_aqi"), F.struct("avg_aqi", "zone"))
    return measured.agg(worst.alias("worst"), best.alias("best")).select(
        F.col("worst.zone").alias("worst_zone"),
        F.col("worst.avg_aqi").alias("worst_aqi"),
        F.col("best.zone").alias("best_zone"),
        F.col("best.avg_aqi").alias("best_aqi"),
    )


def peak_hour(profile: DataFrame) -> DataFrame:
    """Hour with the most vehicles; ties go to the earlier hour."""
    measured = profile.filter(F.col("avg_vehicles").isNotNull())
    return measured.orderBy(F.desc("avg_vehicles"), "heure").limit(1)


def traffic_pollution_daily(pollution: DataFrame, traffic: DataFrame) -> DataFrame:
    """Daily means of both sensors, from their bases, for the days and zones that have both.

    Each side is aggregated first, so the join sees one row per day and zone and
    reuses the partitioning of the aggregates.
    """
    air = pollution.groupBy(*DAY_KEYS).agg(_mean("aqi"))
    cars = traffic.groupBy(*DAY_KEYS).agg(_mean("vehicles"))
    return air.join(cars, list(DAY_KEYS), "inner")


def traffic_pollution_corr(paired: DataFrame) -> DataFrame:
    return paired.agg(correlation(F.col("avg_vehicles"), F.col("avg_aqi")).alias("traffic_pollution_corr"))


def zone_facts(ranking: DataFrame) -> DataFrame:
    """Worst and best zone as (fact, subject, value) rows, from one pass over the ranking."""
    extremes = zone_extremes(ranking)
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{side}_zone").alias("fact"),
                F.col(f"{side}_zone").alias("subject"),
                F.col(f"{side}_aqi").alias("value"),
            )
            for side in ("worst", "best")
        ]
    )
    return extremes.select(F.inline(rows)).filter(F.col("value").isNotNull())


def peak_fact(profile: DataFrame) -> DataFrame:
    return peak_hour(profile).select(
        F.lit("peak_hour").alias("fact"),
        F.col("heure").cast("string").alias("subject"),
        F.col("avg_vehicles").alias("value"),
    )


def corr_fact(corr: DataFrame) -> DataFrame:
    """The correlation, absent when it cannot be computed."""
    rows = corr.select(
        F.lit("traffic_pollution_corr").alias("fact"),
        F.lit(None).cast("string").alias("subject"),
        F.col("traffic_pollution_corr").alias("value"),
    )
    return rows.filter(F.col("value").isNotNull())


def report_facts(ranking: DataFrame, profile: DataFrame, corr: DataFrame) -> DataFrame:
    """All findings of the report; a finding without data is absent."""
    return zone_facts(ranking).unionByName(peak_fact(profile)).unionByName(corr_fact(corr))


def facts_of(bases: Bases) -> DataFrame:
    """All findings from the bases of both sensors."""
    corr = traffic_pollution_corr(traffic_pollution_daily(bases.pollution, bases.traffic))
    return report_facts(pollution_by_zone(bases.pollution), traffic_by_hour(bases.traffic), corr)


def recommendations(facts: DataFrame) -> DataFrame:
    """Which actions the findings call for, and where."""
    action = (
        F.when(F.col("fact") == "worst_zone", "monitor_zone")
        .when(F.col("fact") == "peak_hour", "adapt_signals")
        .when(F.col("fact") == "traffic_pollution_corr", "cross_peaks")
    )
    return facts.select(action.alias("action"), "subject").filter(F.col("action").isNotNull())
