"""Historical report over the processed tables. Summaries are written once and read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zonewatch.operators import history
from zonewatch.session import prepare
from zonewatch.sources import tables

TABLE_HEAD = 10


def write_summary(spark: SparkSession, summary: DataFrame, lake: str, name: str) -> DataFrame:
    """Replace a named summary and return it as stored, so later uses do not compute it again."""
    path = f"{lake}/aggregated/analysis/{name}"
    summary.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Report:
    """Each part is ``None`` when its input is missing."""

    ranking: DataFrame | None
    profile: DataFrame | None
    paired: DataFrame | None
    facts: DataFrame | None


def build(spark: SparkSession, lake: str) -> Report:
    prepare(spark)
    schema = tables.processed_schema

    def stored(name: str) -> DataFrame | None:
        return tables.table_or_none(spark, f"{lake}/processed/{name}", schema(tables.SENSORS[name]))

    pollution, traffic = stored("pollution"), stored("traffic")
    # Each history is read once, into sums per day; everything below is made from those.
    if pollution is not None:
        pollution = write_summary(spark, history.pollution_base(pollution), lake, "pollution_base")
    if traffic is not None:
        traffic = write_summary(spark, history.traffic_base(traffic), lake, "traffic_base")
    ranking = profile = paired = None
    if pollution is not None:
        ranking = write_summary(spark, history.pollution_by_zone(pollution), lake, "pollution_by_zone")
    if traffic is not None:
        profile = write_summary(spark, history.traffic_by_hour(traffic), lake, "traffic_by_hour")
    if pollution is not None and traffic is not None:
        joined = history.traffic_pollution_daily(pollution, traffic)
        paired = write_summary(spark, joined, lake, "traffic_pollution_correlation")
    return Report(ranking, profile, paired, _facts(ranking, profile, paired))


def _facts(ranking, profile, paired) -> DataFrame | None:
    parts = []
    if ranking is not None:
        parts.append(history.zone_facts(ranking))
    if profile is not None:
        parts.append(history.peak_fact(profile))
    if paired is not None:
        parts.append(history.corr_fact(history.traffic_pollution_corr(paired)))
    facts = None
    for part in parts:
        facts = part if facts is None else facts.unionByName(part)
    return facts


def markdown_table(rows: DataFrame, columns, head: int = TABLE_HEAD) -> str:
    """The first ``head`` rows as Markdown; a report never shows more."""
    shown = rows.select(*columns).limit(head).collect()
    if not shown:
        return "_Aucune donnée disponible._"
    lines = [list(columns), ["---"] * len(columns)] + [[str(v) for v in row] for row in shown]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)


def markdown(report: Report) -> str:
    """The report as text: findings, then the heads of both tables."""
    nothing = "_Aucune donnée disponible._"
    parts = ["# Analyse historique", "", "## Constats", ""]
    parts.append(markdown_table(report.facts, ("fact", "subject", "value")) if report.facts is not None else nothing)
    parts += ["", "## Recommandations", ""]
    if report.facts is not None:
        parts.append(markdown_table(history.recommendations(report.facts), ("action", "subject")))
    else:
        parts.append(nothing)
    parts += ["", "## Pollution par zone", ""]
    ranked = report.ranking.orderBy("avg_aqi", ascending=False) if report.ranking is not None else None
    parts.append(markdown_table(ranked, ("zone", "avg_aqi", "avg_co2", "avg_pm25")) if ranked is not None else nothing)
    parts += ["", "## Trafic par heure", ""]
    hours = report.profile.orderBy("heure") if report.profile is not None else None
    parts.append(markdown_table(hours, ("heure", "avg_vehicles", "avg_speed")) if hours is not None else nothing)
    return "\n".join(parts) + "\n"
