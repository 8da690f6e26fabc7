"""Raw files and stored tables. A missing path means "no data"; any other failure is raised."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from zonewatch.operators import parse
from zonewatch.sensors import SENSORS, Sensor

DAY_SCHEMA = "date_partition date"
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _or_none(load) -> DataFrame | None:
    try:
        return load()
    except AnalysisException as err:
        if err.getCondition() in ABSENT:
            return None
        raise


def raw_path(root: str, sensor: str) -> str:
    """Folder of one sensor's raw files: a plain folder or one written by the landing stream."""
    return f"{root}/{{{sensor},sensor_type={sensor}}}/*"


def raw_lines(spark: SparkSession, root: str, sensor: Sensor) -> DataFrame | None:
    """Raw lines (``value``) of one sensor's files, blank ones left out; ``None`` if there are none."""
    found = _or_none(lambda: spark.read.text(raw_path(root, sensor.name)))
    lines = None if found is None else filled(found)
    return None if lines is None or lines.isEmpty() else lines


def filled(lines: DataFrame) -> DataFrame:
    return lines.select("value").filter(F.trim("value") != "")


def raw_readings(spark: SparkSession, root: str, sensor: Sensor) -> DataFrame | None:
    """Raw readings under the sensor's fixed schema; ``None`` if there are none."""
    lines = raw_lines(spark, root, sensor)
    return None if lines is None else parse.decode_lines(lines, sensor).drop("value", "bad_number")


def processed_schema(sensor: Sensor) -> StructType:
    extra = [StructField("heure", IntegerType()), StructField("date_partition", DateType())]
    return StructType(list(sensor.schema) + extra)


def table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A stored table, ``None`` if the path does not exist."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _or_none(lambda: reader.parquet(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    return table(spark, path) is not None


def table_or_none(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A stored table that holds rows, else ``None``."""
    found = table(spark, path, schema)
    return None if found is None or found.isEmpty() else found


def add_version(table: DataFrame, path: str) -> None:
    """A new version of a small table, as one file: it is there as a whole or not at all."""
    spark = table.sparkSession
    known = table_or_none(spark, path)
    number = 0 if known is None else known.agg(F.max("version")).first()[0] + 1
    table.coalesce(1).write.parquet(f"{path}/version={number}")


def newest_version(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest version of a table of versions; empty if there is none."""
    found = _or_none(lambda: spark.read.schema(f"{schema}, version int").parquet(path))
    if found is None:
        return spark.createDataFrame([], schema)
    return found.filter(F.col("version") == found.agg(F.max("version")).scalar()).drop("version")


def processed(spark: SparkSession, lake: str, name: str) -> DataFrame | None:
    return table(spark, f"{lake}/processed/{name}", processed_schema(SENSORS[name]))


def aggregated(spark: SparkSession, lake: str, name: str) -> DataFrame | None:
    return table(spark, f"{lake}/aggregated/{name}")
