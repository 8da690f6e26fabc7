"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone: dates, hours and ISO texts must not depend on the machine. Times are written
    in a form that carries statistics, so that scans skip files and row groups by time."""
    for name, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")):
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="zonewatch-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, read as often as needed."""
    path = run_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
