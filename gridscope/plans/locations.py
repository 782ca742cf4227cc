"""Coordinates of web logs as a table by day."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridscope.operators.weblocation import extract_locations
from gridscope.sources.tables import overwrite_partitions


def extract(spark: SparkSession, logs_path: str, result_path: str, day: str | None = None, strict: bool = False) -> None:
    """Logs (host, uri, content, by day) to their locations; the days of the input are replaced, others stay."""
    schema = spark.read.parquet(logs_path).drop("day").schema.add("day", "string")
    logs = spark.read.schema(schema).parquet(logs_path)
    if day is not None:
        logs = logs.where(logs.day == day)
    overwrite_partitions(extract_locations(logs, strict).drop("content"), result_path, ("day",))
