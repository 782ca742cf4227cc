"""Build the fingerprint tables and calibrate them with drive tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope import schemas
from gridscope.operators import fingerprint, mdt
from gridscope.sources.tables import write_table


def _replace(df: DataFrame, path: str) -> DataFrame:
    write_table(df, path, mode="overwrite")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build(raw: DataFrame, cells: DataFrame, ground_path: str, upper_path: str) -> tuple[DataFrame, DataFrame]:
    """Ground and upper fingerprint tables from raw antenna rows."""
    ground, upper = fingerprint.build_fingerprint(raw, cells)
    return _replace(ground, ground_path), _replace(upper, upper_path)


def build_layers(spark: SparkSession, serving: str, neighbour: str, ground_path: str, upper_path: str,
                 heights: Iterable[int] = fingerprint.floors()) -> tuple[DataFrame, DataFrame]:
    """Ground and upper fingerprint tables from one serving and one neighbour table per floor.

    ``serving`` and ``neighbour`` are paths in which ``{height}`` stands for the floor, or, where it doesn't occur, tables
    with a folder ``height=...`` per floor, read in one scan a side.
    """
    heights = list(heights)
    if "{height}" in serving and "{height}" in neighbour:
        ground, upper = fingerprint.build_fingerprint_layers(
            *({h: spark.read.parquet(path.format(height=h)) for h in heights} for path in (serving, neighbour)))
    else:
        ground, upper = fingerprint.split_layers(
            *(spark.read.parquet(path).where(F.col("height").isin(heights)) for path in (serving, neighbour)))
    return _replace(ground, ground_path), _replace(upper, upper_path)


def calibrate(spark: SparkSession, points: DataFrame, ground_path: str, stats_path: str,
              calibrated_path: str) -> DataFrame:
    """Drive-test statistics per grid, and the ground fingerprint corrected with them."""
    ground = spark.read.schema(schemas.FINGER).parquet(ground_path)
    stats = _replace(mdt.mdt_grid_stats(mdt.mdt_locate(points, ground), ground), stats_path)
    return _replace(fingerprint.calibrate_fingerprint(ground, stats), calibrated_path)
