"""Load drive tests from text, and keep their grid sums so that loads can be added in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope.operators import mdt
from gridscope.operators.kpi import grid_centres
from gridscope.sources.mdt_text import read_mdt
from gridscope.sources.tables import overwrite_partition

SUMS = "gridid string, total double, signals long, points long, load string"


def load(spark: SparkSession, layout_1: str, layout_2: str, ground: DataFrame, points_path: str, sums_path: str, name: str,
         **area) -> DataFrame:
    """S3 to J7 for one load: points on the grid and their sums per grid, each as the load's own partition.

    Loading the same name again replaces it.
    """
    located = mdt.mdt_locate(read_mdt(spark, layout_1, layout_2, **area), ground)
    overwrite_partition(located, points_path, load=name)
    written = spark.read.schema(located.schema).parquet(f"{points_path}/load={name}")
    sums = written.groupBy("gridid").agg(
        F.sum(F.col("ltescrsrp").cast("double")).alias("total"), F.count("ltescrsrp").alias("signals"),
        F.expr("count(objectid, time_stamp, mmeues1apid)").alias("points"))
    overwrite_partition(sums, sums_path, load=name)
    return written


def grid_stats(spark: SparkSession, sums_path: str, ground: DataFrame) -> DataFrame:
    """C13 over all loads so far: a row for every ground grid, zeros where no point fell."""
    whole = spark.read.schema(SUMS).parquet(sums_path).groupBy("gridid").agg(
        *[F.sum(c).alias(c) for c in ("total", "signals", "points")])
    return grid_centres(ground).join(whole, "gridid", "left").select(
        "gridid", "longitude", "latitude",
        F.coalesce(F.try_divide("total", F.col("signals").cast("double")), F.lit(0.0)).alias("avgrsrp"),
        F.coalesce(F.col("points").cast("int"), F.lit(0)).alias("mdtpoint"), F.lit(0).alias("height"))
