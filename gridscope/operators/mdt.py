"""Drive-test points on the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscope.functions.geo import gridid_of
from gridscope.operators.kpi import grid_centres


def mdt_locate(mdt: DataFrame, ground: DataFrame) -> DataFrame:
    """Points on known ground grids, with the centre of the grid."""
    keyed = mdt.select("objectid", "time_stamp", "mmeues1apid", "ltescrsrp",
                       gridid_of("longitude", "latitude").alias("gridid"))
    return keyed.join(grid_centres(ground), "gridid").withColumn("height", F.lit(0))


def mdt_grid_means(located: DataFrame) -> DataFrame:
    """Mean signal and number of fully keyed points per grid."""
    return located.groupBy("gridid", "longitude", "latitude").agg(
        F.avg("ltescrsrp").alias("avgrsrp"),
        F.expr("count(objectid, time_stamp, mmeues1apid)").cast("int").alias("mdtpoint"),
    ).withColumn("height", F.lit(0))


def grids_without_points(ground: DataFrame, means: DataFrame) -> DataFrame:
    return grid_centres(ground).join(means.select("gridid"), "gridid", "left_anti").select(
        "gridid", "longitude", "latitude", F.lit(0.0).alias("avgrsrp"),
        F.lit(0).alias("mdtpoint"), F.lit(0).alias("height"),
    )


def mdt_grid_stats(located: DataFrame, ground: DataFrame) -> DataFrame:
    """A row for every ground grid, zeros where no point fell."""
    means = mdt_grid_means(located).drop("height")
    return grid_centres(ground).join(means, ["gridid", "longitude", "latitude"], "left").select(
        "gridid", "longitude", "latitude", F.coalesce("avgrsrp", F.lit(0.0)).alias("avgrsrp"),
        F.coalesce("mdtpoint", F.lit(0)).alias("mdtpoint"), F.lit(0).alias("height"))
