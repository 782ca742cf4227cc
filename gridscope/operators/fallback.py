"""Place the remaining samples by timing advance and arrival angle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscope.functions.geo import ta_aoa_point
from gridscope.schemas import SAMPLE_KEY, SERVING

# Fixed value: the random part of a timing advance lies below this.
JITTER_RANGE = 15


def serving_rows(mro: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per sample, the one with the strongest serving signal."""
    measured = [*SERVING, "ta", "aoa"]
    order = Window.partitionBy(*SAMPLE_KEY).orderBy(
        F.col("ltescrsrp").desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in measured[1:]],
    )
    return (
        mro.select(*SAMPLE_KEY, *measured, *carry)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def unlocated(samples: DataFrame, located: DataFrame) -> DataFrame:
    """Samples without a grid."""
    return samples.join(located.select(*SAMPLE_KEY), list(SAMPLE_KEY), "left_anti")


def hashed_jitter() -> Column:
    """Optional jitter: fixed per sample, so a rerun gives the same place."""
    return F.pmod(F.xxhash64(*SAMPLE_KEY), F.lit(JITTER_RANGE))


def project_from_sites(samples: DataFrame, sites: DataFrame, jitter: Column | None = None) -> DataFrame:
    """The point each sample was reported from."""
    points = samples.join(
        sites.select("objectid", F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat")),
        "objectid",
    )
    place = ta_aoa_point("_lon", "_lat", "ta", "aoa", F.lit(0) if jitter is None else jitter)
    return (
        points.withColumn("_place", place)
        .withColumn("longitude", F.col("_place.lon"))
        .withColumn("latitude", F.col("_place.lat"))
        .drop("_place", "_lon", "_lat")
    )


def quantised(value) -> Column:
    """A coordinate at 4 decimals."""
    return F.col(value).cast("decimal(18,4)")


def grids_by_point(ground: DataFrame) -> DataFrame:
    """One ground grid per quantised point: the lowest floor, then the smallest grid id."""
    order = Window.partitionBy("qlon", "qlat").orderBy("height", "gridid")
    return (
        ground.select(quantised("longitude").alias("qlon"), quantised("latitude").alias("qlat"),
                      "height", "gridid")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def snap_to_grids(points: DataFrame, ground: DataFrame) -> DataFrame:
    """The grid at each sample's quantised point.

    A sample has one serving signal, so the best of its grids is the first of the
    point's grids; choosing it before the join leaves one partner per sample.
    """
    return (
        points.withColumn("qlon", quantised("longitude"))
        .withColumn("qlat", quantised("latitude"))
        .join(grids_by_point(ground), ["qlon", "qlat"])
        .drop("qlon", "qlat")
    )


def locate_by_ta_aoa(samples: DataFrame, sites: DataFrame, ground: DataFrame,
                     jitter: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Samples (one row each, with ta and aoa) placed on the ground grid."""
    placed = snap_to_grids(project_from_sites(samples, sites, jitter), ground)
    order = Window.partitionBy(*SAMPLE_KEY).orderBy("height", "gridid")
    return (
        placed.select(*SAMPLE_KEY, *SERVING, *carry, "gridid", "height")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def with_fallback(mro: DataFrame, located: DataFrame, sites: DataFrame, ground: DataFrame,
                  jitter: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Fingerprint result and fallback result together, one row per sample.

    ``located`` is read twice: pass a written table, not the plan that computes it.
    """
    rest = unlocated(serving_rows(mro, carry), located)
    fallback = locate_by_ta_aoa(rest, sites, ground, jitter, carry)
    columns = [*SAMPLE_KEY, *SERVING, *carry, "gridid", "height"]
    return located.select(*columns).unionByName(fallback.select(*columns))
