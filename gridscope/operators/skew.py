"""Which cells are heavy, and rows split by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscope.sources.tables import cut_lineage

# Fixed value: a cell is heavy from this multiple of the mean.
HEAVY_FACTOR = 2.3


def pair_counts(mro: DataFrame, finger: DataFrame) -> DataFrame:
    """Number of distinct cell pairs of each serving cell that both tables know."""
    reported = mro.select("objectid", "ncellobjectid").distinct()
    known = finger.select("objectid", F.col("n_objectid").alias("ncellobjectid")).distinct()
    return (
        reported.join(known, ["objectid", "ncellobjectid"])
        .groupBy("objectid").agg(F.count(F.lit(1)).alias("objectcount"))
    )


def skew_report(counts: DataFrame, factor: float = HEAVY_FACTOR) -> DataFrame:
    """Pair count beside mean and maximum, and whether the cell is heavy."""
    overall = counts.agg(F.avg("objectcount").alias("avgcount"), F.max("objectcount").alias("maxcount"))
    report = counts.select(
        "objectid", "objectcount",
        overall.select("avgcount").scalar().alias("avgcount"),
        overall.select("maxcount").scalar().alias("maxcount"),
    )
    heavy = (F.col("objectcount") >= F.col("avgcount") * factor) | (F.col("objectcount") == F.col("maxcount"))
    return report.withColumn("heavy", heavy)


def heavy_cells(mro: DataFrame, finger: DataFrame, factor: float = HEAVY_FACTOR) -> DataFrame:
    """One row per heavy cell. Written, so that rows meet a list of known size and are not brought together by cell for it."""
    counts = cut_lineage(pair_counts(mro, finger), "pair_counts")
    return cut_lineage(skew_report(counts, factor).where("heavy").select("objectid"), "heavy_cells")


def rows_in(df: DataFrame, keys: DataFrame, key: str = "objectid") -> DataFrame:
    """Rows whose key is listed."""
    return df.join(keys.select(key), key, "left_semi")


def rows_not_in(df: DataFrame, keys: DataFrame, key: str = "objectid") -> DataFrame:
    """Rows whose key is known and not listed."""
    return df.where(F.col(key).isNotNull()).join(keys.select(key), key, "left_anti")
