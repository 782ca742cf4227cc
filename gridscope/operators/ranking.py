"""Row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridscope.sources.tables import cut_lineage

# ``monotonically_increasing_id`` keeps the place inside a partition in its lower bits.
PLACE_BITS = 33


def global_row_number(df: DataFrame, key: str, name: str = "row_number", ranges: int | None = None) -> DataFrame:
    """Number all rows by a numeric ``key`` without sorting them in one task.

    Rows are dealt once by ranges of the key and a hash of the row, so that a hot key spreads over several
    ranges, sorted inside them and written with their range and place. How many rows
    the ranges before hold is read from that column alone: as many numbers as there are ranges.
    There are as many ranges as the session has shuffle partitions unless told otherwise.
    Null keys come first; rows with equal keys follow a hash of the row.
    """
    ranges = max(2, ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut_lineage(
        df.withColumn("_hash", F.xxhash64(*df.columns))
        .repartitionByRange(ranges, key, "_hash")
        .sortWithinPartitions(key, "_hash", *df.columns)
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_hash"), "ranges")
    of_range = F.shiftright("_place", PLACE_BITS)
    totals = placed.groupBy(of_range.alias("_range")).agg(F.count(F.lit(1)).alias("_total"))
    before = totals.select("_range", F.coalesce(
        F.sum("_total").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # one row per range: its size is known by the argument
    return placed.join(F.broadcast(before), of_range == F.col("_range")) \
        .select(*df.columns, (F.col("_before") + inside + 1).cast("bigint").alias(name))


def rank_slice(df: DataFrame, rank: str, low: int, high: int) -> DataFrame:
    """Rows with ``low < rank <= high``."""
    return df.where((F.col(rank) > low) & (F.col(rank) <= high))
