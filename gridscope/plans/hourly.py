"""Locate the samples of an hour, or of every hour of a table in one go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridscope import schemas
from gridscope.operators.fallback import with_fallback
from gridscope.operators.locate import locate
from gridscope.operators.neighbours import nearest_cell, reported_channels, resolve_neighbours
from gridscope.sources.tables import by_columns, has_rows, overwrite_partition, overwrite_partitions, partition_folders, read_partition

PARTITION = ("day", "hour")
PLACED = "objectid bigint, mmeues1apid string, time_stamp string, ltescrsrp int, ltescrsrq int, " \
          "ltescsinrul double, gridid string, height int"


def locate_hours(spark: SparkSession, mro_path: str, ground: DataFrame, upper: DataFrame, sites: DataFrame,
                 floor_path: str, result_path: str, day: str | None = None, hour: str | None = None,
                 jitter: Column | None = None, fmt: str = "parquet", at: str | None = None) -> bool:
    """Fingerprint result to ``floor_path``, all placed samples to ``result_path``.

    Without day and hour all partitions of the input are done; ``at`` names both as ``yyyyMMddHH``. Returns whether
    there was anything to do.
    """
    if at is not None:
        if len(at) != 10 or not at.isdigit():
            raise ValueError(f"not an hour as yyyyMMddHH: {at}")
        day, hour = at[:8], at[8:]
    mro = read_partition(spark, mro_path, day, hour, fmt, schemas.MRO)
    if not has_rows(mro):
        return False
    hours = [{"day": day, "hour": hour}] if day and hour else partition_folders(mro, PARTITION)
    _write(locate(mro, ground, upper, carry=PARTITION), floor_path, hours, fmt)
    located = read_partition(spark, floor_path, day, hour, fmt, schemas.LOCATED)
    placed = with_fallback(mro, located, sites, ground, jitter, carry=PARTITION)
    _write(placed, result_path, hours, fmt)
    return True


def _write(rows: DataFrame, path: str, hours: list[dict[str, str]], fmt: str) -> None:
    """Replace the named hours; an hour without a result becomes empty.

    Many hours at once are brought together first, or every task would write a file into each.
    """
    if len(hours) == 1:
        overwrite_partition(rows, path, fmt, **hours[0])
        return
    # which hours the result has is noted while it is written
    seen = Observation()
    noted = rows.observe(seen, F.collect_set(F.struct(*PARTITION)).alias("hours"))
    overwrite_partitions(by_columns(noted, *PARTITION), path, PARTITION, fmt)
    done = [{"day": h["day"], "hour": h["hour"]} for h in seen.get["hours"]]
    # hours are few; those that the result lacks are emptied one by one
    for left in hours:
        if left not in done:
            overwrite_partition(rows.limit(0), path, fmt, **left)


def build_mro(mro_wide: DataFrame, cells: DataFrame, mro_path: str, mode: str = "serving",
              fmt: str = "parquet") -> None:
    """Wide reports (with day and hour columns) to the sample table, neighbours resolved."""
    nearest = nearest_cell(reported_channels(mro_wide, cells, mode), cells)
    rows = resolve_neighbours(mro_wide, nearest, mode, carry=PARTITION)
    hours = [row.asDict() for row in mro_wide.select(*PARTITION).distinct().collect()]
    _write(rows, mro_path, hours, fmt)
