"""Build and calibrate the signal fingerprint."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscope.functions.codes import antenna_to_objectid
from gridscope.functions.geo import grid_centre, grid_text
from gridscope.schemas import FINGER_COLUMNS
from gridscope.sources.tables import cut_lineage

# Floors of the layered library.
MAX_HEIGHT = 200
HEIGHT_STEP = 5

# Signal of an indoor cell in its own building, and the spread around it.
INDOOR_RSRP = -90.0
INDOOR_SPREAD = 20.0
INDOOR_SITE_TYPE = 0

#: Tasks that a step with a large result is dealt to.
TASKS_PER_CORE = 4
#: Indoor cells of a building that meet a grid as one row.
CELLS_PER_ROW = 1024


def _slots(raw: DataFrame) -> list[int]:
    """The numbers of the columns ``antenna_0``, ``antenna_1`` and so on, as many as there are."""
    numbered = (c.lower().removeprefix("antenna_") for c in raw.columns if c.lower().startswith("antenna_"))
    return sorted(int(k) for k in numbered if k.isdecimal())


def _slot(k: int) -> Column:
    return F.struct(
        antenna_to_objectid(f"antenna_{k}").cast("bigint").alias("n_objectid"),
        F.col(f"rsrp_{k}").cast("double").alias("n_rsrp"),
    )


def _grid_columns(raw: DataFrame) -> DataFrame:
    centre = grid_centre("google_gci", "google_gri")
    return raw.select(
        "*",
        grid_text("google_gci", "google_gri").alias("gridid"),
        centre["lon"].alias("longitude"),
        centre["lat"].alias("latitude"),
        F.col("grid_height").alias("height"),
    )


def antenna_readings(raw: DataFrame) -> DataFrame:
    """One row per filled antenna slot of a grid."""
    filled = F.filter(
        F.array(*[_slot(k) for k in _slots(raw)]),
        lambda slot: slot["n_objectid"].isNotNull() & slot["n_rsrp"].isNotNull(),
    )
    return (
        _grid_columns(raw)
        .select("gridid", "longitude", "latitude", "height", F.explode(filled).alias("_slot"))
        .select("gridid", "longitude", "latitude", "height", "_slot.n_objectid", "_slot.n_rsrp")
    )


def antenna_readings_by_union(raw: DataFrame) -> DataFrame:
    """The same rows as :func:`antenna_readings`, one branch per slot."""
    grids = _grid_columns(raw)
    slots = [
        grids.select("gridid", "longitude", "latitude", "height", _slot(k).alias("_slot"))
        .select("gridid", "longitude", "latitude", "height", "_slot.n_objectid", "_slot.n_rsrp")
        .where(F.col("n_objectid").isNotNull() & F.col("n_rsrp").isNotNull())
        for k in _slots(raw)
    ]
    return reduce(DataFrame.unionByName, slots)


def cell_channels(cells: DataFrame) -> DataFrame:
    """Distinct (cell, channel)."""
    return cells.select("objectid", "earfcn").distinct()


def strongest_cells(readings: DataFrame, cells: DataFrame) -> DataFrame:
    """Strongest cell per (grid, floor, channel); ties go to the smaller cell id.

    Readings come from wide rows and are many more than Spark expects, so they are not sent whole to every task.
    """
    channels = cell_channels(cells).withColumnRenamed("objectid", "n_objectid")
    order = Window.partitionBy("gridid", "height", "earfcn").orderBy(
        F.col("n_rsrp").desc(), "n_objectid")
    return (
        readings.hint("merge").join(channels, "n_objectid")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .select(F.col("n_objectid").alias("objectid"), "gridid", "longitude", "latitude",
                F.col("n_rsrp").alias("rsrp"), "height")
    )


def cell_pairs(serving: DataFrame, readings: DataFrame) -> DataFrame:
    """Serving cells beside the other cells heard on the same grid and floor."""
    return (
        serving.join(readings.select("gridid", "height", "n_objectid", "n_rsrp").hint("merge"), ["gridid", "height"])
        .where(F.col("objectid") != F.col("n_objectid"))
        .select(*FINGER_COLUMNS)
    )


def ground_layer(finger: DataFrame) -> DataFrame:
    """P5."""
    return finger.where(F.col("height") == 0)


def upper_layers(finger: DataFrame) -> DataFrame:
    """P5."""
    return finger.where(F.col("height") != 0)


def build_fingerprint(raw: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ground layer (distinct rows) and upper layers of the fingerprint.

    Repeated ground readings go before the join; they could only repeat its rows.
    """
    readings = antenna_readings(raw)
    ground, upper = ground_layer(readings).distinct(), upper_layers(readings)
    return (
        cell_pairs(strongest_cells(ground, cells), ground).distinct(),
        cell_pairs(strongest_cells(upper, cells), upper),
    )


def floors(max_height: int = MAX_HEIGHT, step: int = HEIGHT_STEP) -> range:
    return range(0, max_height + 1, step)


def stack_layers(layers: Mapping[int, DataFrame]) -> DataFrame:
    """Tables of single floors as one table with a height column."""
    return reduce(
        DataFrame.unionByName,
        [df.withColumn("height", F.lit(height)) for height, df in sorted(layers.items())],
    )


def join_layers(service: DataFrame, neighbour: DataFrame) -> DataFrame:
    """Serving rows beside their neighbour rows on one floor of one grid."""
    heard = neighbour.select(
        F.col("servicegridid").alias("gridid"), "height",
        F.col("objectid").alias("n_objectid"), F.col("rsrp").alias("n_rsrp"),
    )
    return service.join(heard.hint("merge"), ["gridid", "height"]).select(*FINGER_COLUMNS)


def build_fingerprint_layers(service: Mapping[int, DataFrame],
                             neighbour: Mapping[int, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Ground and upper fingerprint from one serving and one neighbour table per floor."""
    return split_layers(stack_layers(service), stack_layers(neighbour))


def split_layers(service: DataFrame, neighbour: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C2 from tables of all floors; with floors as folders each result reads its own folders."""
    finger = join_layers(service, neighbour)
    return ground_layer(finger), upper_layers(finger)


def measured_grids(mdt_grids: DataFrame) -> DataFrame:
    """The grids that have a measured mean signal; 0 stands for none."""
    return mdt_grids.where(F.col("avgrsrp") != 0.0)


def calibrate_fingerprint(finger: DataFrame, mdt_grids: DataFrame) -> DataFrame:
    """Fingerprint with the measured mean signal where there is one."""
    measured = measured_grids(mdt_grids).select(
        "gridid", F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat"), "avgrsrp")
    return finger.join(measured, "gridid", "left").select(
        "objectid", "gridid",
        F.coalesce("_lon", "longitude").alias("longitude"),
        F.coalesce("_lat", "latitude").alias("latitude"),
        F.coalesce("avgrsrp", F.col("rsrp").cast("double")).alias("rsrp"),
        "n_objectid", "n_rsrp", "height",
    )


def hashed_noise(*keys: str) -> Column:
    """Spread between -1/2 and 1/2, fixed per key."""
    steps = 1 << 20
    return F.pmod(F.xxhash64(*keys), F.lit(steps)) / steps - 0.5


def indoor_fingerprint(sites: DataFrame, cells: DataFrame, cell_building: DataFrame,
                       grid_building: DataFrame, serving: DataFrame,
                       noise: Column | None = None, decimals: int | None = None) -> DataFrame:
    """C17: serving rows of indoor cells on every grid of the buildings they cover.

    A cell and a grid that share several buildings meet in the least of them, so what a building's cells and grids give,
    which is as large as the result, is neither shuffled nor made distinct. Grids are dealt out one by one, whatever
    their building. Cells that cover the same buildings meet a grid together, ``CELLS_PER_ROW`` or so in a row, and
    become rows last; one list of cells follows the other for all grids of a task, which columnar files store in little
    room. ``decimals`` rounds the coordinates, once for each place.
    """
    served = (
        sites.where(F.col("sitetype") == INDOOR_SITE_TYPE).select(F.col("oid").alias("siteoid"))
        .join(cells.select("siteoid", "objectid"), "siteoid")
        .join(cell_building.select("objectid", "buildingid"), "objectid")
        .groupBy("objectid").agg(F.sort_array(F.collect_set("buildingid")).alias("_covers"))
    )
    # One row per cell and building. Written, as it is read twice.
    served = cut_lineage(served.select("objectid", "_covers", F.explode("_covers").alias("buildingid")), "served")
    covering = ("buildingid", "_covers")
    lists = served.groupBy(*covering).agg(F.ceil(F.count(F.lit(1)) / CELLS_PER_ROW).alias("_lists"))
    together = served.join(lists, list(covering)) \
        .groupBy(*covering, F.pmod(F.xxhash64("objectid"), "_lists").alias("_list")) \
        .agg(F.sort_array(F.collect_list("objectid")).alias("_cells"))
    parts = TASKS_PER_CORE * serving.sparkSession.sparkContext.defaultParallelism
    places = serving.select("gridid", "longitude", "latitude", "height").distinct()
    if decimals is not None:
        places = places.withColumns({c: F.round(c, decimals) for c in ("longitude", "latitude")})
    buildings = grid_building.groupBy("gridid").agg(F.collect_set("buildingid").alias("_stands_in"))
    grids = (
        places.join(buildings, "gridid").withColumn("_part", F.pmod(F.xxhash64("gridid", "height"), F.lit(parts)).cast("int"))
        .withColumn("buildingid", F.explode("_stands_in"))
    )
    # The result is far larger than both sides, so their size must not decide how many tasks there are.
    copies, grids = (
        side.repartition(parts, "buildingid", "_part")
        for side in (together.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), grids))
    least = F.array_min(F.array_intersect("_covers", "_stands_in"))
    alone = (F.size("_covers") == 1) | (F.size("_stands_in") == 1)
    covered = copies.join(grids.hint("merge"), ["buildingid", "_part"]).where(alone | (F.col("buildingid") == least)) \
        .select(F.explode("_cells").alias("objectid"), "gridid", "longitude", "latitude", "height")
    noise = hashed_noise("objectid", "gridid", "height") if noise is None else noise
    return covered.select("objectid", "gridid", "longitude", "latitude",
                          (noise * INDOOR_SPREAD + INDOOR_RSRP).cast("double").alias("rsrp"), "height")
