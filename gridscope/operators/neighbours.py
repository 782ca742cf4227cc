"""Neighbour identities by channel and physical cell id."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscope.functions.columns import dbl
from gridscope.functions.geo import HAVERSINE_RADIUS_KM, haversine_metres
from gridscope.operators.ranking import global_row_number, rank_slice
from gridscope.sources.tables import cut_lineage

CHANNEL = ["earfcn", "pci"]
LIST_BUCKETS = 32
# A tile with more cells than this is split before distances are taken.
CELLS_PER_TILE = 64
TILE_BITS = 24
BITS_PER_STEP = 3
AXES = ("x", "y", "z")
# Distances are compared in whole metres, so a bound must leave room for rounding.
SLACK_M = 2.0


def expand_channels(cells: DataFrame, pci_list: DataFrame, buckets: int = LIST_BUCKETS) -> DataFrame:
    """Each cell once per listed (earfcn, pci).

    The list is cut into buckets and joined bucket by bucket, so neither side has
    to fit into one task.
    """
    listed = pci_list.select(*CHANNEL).distinct().withColumn(
        "_bucket", F.pmod(F.xxhash64(*CHANNEL), F.lit(buckets)).cast("int"))
    spread = cells.select("eci", "longitude", "latitude") \
        .withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return spread.join(listed, "_bucket").drop("_bucket")


def _on_sphere(cells: DataFrame) -> DataFrame:
    """Adds the position in metres on a sphere, where straight distance orders like arc length."""
    lon, lat = dbl("longitude") * (math.pi / 180), dbl("latitude") * (math.pi / 180)
    radius = HAVERSINE_RADIUS_KM * 1000
    return cells.select(
        "*", (F.cos(lat) * F.cos(lon) * radius).alias("x"),
        (F.cos(lat) * F.sin(lon) * radius).alias("y"), (F.sin(lat) * radius).alias("z"),
    )


def _tile(level: int) -> Column:
    """Name of the cube that holds a position when space is halved ``level`` times per axis."""
    side = 2 * HAVERSINE_RADIUS_KM * 1000 / (1 << level)
    return F.concat_ws("_", *[F.floor(F.col(a) / side).cast("string") for a in AXES])


def _nearest_targets(cells: DataFrame) -> DataFrame:
    """Cells that can be a nearest one: of cells at one point, only the two smallest ids matter."""
    order = Window.partitionBy(*CHANNEL, "longitude", "latitude").orderBy("eci")
    return (
        cells.select("eci", *CHANNEL, "longitude", "latitude").distinct()
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= 2)
        .drop("_rank")
    )


def _tiles(targets: DataFrame, level: int) -> DataFrame:
    edges = [f(a).alias(f"{n}_{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]
    return targets.groupBy(*CHANNEL, _tile(level).alias("tile")).agg(
        *edges, F.count(F.lit(1)).alias("cells"), F.min("eci").alias("first"), F.max("eci").alias("last"),
    )


def _near_side() -> Column:
    gaps = [F.greatest(F.col(f"lo_{a}") - F.col(f"at_{a}"), F.col(f"at_{a}") - F.col(f"hi_{a}"), F.lit(0.0))
            for a in AXES]
    return F.sqrt(sum(g * g for g in gaps))


def _far_side() -> Column:
    gaps = [F.greatest(F.abs(F.col(f"lo_{a}") - F.col(f"at_{a}")), F.abs(F.col(f"hi_{a}") - F.col(f"at_{a}")))
            for a in AXES]
    return F.sqrt(sum(g * g for g in gaps))


def _narrow(wanted: DataFrame, targets: DataFrame, upper: int | None, lower: int) -> DataFrame:
    """One step down: keep the smaller tiles that can still hold the nearest cell."""
    tiles = _tiles(targets, lower)
    on = list(CHANNEL)
    if upper is not None:
        parents = targets.select(*CHANNEL, _tile(upper).alias("parent"), _tile(lower).alias("tile")).distinct()
        tiles = tiles.join(parents, [*CHANNEL, "tile"])
        wanted = wanted.withColumnRenamed("tile", "parent")
        on.append("parent")
    demand = Window.partitionBy("eci", *CHANNEL)
    others = (F.col("first") != F.col("eci")) | (F.col("last") != F.col("eci"))
    return (
        wanted.join(tiles, on).where(others)
        .withColumn("_near", _near_side())
        .withColumn("_reach", F.min(_far_side()).over(demand))
        .where(F.col("_near") <= F.col("_reach") + SLACK_M)
        .select("eci", *CHANNEL, "longitude", "latitude", *[f"at_{a}" for a in AXES], "tile")
    )


def nearest_cell(demand: DataFrame, cells: DataFrame, cells_per_tile: int = CELLS_PER_TILE) -> DataFrame:
    """For each (eci, earfcn, pci) the nearest other cell on that channel.

    ``demand`` holds eci, longitude, latitude, earfcn and pci. Where a channel
    has few cells they are compared directly. Otherwise space is halved step by
    step, and only tiles that can hold the nearest cell are followed; the result
    is exact. Equal distances go to the smaller cell id.
    """
    targets = _on_sphere(_nearest_targets(cells))
    wanted = _on_sphere(demand.select("eci", "longitude", "latitude", *CHANNEL).distinct())
    wanted = wanted.withColumnsRenamed({a: f"at_{a}" for a in AXES})
    upper, level = None, 0
    fullest = targets.groupBy(*CHANNEL).count().agg(F.max("count")).first()[0] or 0
    while fullest > cells_per_tile and level < TILE_BITS:
        lower = level + BITS_PER_STEP
        wanted = cut_lineage(_narrow(wanted, targets, upper, lower))
        upper = level = lower
        fullest = _tiles(targets, level).agg(F.max("cells")).first()[0]
    found = targets.select(F.col("eci").alias("reci"), *CHANNEL, F.col("longitude").alias("_lon"),
                           F.col("latitude").alias("_lat"), *([_tile(upper).alias("tile")] if upper else []))
    on = [*CHANNEL, "tile"] if upper else list(CHANNEL)
    order = Window.partitionBy("eci", *CHANNEL).orderBy("distance", "reci")
    return (
        wanted.join(found, on)
        .where(F.col("eci") != F.col("reci"))
        .withColumn("distance", haversine_metres("longitude", "_lon", "latitude", "_lat"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == 1)
        .select("eci", *CHANNEL, "reci", "distance")
    )


def nearest_cell_by_pci(cells: DataFrame, pci_list: DataFrame,
                        rank_range: tuple[int, int] | None = None,
                        cells_per_tile: int = CELLS_PER_TILE) -> DataFrame:
    """Nearest other cell for every cell and listed (earfcn, pci).

    ``rank_range`` restricts the possible neighbours to a slice of the cells in
    id order. Listed channels that no possible neighbour has are left out before cells meet the list:
    what is expanded has a result row each, but where a cell is alone on its channel.
    """
    targets = cells
    if rank_range is not None:
        targets = rank_slice(global_row_number(cells, "eci", "ecinum"), "ecinum", *rank_range)
    wanted = pci_list.join(targets.select(*CHANNEL).distinct(), CHANNEL, "left_semi")
    return nearest_cell(expand_channels(cells, wanted), targets, cells_per_tile) \
        .select("eci", *CHANNEL, "reci")


def reported_channels(mro_wide: DataFrame, cells: DataFrame, mode: str = "serving") -> DataFrame:
    """The (eci, earfcn, pci) that reports ask for, with the position of the asking cell.

    Passed to :func:`nearest_cell` in place of the expanded list, it limits the
    search to what :func:`resolve_neighbours` looks up.
    """
    if mode == "serving":
        asked = mro_wide.select("eci", F.col("ltescearfcn").alias("earfcn"), F.col("ltescpci").alias("pci"))
    else:
        slots = F.explode(_readings(mro_wide, "ltencrsrp", "ltencearfcn", "ltencpci")).alias("_slot")
        asked = mro_wide.select("eci", slots).select(
            "eci", F.col("_slot.ltencearfcn").alias("earfcn"), F.col("_slot.ltencpci").alias("pci"))
    return asked.distinct().join(cells.select("eci", "longitude", "latitude"), "eci")


SAMPLE_COLUMNS = {
    "eci": "objectid", "mmeues1apid": "mmeues1apid", "timestamp": "time_stamp",
    "ltescrsrp": "ltescrsrp", "ltescrsrq": "ltescrsrq", "ltescsinrul": "ltescsinrul",
    "ltesctadv": "ta", "ltescaoa": "aoa", "ltescpuschprbnum": "ltescpuschprbnum",
    "ltescpdschprbnum": "ltescpdschprbnum", "ltescplrulqci1": "ulqci1", "ltescplrdlqci1": "dlqci1",
}


def _slots(columns: Sequence[str], field: str) -> list[int]:
    """The numbers of the columns ``field_1``, ``field_2`` and so on, as many as there are."""
    numbered = (c.lower().removeprefix(f"{field}_") for c in columns if c.lower().startswith(f"{field}_"))
    return sorted(int(n) for n in numbered if n.isdecimal())


def _readings(wide: DataFrame, *fields: str) -> Column:
    """Filled neighbour slots as an array of structs, from the numbered columns of each field.

    A slot counts if the first field has its column; a further field without that column is null there.
    """
    known = {field: set(_slots(wide.columns, field)) for field in fields}
    kinds = {c.lower(): kind for c, kind in wide.dtypes}
    types = {field: kinds[f"{field}_{min(known[field])}"] for field in fields}
    slots = F.array(*[
        F.struct(*[(F.col(f"{field}_{i}") if i in known[field] else F.lit(None)).cast(types[field]).alias(field)
                   for field in fields])
        for i in sorted(known[fields[0]])
    ])
    return F.filter(slots, lambda slot: slot[fields[0]].isNotNull())


def unpivot_neighbours(mro_wide: DataFrame) -> DataFrame:
    """One row per filled neighbour slot."""
    slots = {f"ltencrsrp_{i}" for i in _slots(mro_wide.columns, "ltencrsrp")}
    kept = [c for c in mro_wide.columns if c.lower() not in slots]
    return mro_wide.select(*kept, F.explode(_readings(mro_wide, "ltencrsrp")).alias("_slot")) \
        .select(*kept, "_slot.ltencrsrp")


def resolve_neighbours(mro_wide: DataFrame, nearest: DataFrame, mode: str = "serving",
                       carry: Sequence[str] = ()) -> DataFrame:
    """C4: wide reports to one row per neighbour reading with the neighbour's cell id.

    ``serving`` looks the neighbour up by the serving cell's channel, as the
    reports without neighbour identities allow. ``paired`` uses the channel of
    each reading (columns ltencearfcn_i and ltencpci_i).
    """
    sample = [*[F.col(old).alias(new) for old, new in SAMPLE_COLUMNS.items()], *carry]
    known = nearest.select("eci", *CHANNEL, F.col("reci").alias("ncellobjectid"))
    if mode == "serving":
        # Joined before the slots are unfolded: one lookup per report.
        return (
            mro_wide.withColumnsRenamed({"ltescearfcn": "earfcn", "ltescpci": "pci"})
            .join(known, ["eci", *CHANNEL])
            .select(*sample, "ncellobjectid", F.explode(_readings(mro_wide, "ltencrsrp")).alias("_slot"))
            .select("*", "_slot.ltencrsrp").drop("_slot")
        )
    if mode == "paired":
        slots = F.explode(_readings(mro_wide, "ltencrsrp", "ltencearfcn", "ltencpci")).alias("_slot")
        return (
            mro_wide.select("*", slots)
            .select(*mro_wide.columns, "_slot.ltencrsrp", F.col("_slot.ltencearfcn").alias("earfcn"),
                    F.col("_slot.ltencpci").alias("pci"))
            .join(known, ["eci", *CHANNEL])
            .select(*sample, "ncellobjectid", "ltencrsrp")
        )
    raise ValueError(f"mode must be 'serving' or 'paired', not {mode!r}")
