"""Per-grid and per-floor coverage, overlap and loss tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridscope.functions.codes import MISSING, rsrp_dbm, rsrq_db, sinr_db
from gridscope.schemas import SAMPLE_KEY

# Thresholds of the coverage report.
CO_STRENGTH_GAP = 6
CO_STRENGTH_ROWS = 3
WEAK_DBM = -110
# Fixed values: (column, lower edge, upper edge); lower edge inside, upper edge outside.
RSRP_BINS = (
    ("rsrp_140_110_count", -140, -110),
    ("rsrp_110_100_count", -110, -100),
    ("rsrp_100_90_count", -100, -90),
    ("rsrp_90_80_count", -90, -80),
    ("rsrp_80_count", -80, None),
)
SINR_BINS = (
    ("sinrul_3_count", None, -3),
    ("sinrul_3_0_count", -3, 0),
    ("sinrul_0_10_count", 0, 10),
    ("sinrul_10_15_count", 10, 15),
    ("sinrul_15_count", 15, None),
)
KPI_COUNTS = ("mrpointnum", "weakpointnum")


def _ones(condition: Column, kind: str = "int") -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast(kind)


def _within(value: Column, low, high) -> Column:
    tests = [value >= low] if low is not None else []
    if high is not None:
        tests.append(value < high)
    return tests[0] & tests[1] if len(tests) == 2 else tests[0]


def co_strength(mro: DataFrame, gap: int = CO_STRENGTH_GAP) -> DataFrame:
    """Neighbour rows about as strong as the serving cell."""
    return mro.where(F.abs(F.col("ltescrsrp") - F.col("ltencrsrp")) <= gap)


def overlap_samples(mro: DataFrame, gap: int = CO_STRENGTH_GAP,
                    min_rows: int = CO_STRENGTH_ROWS) -> DataFrame:
    """Keys of samples with enough co-strength neighbours, counted before any join."""
    return (
        co_strength(mro, gap).groupBy(*SAMPLE_KEY).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= min_rows)
        .drop("_rows")
    )


def overlap_by_grid(located: DataFrame, mro: DataFrame) -> DataFrame:
    """Number of overlap samples per grid; ``located`` has one row per sample."""
    marked = overlap_samples(mro).withColumn("_overlap", F.lit(1))
    return (
        located.select(*SAMPLE_KEY, "gridid").join(marked, list(SAMPLE_KEY), "left")
        .groupBy("gridid")
        .agg(_ones(F.col("_overlap").isNotNull()).alias("overlapd"))
    )


def grid_measures(located: DataFrame) -> DataFrame:
    """A2: counts, means and signal bins per (grid, cell, floor)."""
    dbm = rsrp_dbm("ltescrsrp")
    sinr = F.col("ltescsinrul") - 11
    bins = [_ones(_within(dbm, low, high)).alias(name) for name, low, high in RSRP_BINS]
    for name, low, high in SINR_BINS:
        test = _within(sinr, low, high)
        if low is None:
            test = test & (F.col("ltescsinrul") > MISSING)
        bins.append(_ones(test).alias(name))
    return located.groupBy("gridid", "objectid", "height").agg(
        F.count(F.lit(1)).alias("mrpointnum"),
        _ones(dbm <= WEAK_DBM, "bigint").alias("weakpointnum"),
        F.avg(dbm).alias("avgrsrp"),
        F.avg(rsrq_db("ltescrsrq")).alias("avgrsrq"),
        F.avg(sinr_db("ltescsinrul")).alias("avgsinrul"),
        *bins,
    )


def _kpi_columns() -> list[str]:
    bins = [name for name, _, _ in (*RSRP_BINS, *SINR_BINS)]
    return ["gridid", "objectid", *KPI_COUNTS, "avgrsrp", "avgrsrq", "avgsinrul", *bins,
            "height", "overlapd"]


def empty_grids(placed: DataFrame, ground: DataFrame) -> DataFrame:
    """Ground grids without samples, with the fingerprint signal and missing marks.

    ``placed`` has gridid and height: the grid measures, or cheaper the located samples themselves.
    """
    seen = placed.where(F.col("height") == 0).select("gridid")
    filler = ground.select("gridid", "objectid", F.col("rsrp").cast("double").alias("avgrsrp")) \
        .join(seen, "gridid", "left_anti").distinct()
    counts = [F.lit(0).cast("bigint").alias(c) for c in KPI_COUNTS]
    bins = [F.lit(0).alias(name) for name, _, _ in (*RSRP_BINS, *SINR_BINS)]
    missing = [F.lit(float(MISSING)).alias(c) for c in ("avgrsrq", "avgsinrul")]
    return filler.select("*", *counts, *missing, *bins, F.lit(0).alias("height"),
                         F.lit(0).alias("overlapd")).select(*_kpi_columns())


def grid_kpi(located: DataFrame, overlaps: DataFrame, ground: DataFrame | None = None) -> DataFrame:
    """Grid measures with overlap; with ``ground`` also the grids without samples.

    Overlap is one value per grid, so it is joined after the aggregation.
    """
    kpi = (
        grid_measures(located)
        .join(overlaps.select("gridid", "overlapd"), "gridid", "left")
        .withColumn("overlapd", F.coalesce("overlapd", F.lit(0)))
        .select(*_kpi_columns())
    )
    return kpi if ground is None else kpi.unionByName(empty_grids(located, ground))


LOSS_COLUMNS = ("ulqci1", "dlqci1", "ltescpuschprbnum", "ltescpdschprbnum", "ta")


def sample_loss(located: DataFrame, mro: DataFrame) -> DataFrame:
    """Located samples with their distinct raw loss and load readings, folded before they are joined."""
    raw = mro.select(*SAMPLE_KEY, *LOSS_COLUMNS).distinct()
    return located.select(*SAMPLE_KEY, "gridid").join(raw, list(SAMPLE_KEY))


def sample_facts(located: DataFrame, mro: DataFrame, gap: int = CO_STRENGTH_GAP, min_rows: int = CO_STRENGTH_ROWS) -> DataFrame:
    """J3 and J15 together: located samples with their distinct loss readings, and whether they overlap.

    The reports are folded once, by sample and reading, and joined once. ``overlap`` is set in one row of each
    sample, ``reported`` where the sample has a reading. Overlap and loss tables are sums of this one.
    """
    gap_rows = F.coalesce(F.abs(F.col("ltescrsrp") - F.col("ltencrsrp")) <= gap, F.lit(False))
    folded = mro.groupBy(*SAMPLE_KEY, *LOSS_COLUMNS).agg(_ones(gap_rows, "bigint").alias("_rows")).withColumn("reported", F.lit(True))
    joined = located.select(*SAMPLE_KEY, "gridid").join(folded, list(SAMPLE_KEY), "left")
    sample = Window.partitionBy(*SAMPLE_KEY)
    is_first = F.row_number().over(sample.orderBy(*LOSS_COLUMNS)) == 1
    overlap = F.coalesce(F.sum("_rows").over(sample) >= min_rows, F.lit(False))
    return joined.select(*SAMPLE_KEY, "gridid", *LOSS_COLUMNS, F.coalesce("reported", F.lit(False)).alias("reported"),
                         F.when(is_first, overlap).alias("overlap"))


def overlap_of(facts: DataFrame) -> DataFrame:
    """C8 / A3 from ``sample_facts``."""
    return facts.groupBy("gridid").agg(_ones(F.col("overlap")).alias("overlapd"))


def loss_of(facts: DataFrame) -> DataFrame:
    """C10 / A4 from ``sample_facts``."""
    return grid_loss(facts.where("reported"))


def _mean_loss(value: Column, valid: Column) -> Column:
    return F.avg(F.when(valid, value)).cast("decimal(18,4)")


def grid_loss(samples: DataFrame) -> DataFrame:
    """A4: reporting samples, mean loss and load per (grid, timing advance)."""
    up, down = F.col("ulqci1"), F.col("dlqci1")
    has_up, has_down = F.coalesce(up >= 0, F.lit(False)), F.coalesce(down >= 0, F.lit(False))

    def load(name: str) -> Column:
        return F.sum(F.when(F.col(name) >= 0, F.col(name)).otherwise(0)).cast("bigint")

    return samples.groupBy("gridid", "ta").agg(
        _ones(has_up | has_down, "bigint").alias("udtotal"),
        _ones(has_up, "bigint").alias("uptotal"),
        _ones(has_down, "bigint").alias("dltotal"),
        _mean_loss(up, has_up).alias("uplost"),
        _mean_loss(down, has_down).alias("dllost"),
        load("ltescpuschprbnum").alias("pusum"),
        load("ltescpdschprbnum").alias("pdsum"),
    )


def packet_loss(located: DataFrame, mro: DataFrame) -> DataFrame:
    """C10."""
    return grid_loss(sample_loss(located, mro))


# Fixed values: (column, loss, lower edge, upper edge) of the loss bands in percent of
# lost/10. Neighbouring bands share some edges.
LOSS_BANDS = (
    ("ulqci1", "uplost", None, "<= 1"),
    ("ulqci20", "uplost", ">= 1", "< 20"),
    ("ulqci80", "uplost", ">= 20", "< 80"),
    ("dlqci1", "dllost", None, "<= 1"),
    ("dlqci20", "dllost", ">= 1", "<= 20"),
    ("dlqci80", "dllost", ">= 20", "<= 80"),
)


def loss_bands(kpi: DataFrame, loss: DataFrame) -> DataFrame:
    """A5: report points per loss band and point-weighted timing advance.

    One row per grid and set of loss values, so a grid may have several rows.
    Points are first summed per grid, the timing advance enters by its sum.
    """
    points = kpi.groupBy("gridid").agg(F.sum("mrpointnum").alias("_points"))
    keys = ["gridid", "uptotal", "uplost", "dllost", "pusum", "pdsum", "udtotal"]
    joined = points.join(loss, "gridid", "left")
    bands = []
    for name, lost, low, high in LOSS_BANDS:
        edges = [f"{lost} / 10 {edge}" for edge in (low, high) if edge]
        bands.append(F.expr(f"sum(case when {' and '.join(edges)} then _points else 0 end)")
                     .cast("bigint").alias(name))
    weighted = F.sum(F.col("ta") * F.col("_points")).cast("double")
    return joined.groupBy(*keys).agg(
        *bands, F.try_divide(weighted, F.sum("_points").cast("double")).alias("averageta"))


def grid_centres(finger: DataFrame) -> DataFrame:
    return finger.select("gridid", "longitude", "latitude").distinct()


def grid_result(kpi: DataFrame, loss: DataFrame, finger: DataFrame) -> DataFrame:
    """Grid measures with position, loss and load."""
    bands = (
        loss_bands(kpi, loss)
        .withColumn("uprate", (F.col("uplost") / 10).cast("double"))
        .withColumn("dlrate", (F.col("dllost") / 10).cast("double"))
        .drop("uplost")
    )
    kept = ["gridid", "objectid", "height", "mrpointnum", "avgrsrp",
            *[name for name, _, _ in RSRP_BINS], "avgsinrul", "overlapd"]
    return kpi.select(*kept).join(bands, "gridid", "left").join(grid_centres(finger), "gridid", "left")


def sample_positions(located: DataFrame, finger: DataFrame) -> DataFrame:
    """Located samples with the centre of their grid."""
    return located.join(grid_centres(finger), "gridid")


def floor_rsrp(kpi: DataFrame, grid_building: DataFrame) -> DataFrame:
    """Mean grid signal per building and floor."""
    return (
        kpi.select("gridid", "height", "avgrsrp").join(grid_building, "gridid")
        .groupBy("buildingid", "height")
        .agg(F.avg("avgrsrp").alias("rsrp"))
    )


def mean_grid_rsrp(finger: DataFrame) -> DataFrame:
    """A10: mean fingerprint signal per grid."""
    return finger.groupBy("gridid", "longitude", "latitude").agg(F.avg("rsrp").alias("avgrsrp"))
