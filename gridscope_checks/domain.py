"""Domain tables projected from the driver's tables; SQL twins are in domain_sql.py.

Every table is a projection of whole driver tables, so it grows with them.
A third of the samples sits on one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope.functions.geo import grid_centre, grid_text

CELLS = 200
HOT_CELL = 0
GRID_X, GRID_Y, GRID_WIDTH = 2610000, 776000, 50


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _whole(value: Column) -> Column:
    return F.floor(value).cast("bigint")


def mro(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_discount", "l_tax")
    cell = F.when(F.col("o_custkey") % 3 == 0, F.lit(HOT_CELL)).otherwise(F.col("o_custkey") % CELLS)
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey).withColumn("objectid", cell.cast("bigint"))
    reach = F.when(F.col("objectid") % 10 == 0, 7 * (F.col("o_orderkey") % 3)).otherwise(F.lit(0))
    hour = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    return joined.select(
        "objectid",
        F.col("o_orderkey").cast("string").alias("mmeues1apid"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":00:00")).alias("time_stamp"),
        ((F.col("objectid") + F.col("l_linenumber") + reach) % CELLS).cast("bigint").alias("ncellobjectid"),
        (_whole(F.col("o_totalprice")) % 98).cast("int").alias("ltescrsrp"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(-999)).otherwise(F.col("o_orderkey") % 35).cast("int").alias("ltescrsrq"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit(-999)).otherwise(_whole(F.col("o_totalprice")) % 37)
        .cast("double").alias("ltescsinrul"),
        (_whole(F.col("l_extendedprice")) % 98).cast("int").alias("ltencrsrp"),
        (F.col("o_orderkey") % 3).cast("int").alias("ta"),
        (F.col("o_custkey") % 360).cast("int").alias("aoa"),
        (F.col("l_partkey") % 101 - 1).cast("int").alias("ltescpuschprbnum"),
        (F.col("l_suppkey") % 101 - 1).cast("int").alias("ltescpdschprbnum"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None)).otherwise(_whole(F.col("l_discount") * 1000) - 10)
        .cast("double").alias("ulqci1"),
        (_whole(F.col("l_tax") * 1000) - 10).cast("double").alias("dlqci1"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        hour.alias("hour"),
    )


def _grids(spark: SparkSession, sf: str) -> DataFrame:
    """Three floors per grid; one row per part."""
    at = F.floor(F.col("p_partkey") / 3).cast("bigint")
    return table(spark, sf, "part").select(
        "p_partkey", "p_size",
        (GRID_X + at % GRID_WIDTH).alias("google_gci"),
        (GRID_Y + F.floor(at / GRID_WIDTH).cast("bigint")).alias("google_gri"),
        ((F.col("p_partkey") % 3) * 5).cast("int").alias("grid_height"),
    )


def finger(spark: SparkSession, sf: str) -> DataFrame:
    grids = _grids(spark, sf).withColumn("objectid", (F.col("p_partkey") % CELLS).cast("bigint"))
    heard = F.when(F.col("objectid") % 10 == 0, F.lit(21)).otherwise(F.lit(7))
    centre = grid_centre("google_gci", "google_gri")
    return grids.withColumn("k", F.explode(F.sequence(F.lit(1), heard))).select(
        "objectid",
        grid_text("google_gci", "google_gri").alias("gridid"),
        centre["lon"].alias("longitude"), centre["lat"].alias("latitude"),
        (-(60 + F.col("p_size")) - F.col("p_partkey") % 4 / F.lit(10.0)).alias("rsrp"),
        ((F.col("objectid") + F.col("k")) % CELLS).cast("bigint").alias("n_objectid"),
        (-(60 + (F.col("p_size") * 7 + F.col("k") * 13) % 60) + F.col("k") % 3 / F.lit(10.0)).alias("n_rsrp"),
        F.col("grid_height").alias("height"),
    )


def finger_ground(spark, sf) -> DataFrame:
    return finger(spark, sf).where("height = 0")


def finger_upper(spark, sf) -> DataFrame:
    return finger(spark, sf).where("height != 0")


def finger_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Wide raw fingerprint: seven antenna slots, some empty, some not coded."""
    part = F.col("p_partkey")
    slots = []
    for k in range(7):
        enb = F.concat(((part + k) % 100).cast("string"), F.lit(f"_{k}"))
        antenna = F.when((part + k) % 9 == 0, F.lit(None)) \
            .when((part + k) % 11 == 0, F.concat(F.lit("a"), enb)).otherwise(enb)
        slots += [antenna.alias(f"antenna_{k}"),
                  (-(60 + (F.col("p_size") * 7 + k * 13) % 60)).cast("double").alias(f"rsrp_{k}")]
    return _grids(spark, sf).select("google_gci", "google_gri", "grid_height", *slots)


def res_cell(spark: SparkSession, sf: str) -> DataFrame:
    """Seven sectors per supplier, matching the antennas of the raw fingerprint."""
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("sector")).select(
        (F.col("s_suppkey") * 256 + F.col("sector")).alias("objectid"),
        (100 * (F.col("s_suppkey") % 3)).cast("int").alias("earfcn"),
        F.col("s_suppkey").alias("siteoid"),
    )


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """Cell sites of the sample cells, each in the middle of a grid."""
    cells = table(spark, sf, "customer").select((F.col("c_custkey") % CELLS).alias("objectid")).distinct()
    centre = grid_centre(GRID_X + F.col("objectid") % GRID_WIDTH,
                         GRID_Y + F.floor(F.col("objectid") / GRID_WIDTH).cast("bigint"))
    return cells.select("objectid", centre["lon"].alias("longitude"), centre["lat"].alias("latitude"))


def grid_building(spark: SparkSession, sf: str) -> DataFrame:
    return _grids(spark, sf).select(
        grid_text("google_gci", "google_gri").alias("gridid"),
        (F.floor(F.col("p_partkey") / 3) % 30).cast("int").alias("buildingid"),
    ).distinct()


def cells(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        key.alias("eci"),
        ((1150 + key % 50).cast("double") / 10).alias("longitude"),
        ((150 + F.col("s_nationkey")).cast("double") / 5).alias("latitude"),
        (key % 7).cast("int").alias("pci"),
        (100 * (F.col("s_nationkey") % 3)).cast("int").alias("earfcn"),
    )


def pci_list(spark: SparkSession, sf: str) -> DataFrame:
    return cells(spark, sf).select("pci", "earfcn").distinct()


def mro_wide(spark: SparkSession, sf: str) -> DataFrame:
    order, cust, price = F.col("o_orderkey"), F.col("o_custkey"), _whole(F.col("o_totalprice"))
    slots = []
    for i in range(1, 9):
        slots += [
            F.when((order + i) % 4 != 0, (price + i * 7) % 98).cast("int").alias(f"ltencrsrp_{i}"),
            (100 * ((cust + i) % 3)).cast("int").alias(f"ltencearfcn_{i}"),
            ((order + i) % 7).cast("int").alias(f"ltencpci_{i}"),
        ]
    return table(spark, sf, "orders").select(
        (cust % 100).alias("eci"),
        order.cast("string").alias("mmeues1apid"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        (price % 98).cast("int").alias("ltescrsrp"),
        (order % 35).cast("int").alias("ltescrsrq"),
        (price % 37).cast("double").alias("ltescsinrul"),
        (100 * (cust % 3)).cast("int").alias("ltescearfcn"),
        (order % 7).cast("int").alias("ltescpci"),
        (order % 50).cast("int").alias("ltesctadv"),
        (cust % 360).cast("int").alias("ltescaoa"),
        (price % 101).cast("int").alias("ltescpuschprbnum"),
        (cust % 101).cast("int").alias("ltescpdschprbnum"),
        (order % 90).cast("double").alias("ltescplrulqci1"),
        (cust % 90).cast("double").alias("ltescplrdlqci1"),
        *slots,
    )


def service_layers(spark: SparkSession, sf: str) -> dict[int, DataFrame]:
    return {h: finger(spark, sf).where(F.col("height") == h)
            .select("gridid", "longitude", "latitude", "objectid", "rsrp").distinct() for h in (0, 5, 10)}


def neighbour_layers(spark: SparkSession, sf: str) -> dict[int, DataFrame]:
    return {h: finger(spark, sf).where(F.col("height") == h)
            .select(F.col("gridid").alias("servicegridid"), F.col("n_objectid").alias("objectid"),
                    F.col("n_rsrp").alias("rsrp")) for h in (0, 5, 10)}


def _degrees(micro: Column) -> Column:
    return F.concat(F.floor(micro / 1000000).cast("string"), F.lit("."),
                    F.lpad((micro % 1000000).cast("string"), 6, "0"))


def mdt_lines(spark: SparkSession, sf: str, layout: int) -> DataFrame:
    """Drive-test text from events; some numbers are unreadable, some points far away."""
    event = F.col("event_id")
    lon = F.when(event % 13 == 0, F.lit(121000000)).otherwise(F.lit(117230100) + (event % 61) * 40)
    lat = F.lit(32884600) + (event % 37) * 38
    time = F.when(event % 19 == 0, F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rsrp = F.when(event % 17 == 0, F.lit("NULL")).otherwise((-(60 + event % 50)).cast("string"))
    user, cell = F.col("user_id").cast("string"), (event % CELLS).cast("string")
    middle = [F.lit("9"), F.lit("300")] if layout == 2 else []
    fields = [time, F.lit("1"), F.lit("2"), F.lit("3"), F.lit("imsi"), F.lit("imei"), user, cell,
              *middle, rsrp, F.lit("20"), _degrees(lon), F.lit("0"), _degrees(lat), F.lit("0")]
    return table(spark, sf, "events").where(F.col("event_id") % 2 == layout - 1) \
        .select(F.concat_ws(",", *fields).alias("value"))
