"""Drive-test text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field positions of the two file layouts.
LAYOUTS = {
    1: {"time_stamp": 0, "mmeues1apid": 6, "objectid": 7, "ltescrsrp": 8, "longitude": 10, "latitude": 12},
    2: {"time_stamp": 0, "mmeues1apid": 6, "objectid": 7, "ltescrsrp": 10, "longitude": 12, "latitude": 14},
}
NUMBERS = {"objectid": "bigint", "ltescrsrp": "int", "longitude": "double", "latitude": "double"}

# Area of interest, edges outside.
LONGITUDES = (115.0, 120.0)
LATITUDES = (30.0, 35.0)


def _field(fields: Column, name: str, at: int) -> Column:
    text = F.get(fields, F.lit(at))
    if name in NUMBERS:
        kind = NUMBERS[name]
        return F.coalesce(text.try_cast(kind), F.lit(0).cast(kind)).alias(name)
    return F.when(text != "", text).alias(name)


def in_area(df: DataFrame, longitudes=LONGITUDES, latitudes=LATITUDES) -> DataFrame:
    """P1; None leaves a side open."""
    if longitudes is None or latitudes is None:
        longitudes, latitudes = longitudes or (float("-inf"), float("inf")), latitudes or (float("-inf"), float("inf"))
    lon, lat = F.col("longitude"), F.col("latitude")
    return df.where((lon > longitudes[0]) & (lon < longitudes[1])
                    & (lat > latitudes[0]) & (lat < latitudes[1]))


def parse_mdt(lines: DataFrame, layout: int, longitudes=LONGITUDES, latitudes=LATITUDES) -> DataFrame:
    """S3: text lines (column ``value``) to points; empty text is null, a bad number is 0.

    With None for both sides of the area all points are kept.
    """
    fields = F.split("value", ",")
    points = lines.select(*[_field(fields, name, at) for name, at in LAYOUTS[layout].items()])
    return in_area(points, longitudes, latitudes).withColumn("height", F.lit(0))


def read_mdt(spark: SparkSession, layout_1: str, layout_2: str, **area) -> DataFrame:
    """Points of both layouts."""
    return parse_mdt(spark.read.text(layout_1), 1, **area).unionByName(
        parse_mdt(spark.read.text(layout_2), 2, **area))
