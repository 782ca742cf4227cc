import pytest
from pyspark.sql import functions as F

from gridscope.functions import geo


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_grid_centre_golden(spark):
    centre = value(spark, geo.grid_centre(F.lit(2610882), F.lit(776956)))
    assert centre.lon == pytest.approx(117.2697602976, abs=1e-8)
    assert centre.lat == pytest.approx(32.92067784258419, abs=1e-8)


def test_haversine_golden(spark):
    assert value(spark, geo.haversine_metres(F.lit(120.0), F.lit(121.0), F.lit(30.0), F.lit(31.0))) == 146785


def test_mercator_round_trip(spark):
    points = spark.range(200).select((F.col("id") * 1.7 - 170).alias("lon"), (F.col("id") * 0.8 - 80).alias("lat"))
    m = geo.lonlat_to_mercator("lon", "lat")
    back = geo.mercator_to_lonlat(m["x"], m["y"])
    worst = points.select(F.max(F.greatest(F.abs(back["lon"] - F.col("lon")), F.abs(back["lat"] - F.col("lat")))))
    assert worst.first()[0] < 1e-9


def test_outside_china_is_unchanged(spark):
    moved = value(spark, geo.wgs84_to_gcj02(F.lit(40.0), F.lit(-74.0)))
    assert (moved.lat, moved.lon) == (40.0, -74.0)


def test_gcj_offset_in_china_is_some_hundred_metres(spark):
    moved = value(spark, geo.wgs84_to_gcj02(F.lit(30.25), F.lit(120.17)))
    shift = value(spark, geo.haversine_metres(F.lit(moved.lon), F.lit(120.17), F.lit(moved.lat), F.lit(30.25)))
    assert 300 < shift < 700


@pytest.mark.parametrize("published", [False, True])
def test_bd09_round_trip(spark, published):
    bd = value(spark, geo.gcj02_to_bd09(F.lit(120.17), F.lit(30.25), published))
    back = value(spark, geo.bd09_to_gcj02(F.lit(bd.lat), F.lit(bd.lon), published))
    assert back.lon == pytest.approx(120.17, abs=1e-5) and back.lat == pytest.approx(30.25, abs=1e-5)


def test_grid_of_a_grid_centre_is_the_grid(spark):
    centre = geo.grid_centre(F.lit(2610882.5), F.lit(776956.5))
    assert value(spark, geo.gridid_of(centre["lon"], centre["lat"])) == "2610882_776956"
    assert value(spark, geo.gridid_of(F.lit(None).cast("double"), F.lit(30.0))) is None


def test_short_timing_advance_has_a_floor(spark):
    near = value(spark, geo.ta_aoa_point(F.lit(117.0), F.lit(32.0), F.lit(0), F.lit(0)))
    m, site = (geo.lonlat_to_mercator(*map(F.lit, p)) for p in ((near.lon, near.lat), (117.0, 32.0)))
    assert value(spark, geo.planar_distance(m["x"], m["y"], site["x"], site["y"])) == pytest.approx(29.296875, abs=1e-4)


def test_point_in_cell(spark):
    site = value(spark, geo.wgs84_to_gcj02(F.lit(30.25), F.lit(120.17)))
    inside = geo.point_in_cell(F.lit(site.lat), F.lit(site.lon + 0.001), F.lit(30.25), F.lit(120.17), F.lit(0))
    outside = geo.point_in_cell(F.lit(site.lat), F.lit(site.lon + 0.01), F.lit(30.25), F.lit(120.17), F.lit(0))
    assert value(spark, inside) and not value(spark, outside)


def test_city_grid_index_counts_from_the_corner(spark):
    corner = geo.city_grid_index(F.lit(31.0), F.lit(120.0), F.lit(31.0), F.lit(120.0), 5, 1000)
    assert value(spark, corner) == 1
