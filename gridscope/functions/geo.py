"""Coordinate systems, distances and 5 m grids as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridscope.functions.columns import col, dbl

# Ellipsoid and sphere constants, mercator half extent, grid step.
GCJ_AXIS = 6378245.0
GCJ_ECCENTRICITY = 0.00669342162296594323
CHINA_LON = (72.004, 137.8347)
CHINA_LAT = (0.8293, 55.8271)
MERCATOR_HALF = 20037508.34
EARTH_RADIUS_M = 6378137.0
HAVERSINE_RADIUS_KM = 6371.393
GRID_STEP = 5

# Sine terms (amplitude, frequency) of the GCJ-02 offset.
GCJ_COMMON_X = ((20.0, 6.0), (20.0, 2.0))
GCJ_LAT_Y = ((20.0, 1.0), (40.0, 1 / 3.0), (160.0, 1 / 12.0), (320.0, 1 / 30.0))
GCJ_LON_X = ((20.0, 1.0), (40.0, 1 / 3.0), (150.0, 1 / 12.0), (300.0, 1 / 30.0))

# BD-09 shift.
BD_SHIFT_LON = 0.0065
BD_SHIFT_LAT = 0.006
BD_RADIAL = 0.00002
BD_ANGULAR = 0.000003

# Timing advance to metres.
TA_STEP = 16
TA_FLOOR = 6
METRES_PER_TS = 3e5 / 30720 / 2
RTTD_MARGIN = 4
RTTD_METRES = 78.125

_RAD = math.pi / 180.0


def _waves(variable: Column, terms) -> Column:
    total = sum(F.lit(a) * F.sin(variable * (f * math.pi)) for a, f in terms)
    return total * 2.0 / 3.0


def wgs84_to_gcj02(lat, lon) -> Column:
    """Struct (lat, lon); points outside the China box are returned as they are."""
    lat, lon = dbl(lat), dbl(lon)
    x, y = lon - 105.0, lat - 35.0
    root = F.sqrt(F.abs(x))
    d_lat = (-100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * root
             + _waves(x, GCJ_COMMON_X) + _waves(y, GCJ_LAT_Y))
    d_lon = (300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * root
             + _waves(x, GCJ_COMMON_X) + _waves(x, GCJ_LON_X))
    squeeze = 1 - GCJ_ECCENTRICITY * F.pow(F.sin(lat * _RAD), F.lit(2.0))
    meridian = GCJ_AXIS * (1 - GCJ_ECCENTRICITY) / (squeeze * F.sqrt(squeeze)) * _RAD
    parallel = GCJ_AXIS / F.sqrt(squeeze) * F.cos(lat * _RAD) * _RAD
    inside = lon.between(*CHINA_LON) & lat.between(*CHINA_LAT)
    return F.struct(
        F.when(inside, lat + d_lat / meridian).otherwise(lat).alias("lat"),
        F.when(inside, lon + d_lon / parallel).otherwise(lon).alias("lon"),
    )


def lonlat_to_mercator(lon, lat) -> Column:
    """Struct (x, y) in web-mercator metres."""
    lon, lat = dbl(lon), dbl(lat)
    y_degrees = F.log(F.tan((lat + 90.0) * (math.pi / 360.0))) / _RAD
    return F.struct(
        (lon * MERCATOR_HALF / 180.0).alias("x"),
        (y_degrees * MERCATOR_HALF / 180.0).alias("y"),
    )


def mercator_to_lonlat(x, y) -> Column:
    """Struct (lon, lat) in degrees."""
    y_degrees = dbl(y) / MERCATOR_HALF * 180.0
    return F.struct(
        (dbl(x) / MERCATOR_HALF * 180.0).alias("lon"),
        ((2.0 * F.atan(F.exp(y_degrees * _RAD)) - math.pi / 2) / _RAD).alias("lat"),
    )


def planar_distance(x1, y1, x2, y2) -> Column:
    return F.sqrt(F.pow(dbl(x1) - dbl(x2), F.lit(2.0)) + F.pow(dbl(y1) - dbl(y2), F.lit(2.0)))


def mercator_distance(lat1, lon1, lat2, lon2) -> Column:
    """Distance of two points on the mercator plane (grows with latitude)."""
    p, q = lonlat_to_mercator(lon1, lat1), lonlat_to_mercator(lon2, lat2)
    return planar_distance(p["x"], p["y"], q["x"], q["y"])


def city_grid_index(lat, lon, max_lat, min_lon, step, column_count) -> Column:
    """1-based index of a point in a grid that starts at the north-west corner."""
    point, corner = lonlat_to_mercator(lon, lat), lonlat_to_mercator(min_lon, max_lat)
    across = ((point["x"] - corner["x"]).cast("int") / col(step)).cast("bigint")
    down = ((corner["y"] - point["y"]).cast("int") / col(step)).cast("bigint")
    return down * col(column_count) + across + 1


def _bd_frequency(published: bool) -> float:
    return 3000.0 * math.pi / 180.0 if published else math.pi


def gcj02_to_bd09(lon, lat, published: bool = False) -> Column:
    """Struct (lon, lat). ``published`` uses the usual 3000*pi/180 in place of pi."""
    lon, lat = dbl(lon), dbl(lat)
    w = _bd_frequency(published)
    radius = F.sqrt(lon * lon + lat * lat) + BD_RADIAL * F.sin(lat * w)
    angle = F.atan2(lat, lon) + BD_ANGULAR * F.cos(lon * w)
    return F.struct(
        (radius * F.cos(angle) + BD_SHIFT_LON).alias("lon"),
        (radius * F.sin(angle) + BD_SHIFT_LAT).alias("lat"),
    )


def bd09_to_gcj02(lat, lon, published: bool = False) -> Column:
    """Struct (lat, lon)."""
    x, y = dbl(lon) - BD_SHIFT_LON, dbl(lat) - BD_SHIFT_LAT
    w = _bd_frequency(published)
    radius = F.sqrt(x * x + y * y) - BD_RADIAL * F.sin(y * w)
    angle = F.atan2(y, x) - BD_ANGULAR * F.cos(x * w)
    return F.struct(
        (radius * F.sin(angle)).alias("lat"),
        (radius * F.cos(angle)).alias("lon"),
    )


def haversine_metres(lon1, lon2, lat1, lat2) -> Column:
    """Great-circle distance rounded to whole metres."""
    phi1, phi2 = dbl(lat1) * _RAD, dbl(lat2) * _RAD
    half_phi, half_lambda = (phi1 - phi2) / 2, (dbl(lon1) - dbl(lon2)) * _RAD / 2
    chord = (F.pow(F.sin(half_phi), F.lit(2.0))
             + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_lambda), F.lit(2.0)))
    return F.round(2 * F.asin(F.sqrt(chord)) * HAVERSINE_RADIUS_KM * 1000, 0)


def grid_column(lon) -> Column:
    """5 m column number of a longitude."""
    return F.floor(dbl(lon) * _RAD * EARTH_RADIUS_M / GRID_STEP).cast("bigint")


def grid_row(lat) -> Column:
    """5 m row number of a latitude."""
    s = F.sin(dbl(lat) * _RAD)
    return F.floor(EARTH_RADIUS_M / 2.0 * F.log((1.0 + s) / (1.0 - s)) / GRID_STEP).cast("bigint")


def grid_text(column, row) -> Column:
    return F.concat_ws("_", col(column).cast("string"), col(row).cast("string"))


def gridid_of(lon, lat) -> Column:
    return F.when(dbl(lon).isNotNull() & dbl(lat).isNotNull(),
                  grid_text(grid_column(lon), grid_row(lat)))


def grid_centre(gci, gri) -> Column:
    """Struct (lon, lat) of a grid number pair."""
    return mercator_to_lonlat(dbl(gci) * GRID_STEP, dbl(gri) * GRID_STEP)


def regrid(gci, gri) -> Column:
    """Grid id found again from the grid's own position, cut towards zero."""
    centre = grid_centre(gci, gri)
    point = lonlat_to_mercator(centre["lon"], centre["lat"])
    return grid_text((point["x"] / GRID_STEP).cast("bigint"), (point["y"] / GRID_STEP).cast("bigint"))


def ta_aoa_point(lon, lat, ta, aoa, jitter=0) -> Column:
    """Struct (lon, lat) of a report seen from its cell site by timing advance and angle."""
    site = lonlat_to_mercator(lon, lat)
    reach = F.greatest(dbl(ta) * TA_STEP + dbl(jitter), F.lit(float(TA_FLOOR))) * METRES_PER_TS
    angle = (dbl(aoa) + 90.0) * _RAD
    return mercator_to_lonlat(site["x"] + reach * F.cos(angle), site["y"] + reach * F.sin(angle))


def point_in_cell(lat, lon, site_lat, site_lon, rttd) -> Column:
    """Whether a GCJ-02 point lies within the timing reach of a WGS-84 site."""
    site = wgs84_to_gcj02(site_lat, site_lon)
    return mercator_distance(lat, lon, site["lat"], site["lon"]) <= (dbl(rttd) + RTTD_MARGIN) * RTTD_METRES
