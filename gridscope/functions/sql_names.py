"""The functions that SQL text uses by name, as temporary SQL functions.

Their bodies are plain SQL, which the optimizer puts in place of the call.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridscope.functions.codes import CELLS_PER_ENB
from gridscope.functions.geo import EARTH_RADIUS_M, GRID_STEP, HAVERSINE_RADIUS_KM

FUNCTIONS = {
    "transformObjectId(antenna STRING) RETURNS INT": f"""
        CASE WHEN antenna IS NULL THEN NULL
             WHEN contains(antenna, '_') AND NOT contains(antenna, 'a')
             THEN try_cast(split_part(antenna, '_', 1) AS INT) * {CELLS_PER_ENB}
                  + try_cast(split_part(antenna, '_', 2) AS INT)
             ELSE 0 END""",
    "st_distance(lon1 DOUBLE, lon2 DOUBLE, lat1 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE": f"""
        round(2 * asin(sqrt(
            power(sin(radians(lat1 - lat2) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon1 - lon2) / 2), 2)
        )) * {HAVERSINE_RADIUS_KM}D * 1000, 0)""",
    "getwebmercatorfromwgs(degrees DOUBLE, axis STRING) RETURNS BIGINT": f"""
        CASE axis
            WHEN 'lon' THEN cast(floor(radians(degrees) * {EARTH_RADIUS_M}D / {GRID_STEP}) AS BIGINT)
            WHEN 'lat' THEN cast(floor({EARTH_RADIUS_M}D / 2 * ln(
                (1 + sin(radians(degrees))) / (1 - sin(radians(degrees)))) / {GRID_STEP}) AS BIGINT)
            ELSE 0 END""",
}


def register(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
