"""Functions on measurement codes, cell keys and report times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscope.functions.columns import col, dbl

# Report codes.
MISSING = -999
RSRP_OFFSET = 141
RSRQ_OFFSET = 20
SINR_OFFSET = 11
CELLS_PER_ENB = 256

# Upper edge of a signal difference -> matching weight.
DIFFERENCE_WEIGHTS = (
    (4, 10), (8, 9), (9, 8), (10, 7), (11, 6), (12, 5), (13, 4), (14, 3),
)

SALT_BUCKETS = 20


def floor_to(value, digits) -> Column:
    """``value`` cut down to ``digits`` decimals."""
    scale = F.pow(F.lit(10.0), col(digits))
    return F.floor(dbl(value) * scale) / scale


def log10(value) -> Column:
    """Base-10 logarithm; null where it is undefined."""
    return F.log10(dbl(value))


def millis_between(start, end) -> Column:
    return F.unix_millis(col(end).cast("timestamp")) - F.unix_millis(col(start).cast("timestamp"))


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", col(seconds), col(ts))


def antenna_to_objectid(antenna) -> Column:
    """``"<enb>_<cell>"`` to the cell id; other text gives 0, null stays null."""
    text = col(antenna)
    parts = F.split(text, "_")
    cell_id = (
        parts[0].try_cast("int") * CELLS_PER_ENB
        + F.get(parts, F.lit(1)).try_cast("int")
    )
    coded = text.contains("_") & ~text.contains("a")
    return F.when(text.isNull(), F.lit(None)).when(coded, cell_id).otherwise(F.lit(0)).cast("int")


def join_row_column_id(row_id, col_id) -> Column:
    """Row and column ids glued to one long key."""
    return F.concat(col(row_id).cast("string"), col(col_id).cast("string")).try_cast("bigint")


def difference_weight(difference) -> Column:
    value = dbl(difference)
    ladder = reduce(
        lambda acc, step: acc.when(value <= step[0], F.lit(step[1])),
        DIFFERENCE_WEIGHTS[1:],
        F.when(value <= DIFFERENCE_WEIGHTS[0][0], F.lit(DIFFERENCE_WEIGHTS[0][1])),
    )
    return ladder.otherwise(F.lit(0))


def salt_key(key, *spread, buckets: int = SALT_BUCKETS) -> Column:
    """Prefix ``key`` with a bucket drawn from ``spread``; a rerun gives the same bucket, null stays null."""
    bucket = F.pmod(F.xxhash64(*[col(c) for c in spread]), F.lit(buckets))
    return F.concat(bucket.cast("string"), F.lit("_"), col(key).cast("string"))


def unsalt_key(salted) -> Column:
    """What follows the first separator, so that keys may hold it themselves."""
    text = col(salted)
    return F.substring(text, F.instr(text, "_") + 1, F.length(text))


def salted_sum(df: DataFrame, key: str, value: str, *spread: str,
               buckets: int = SALT_BUCKETS) -> DataFrame:
    """Sum and row count by ``key`` in two steps, so that a hot key is summed by many tasks."""
    salt = F.pmod(F.xxhash64(*[col(c) for c in spread]), F.lit(buckets)).alias("_salt")
    by_salt = (
        df.groupBy(F.col(key), salt)
        .agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    )
    return (
        by_salt.groupBy(key)
        .agg(F.sum("_sum").alias("total"), F.sum("_rows").alias("rows"))
    )


def rsrp_dbm(code) -> Column:
    return col(code) - RSRP_OFFSET


def rsrq_db(code) -> Column:
    return F.when(col(code) != MISSING, dbl(code) / 2 - RSRQ_OFFSET)


def sinr_db(code) -> Column:
    return F.when(col(code) != MISSING, col(code) - SINR_OFFSET)


def hour_day(hour_text) -> Column:
    """Day part of a ``yyyyMMddHH`` text."""
    return F.substring(col(hour_text), 1, 8)


def hour_hour(hour_text) -> Column:
    """Hour part of a ``yyyyMMddHH`` text."""
    return F.substring(col(hour_text), 9, 2)
