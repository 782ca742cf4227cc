import datetime

import pytest
from pyspark.sql import functions as F

from gridscope.functions import codes


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("antenna, expected", [
    ("526401_130", 134758786), ("526401_129", 134758785), ("a12_3", 0), ("123", 0), ("x_1", None),
])
def test_antenna_to_objectid(spark, antenna, expected):
    assert value(spark, codes.antenna_to_objectid(F.lit(antenna))) == expected


def test_missing_antenna_stays_null(spark):
    assert value(spark, codes.antenna_to_objectid(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("difference, weight", [
    (-3, 10), (4, 10), (4.1, 9), (8, 9), (8.5, 8), (9.5, 7), (10.5, 6), (12, 5), (12.5, 4), (14, 3), (14.1, 0),
])
def test_difference_weight(spark, difference, weight):
    assert value(spark, codes.difference_weight(F.lit(difference))) == weight


def test_signal_codes(spark):
    assert value(spark, codes.rsrp_dbm(F.lit(31))) == -110
    assert value(spark, codes.rsrq_db(F.lit(21))) == -9.5
    assert value(spark, codes.rsrq_db(F.lit(-999))) is None
    assert value(spark, codes.sinr_db(F.lit(11.0))) == 0.0
    assert value(spark, codes.sinr_db(F.lit(-999.0))) is None


def test_numbers(spark):
    assert value(spark, codes.floor_to(F.lit(3.789), 2)) == 3.78
    assert value(spark, codes.floor_to(F.lit(-3.781), 2)) == -3.79
    assert value(spark, codes.log10(F.lit(1000.0))) == pytest.approx(3)
    assert value(spark, codes.log10(F.lit(0.0))) is None
    assert value(spark, codes.join_row_column_id(F.lit("12"), F.lit("034"))) == 12034


def test_times(spark):
    a, b = (F.lit(t).cast("timestamp") for t in ("2017-12-26 00:00:00.250", "2017-12-26 00:01:00"))
    assert value(spark, codes.millis_between(a, b)) == 59750
    later = value(spark, codes.add_seconds(b, F.lit(3_000_000)))
    assert later == datetime.datetime(2018, 1, 29, 17, 21)
    assert value(spark, codes.hour_day(F.lit("2017122607"))) == "20171226"
    assert value(spark, codes.hour_hour(F.lit("2017122607"))) == "07"


def test_salted_sum_equals_plain_sum(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"), "id")
    salted = codes.salted_sum(rows, "k", "id", "id")
    plain = rows.groupBy("k").agg(F.sum("id").alias("total"), F.count("*").alias("rows"))
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_salt_spreads_and_comes_off(spark):
    rows = spark.range(500).select(codes.salt_key(F.lit(9), "id").alias("s"))
    assert rows.distinct().count() == codes.SALT_BUCKETS
    assert [r.k for r in rows.select(codes.unsalt_key("s").alias("k")).distinct().collect()] == ["9"]


def test_salted_sum_with_text_and_null_keys(table):
    rows = table("k string, v bigint, id bigint", ("1_7", 1, 1), ("2_7", 2, 2), (None, 4, 3), ("7", 8, 4), ("1_7", 16, 5))
    got = {r.k: (r.total, r.rows) for r in codes.salted_sum(rows, "k", "v", "id").collect()}
    assert got == {"1_7": (17, 2), "2_7": (2, 1), None: (4, 1), "7": (8, 1)}
    back = rows.select("k", codes.salt_key("k", "id").alias("s")).select("k", codes.unsalt_key("s").alias("b")).collect()
    assert all(r.k == r.b for r in back)
