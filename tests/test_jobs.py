"""The jobs that build tables from folders."""

import pytest
from pyspark.sql import functions as F

from gridscope.plans import drive_tests, hourly, locations
from gridscope.plans import features as feature_job
from gridscope.plans import fingerprint as fingerprint_job


def test_feature_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    names = [f"v{i}" for i in range(5)]
    (tmp_path / "in" / "a.txt").write_text(f"uid 7|other {' '.join(names)}\n")
    values, wide, csv = (str(tmp_path / n) for n in ("values", "wide", "csv"))
    for _ in range(2):  # a second run replaces the first
        feature_job.build(spark, str(tmp_path / "in"), values, wide, slots=2, csv_path=csv)
    long = spark.read.parquet(values).where("feature = 'other'").orderBy("position").collect()
    assert [(r.uid, r.position, r.value) for r in long] == [("7", i + 1, v) for i, v in enumerate(names)]
    assert spark.read.parquet(wide).count() == 1 and spark.read.option("header", True).csv(csv).first().uid == "7"


def test_layers_by_floor(spark, tmp_path):
    for height in (0, 5):
        spark.sql("select '1_2' gridid, 117.0D longitude, 32.0D latitude, 9L objectid, -60D rsrp") \
            .write.parquet(str(tmp_path / f"service_{height}"))
        spark.sql(f"select '1_2' servicegridid, {height + 1}L objectid, -70D rsrp") \
            .write.parquet(str(tmp_path / f"neighbour_{height}"))
    ground, upper = fingerprint_job.build_layers(
        spark, str(tmp_path / "service_{height}"), str(tmp_path / "neighbour_{height}"),
        str(tmp_path / "ground"), str(tmp_path / "upper"), heights=(0, 5))
    assert [(r.objectid, r.n_objectid, r.height) for r in ground.collect()] == [(9, 1, 0)]
    assert [(r.objectid, r.n_objectid, r.height) for r in upper.collect()] == [(9, 6, 5)]


def test_layers_by_folder_are_one_scan_a_side(spark, tmp_path):
    from gridscope.operators import fingerprint

    for height in (0, 5, 8, 10):
        spark.sql("select '1_2' gridid, 117.0D longitude, 32.0D latitude, 9L objectid, -60D rsrp") \
            .write.parquet(str(tmp_path / "service" / f"height={height}"))
        spark.sql(f"select '1_2' servicegridid, {height + 1}L objectid, -70D rsrp") \
            .write.parquet(str(tmp_path / "neighbour" / f"height={height}"))
    ground, upper = fingerprint_job.build_layers(
        spark, str(tmp_path / "service"), str(tmp_path / "neighbour"), str(tmp_path / "ground"), str(tmp_path / "upper"), heights=(0, 5, 10))
    assert [(r.objectid, r.n_objectid, r.height) for r in ground.collect()] == [(9, 1, 0)]
    assert sorted((r.objectid, r.n_objectid, r.height) for r in upper.collect()) == [(9, 6, 5), (9, 11, 10)]
    for layer in fingerprint.split_layers(*(spark.read.parquet(str(tmp_path / side)) for side in ("service", "neighbour"))):
        plan = layer._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and plan.count("PartitionFilters: []") == 0


def test_drive_test_loads_add_up_in_any_order(spark, sf, tmp_path):
    from gridscope.operators import mdt
    from gridscope.sources.mdt_text import read_mdt
    from gridscope_checks import domain as d

    ground = d.finger_ground(spark, sf)
    for layout in (1, 2):
        lines = d.mdt_lines(spark, sf, layout)
        for part in (0, 1):
            lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part).write.text(str(tmp_path / f"l{layout}" / f"part={part}"))
    whole = mdt.mdt_grid_stats(mdt.mdt_locate(read_mdt(spark, str(tmp_path / "l1"), str(tmp_path / "l2")), ground), ground)
    want = sorted(map(tuple, whole.collect()))
    assert any(row[4] for row in want)
    for order in ((0, 1), (1, 0, 1)):
        points, sums = str(tmp_path / f"points{order}"), str(tmp_path / f"sums{order}")
        for part in order:
            drive_tests.load(spark, *[str(tmp_path / f"l{n}" / f"part={part}") for n in (1, 2)], ground, points, sums, f"f{part}")
        got = sorted(map(tuple, drive_tests.grid_stats(spark, sums, ground).collect()))
        assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_locations_by_day(spark, tmp_path):
    logs, result = str(tmp_path / "logs"), str(tmp_path / "result")
    rows = [("20240101", "a", "http://a/?lat=30&lng=120", "x"), ("20240102", "a", "http://a/nothing", "x")]
    spark.createDataFrame(rows, "day string, host string, uri string, content string").write.partitionBy("day").parquet(logs)
    locations.extract(spark, logs, result)
    locations.extract(spark, logs, result, day="20240102")
    got = {r.uri: (r.success, r.latitude, r.longitude) for r in spark.read.parquet(result).collect()}
    assert got == {"http://a/?lat=30&lng=120": (True, "30", "120"), "http://a/nothing": (False, None, None)}


def test_hour_argument_is_checked(spark):
    with pytest.raises(ValueError):
        hourly.locate_hours(spark, "none", None, None, None, "a", "b", at="2024-01-01 05")
