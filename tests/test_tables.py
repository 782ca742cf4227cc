"""Partition writes, reruns, compaction, exports, JDBC options and whole jobs."""

import glob

import pytest
from pyspark.sql import functions as F

from gridscope_checks import domain as d
from gridscope_checks.queries_tables import hourly
from gridscope import schemas
from gridscope.operators import neighbours
from gridscope.plans import daily, fingerprint, hourly as hourly_plan
from gridscope.sources import jdbc, tables


@pytest.fixture
def folder(spark):
    return lambda name: tables.scratch_path(spark, name)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def rows(table, day, hour, *values):
    return table("v int, day string, hour string", *[(v, day, hour) for v in values])


def test_rerun_of_an_hour_changes_nothing_else(table, spark, folder):
    path = folder("t")
    tables.overwrite_partitions(rows(table, "20170101", "01", 1, 2).unionByName(rows(table, "20170101", "02", 3)), path)
    for _ in range(2):
        tables.overwrite_partitions(rows(table, "20170101", "02", 4, 5), path)
    read = tables.read_partition(spark, path)
    assert dict(read.dtypes)["hour"] == "string"
    assert sorted(tuple(r) for r in read.collect()) == [
        (1, "20170101", "01"), (2, "20170101", "01"), (4, "20170101", "02"), (5, "20170101", "02")]


def test_named_partition_can_become_empty(table, spark, folder):
    path = folder("t")
    first = rows(table, "20170101", "01", 1).unionByName(rows(table, "20170101", "02", 3))
    tables.overwrite_partitions(first, path)
    tables.overwrite_partition(first.where("false"), path, day="20170101", hour="02")
    assert [r.v for r in tables.read_partition(spark, path, schema="v int").collect()] == [1]


def test_partition_filter_reaches_the_scan(table, spark, folder):
    path = folder("t")
    tables.overwrite_partitions(rows(table, "20170101", "01", 1).unionByName(rows(table, "20170102", "01", 2)), path)
    plan = tables.read_partition(spark, path, "20170102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_existing_table_is_not_replaced_by_accident(table, folder):
    path = folder("t")
    tables.write_table(rows(table, "d", "h", 1), path)
    with pytest.raises(Exception, match="exist"):
        tables.write_table(rows(table, "d", "h", 1), path)


def test_compaction_leaves_few_files_and_all_rows(spark, folder):
    source, path = folder("loose"), folder("compact")
    loose = spark.range(1000).select(F.col("id").alias("v"), F.lit("d").alias("day"),
                                     (F.col("id") % 2).cast("string").alias("hour")).repartition(8)
    tables.write_table(loose, source, ("day", "hour"))
    tables.compact(tables.read_partition(spark, source), path)
    assert len(glob.glob(f"{path}/day=d/hour=0/*.parquet")) == 1
    assert same(tables.read_partition(spark, path), tables.read_partition(spark, source))


def test_only_partitions_of_small_files_are_written_again(spark, folder):
    path = folder("mixed")
    loose = spark.range(900).select(F.col("id").alias("v"), F.lit("2024 05").alias("day"),
                                    F.format_string("%02d", F.col("id") % 3).alias("hour"))
    tables.write_table(loose.where("hour <> '01'").repartition(6), path, ("day", "hour"))
    tables.write_table(loose.where("hour = '01'").coalesce(1), path, ("day", "hour"), mode="append")
    tables.write_table(spark.sql("select 5L v, '2024 05' day, cast(null as string) hour").union(
        spark.sql("select 6L v, '2024 05' day, cast(null as string) hour")).repartition(2, "v"), path, ("day", "hour"), mode="append")
    kept = glob.glob(f"{path}/day=*/hour=01/*.parquet")
    before = sorted(map(tuple, tables.read_partition(spark, path).collect()), key=str)
    written = tables.compact_small_files(spark, path)
    assert {(r["day"], r["hour"]) for r in written} - {("2024 05", None)} == {("2024 05", "00"), ("2024 05", "02")}
    assert glob.glob(f"{path}/day=*/hour=01/*.parquet") == kept
    assert all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in glob.glob(f"{path}/day=*/hour=*"))
    assert sorted(map(tuple, tables.read_partition(spark, path).collect()), key=str) == before
    assert tables.compact_small_files(spark, path) == []


def test_redistribution_keeps_rows(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    assert same(tables.by_columns(df, "k"), df)


def test_export_with_limit_takes_the_first_rows(table, spark, folder):
    path = folder("csv")
    tables.export_csv(rows(table, "d", "h", 3, 1, 2), path, limit=2, order_by=["v"], single_file=True)
    assert len(glob.glob(f"{path}/*.csv")) == 1
    assert [r.v for r in spark.read.option("header", True).csv(path).collect()] == ["1", "2"]


def test_guard(spark):
    assert tables.has_rows(spark.range(3)) and not tables.has_rows(spark.range(0))


def test_drop_partition_rejects_other_text(spark):
    with pytest.raises(ValueError):
        tables.drop_partition(spark, "t", "2017'; --")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    assert tables.shared_dir(spark) == (named.rstrip("/") if named else f"{warehouse}/_scratch")


def test_jdbc_options():
    scan = jdbc.read_options("jdbc:x", "cells", "objectid", 0, 1000, 8, user="u")
    assert scan == {"url": "jdbc:x", "dbtable": "cells", "user": "u", "partitionColumn": "objectid",
                    "lowerBound": "0", "upperBound": "1000", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "cells", "objectid")
    assert jdbc.write_options("jdbc:x", "t", connections=4) == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "500", "numPartitions": "4"}


def test_jdbc_row_shapes(spark):
    loss = spark.sql("select 'g' gridid, 1 ta, 1L udtotal, 2L uptotal, 3L dltotal, 4 uplost, 5 dllost, 6L pusum, 7L pdsum")
    assert jdbc.loss_rows(loss).columns == list(jdbc.LOSS_TABLE)
    assert tuple(jdbc.loss_rows(loss).first()) == ("g", 1, 2, 4, 3, 5, 6, 7)
    floors = spark.sql("select 3 buildingid, 5 height, -80.0D rsrp")
    assert tuple(jdbc.floor_rows(floors).first()) == (3, 5, -80.0)
    day = jdbc.kpi_rows(spark.sql("select 'g' gridid, '20171226' day"), F.col("day")).first().reporttime
    assert str(day) == "2017-12-26"


def test_hourly_and_daily_jobs(spark, sf, folder):
    mro_path, floor, result = folder("mro"), folder("floor"), folder("result")
    tables.write_table(hourly(spark, sf), mro_path, ("day", "hour"))
    inputs = (d.finger_ground(spark, sf), d.finger_upper(spark, sf), d.sites(spark, sf))
    assert not hourly_plan.locate_hours(spark, mro_path, *inputs, floor, result, day="20300101")
    assert hourly_plan.locate_hours(spark, mro_path, *inputs, floor, result)
    whole = tables.cut_lineage(tables.read_partition(spark, result, schema=hourly_plan.PLACED))
    day, hour = whole.select("day", "hour").first()
    # A single hour again: the same table comes out.
    assert hourly_plan.locate_hours(spark, mro_path, *inputs, floor, result, day=day, hour=hour)
    assert same(whole, tables.read_partition(spark, result, schema=hourly_plan.PLACED))
    # An hour whose input no longer matches anything leaves no old rows, done alone or with the others.
    for chosen in ({"day": day, "hour": hour}, {}):
        other, floors, kept = folder("other"), folder("other-floor"), folder("other-result")
        tables.write_table(hourly(spark, sf), other, ("day", "hour"))
        hourly_plan.locate_hours(spark, other, *inputs, floors, kept)
        lost = tables.cut_lineage(tables.read_partition(spark, other, day, hour, schema=schemas.MRO)
                                  .withColumn("objectid", F.lit(-1).cast("bigint")))
        tables.overwrite_partition(lost, other, day=day, hour=hour)
        assert hourly_plan.locate_hours(spark, other, *inputs, floors, kept, **chosen)
        assert tables.read_partition(spark, floors, day, hour, schema=hourly_plan.PLACED).isEmpty()
        assert tables.read_partition(spark, kept, day, hour, schema=hourly_plan.PLACED).isEmpty()

    csv = folder("csv")
    made = daily.report_day(spark, result, mro_path, inputs[0], folder("reports"), day, d.grid_building(spark, sf), csv)
    delivered = spark.read.option("header", True).csv(f"{csv}/grid_result/{day}")
    assert delivered.count() == made["grid_result"].count() and delivered.columns == made["grid_result"].drop("day").columns
    samples = whole.where(F.col("day") == day)
    assert same(made["samples"].select(*samples.columns), samples)
    assert made["grid_kpi"].agg(F.sum("mrpointnum")).first()[0] == samples.count()
    bins = F.col("rsrp_140_110_count") + F.col("rsrp_110_100_count") + F.col("rsrp_100_90_count") \
        + F.col("rsrp_90_80_count") + F.col("rsrp_80_count")
    assert made["grid_kpi"].where(bins > F.col("mrpointnum")).isEmpty()
    assert made["grid_loss"].where("udtotal > uptotal + dltotal").isEmpty()
    assert made["sample_positions"].count() <= samples.count()
    assert {"overlaps", "grid_result", "floor_rsrp"} <= set(made)
    again = daily.report_day(spark, result, mro_path, inputs[0], folder("reports"), day)
    assert same(made["grid_kpi"], again["grid_kpi"])


def test_fingerprint_jobs(spark, sf, folder):
    from gridscope_checks.queries_grid import mdt_points

    ground, upper = fingerprint.build(d.finger_raw(spark, sf), d.res_cell(spark, sf), folder("ground"), folder("upper"))
    assert ground.where("height != 0").isEmpty() and upper.where("height = 0").isEmpty()
    ground_path = folder("finger")
    d.finger_ground(spark, sf).write.parquet(ground_path)
    corrected = fingerprint.calibrate(spark, mdt_points(spark, sf), ground_path, folder("stats"), folder("calibrated"))
    assert corrected.count() == d.finger_ground(spark, sf).count()


def test_mro_job(spark, sf, folder):
    path = folder("mro")
    wide = d.mro_wide(spark, sf).withColumn("day", F.substring(F.regexp_replace("timestamp", "-", ""), 1, 4)) \
        .withColumn("hour", F.lit("00"))
    cells = d.cells(spark, sf)
    hourly_plan.build_mro(wide, cells, path)
    whole = neighbours.resolve_neighbours(wide, neighbours.nearest_cell_by_pci(cells, d.pci_list(spark, sf)))
    made = tables.read_partition(spark, path, schema=schemas.MRO)
    assert set(made.columns) >= {"objectid", "ncellobjectid", "ltencrsrp", "ta", "day", "hour"}
    assert same(made.select(*whole.columns), whole) and not whole.isEmpty()
    assert made.where("ncellobjectid = objectid").isEmpty()
