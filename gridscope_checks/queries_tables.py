"""Scans and writes (S2-S16). Each query writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridscope_checks import domain as d
from gridscope_checks.domain_sql import with_tables
from gridscope_checks.queries_locate import located_chain
from gridscope_checks.queries_text import PARSED, _line_sql, feature_lines
from gridscope_checks.registry import query
from gridscope import schemas
from gridscope.operators import features
from gridscope.plans import hourly as hourly_plan
from gridscope.sources import mdt_text, tables

HOURLY = """
select * exclude (day, hour), left(day, 4) || '0101' as day, lpad(cast(cast(mmeues1apid as bigint) % 4 as varchar), 2, '0')
 as hour from mro
"""


def hourly(spark, sf):
    """Samples under a few days and hours, so that small data makes few folders."""
    hour = F.lpad((F.col("mmeues1apid").cast("bigint") % 4).cast("string"), 2, "0")
    return d.mro(spark, sf).withColumn("day", F.concat(F.left("day", F.lit(4)), F.lit("0101"))) \
        .withColumn("hour", hour)


def summary(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("ltescrsrp").cast("bigint").alias("strength"))


def summary_sql(source: str, *keys: str) -> str:
    return f"select {', '.join(keys)}, count(*) as n, cast(sum(ltescrsrp) as bigint) as strength from {source} group by all"


def _written(spark, sf, name, fmt="parquet"):
    path = tables.scratch_path(spark, name)
    tables.write_table(tables.by_columns(hourly(spark, sf), "day", "hour"), path, ("day", "hour"), fmt)
    return path


@query("s2_partition_scan", with_tables("mro", f"""
{summary_sql("hourly", "day", "hour", "objectid")} having day = '19970101'
""", hourly=HOURLY))
def partition_scan(spark, sf):
    rows = tables.read_partition(spark, _written(spark, sf, "scan"), day="19970101")
    return summary(rows, "day", "hour", "objectid")


@query("s3_mdt_text_scan", with_tables("mdt", "select * from mdt"))
def mdt_text_scan(spark, sf):
    paths = []
    for layout in (1, 2):
        paths.append(tables.scratch_path(spark, f"mdt{layout}"))
        d.mdt_lines(spark, sf, layout).write.text(paths[-1])
    return mdt_text.read_mdt(spark, *paths)


@query("s4_feature_text_scan", f"""
with lines as ({_line_sql()}), parsed as ({PARSED}) select uid, age, lbs, house, len(kw1) as kw1_values from parsed
""")
def feature_text_scan(spark, sf):
    path = tables.scratch_path(spark, "features")
    feature_lines(spark, sf).write.text(path)
    return features.parse_features(spark.read.text(path)).select(
        "uid", "age", "lbs", "house", F.size("kw1").cast("bigint").alias("kw1_values"))


@query("s5_delimited_table", with_tables("mro", "select * from hourly", hourly=HOURLY))
def delimited_table(spark, sf):
    return tables.read_partition(spark, _written(spark, sf, "text", "csv"), fmt="csv", schema=schemas.MRO)


@query("s6_typed_table", with_tables("mro", "select * from hourly", hourly=HOURLY))
def typed_table(spark, sf):
    return tables.read_partition(spark, _written(spark, sf, "typed", "orc"), fmt="orc", schema=schemas.MRO)


@query("s7_partition_overwrite", with_tables("mro", summary_sql("hourly", "day", "hour"), hourly=HOURLY))
def partition_overwrite(spark, sf):
    path = _written(spark, sf, "rerun")
    again = hourly(spark, sf)
    tables.overwrite_partitions(again.where("day = '19970101'"), path)
    tables.overwrite_partition(again.where("day = '19980101' and hour = '01'"), path, day="19980101", hour="01")
    return summary(tables.read_partition(spark, path, schema=schemas.MRO), "day", "hour")


@query("s8_dynamic_overwrite", with_tables("mro", """
select day, hour, count(*) as n, cast(sum(case when day = '19970101' then 0 else ltescrsrp end) as bigint) as strength
from hourly group by all
""", hourly=HOURLY))
def dynamic_overwrite(spark, sf):
    path = _written(spark, sf, "dynamic")
    changed = hourly(spark, sf).where("day = '19970101'").withColumn("ltescrsrp", F.lit(0))
    tables.overwrite_partitions(changed, path)
    return summary(tables.read_partition(spark, path, schema=schemas.MRO), "day", "hour")


@query("s9_append", with_tables("mro", """
select day, hour, 2 * count(*) as n, cast(2 * sum(ltescrsrp) as bigint) as strength from hourly group by all
""", hourly=HOURLY))
def append(spark, sf):
    path = _written(spark, sf, "append")
    tables.write_table(hourly(spark, sf), path, ("day", "hour"), mode="append")
    return summary(tables.read_partition(spark, path, schema=schemas.MRO), "day", "hour")


@query("s10_replace_table", with_tables("mro", "select objectid, count(*) as n from mro group by 1"))
def replace_table(spark, sf):
    path = tables.scratch_path(spark, "replace")
    counts = d.mro(spark, sf).groupBy("objectid").agg(F.count(F.lit(1)).alias("n"))
    tables.write_table(counts.withColumn("n", F.col("n") * 0), path)
    tables.write_table(counts, path, mode="overwrite")
    return spark.read.parquet(path)


def _catalog_name(path: str) -> str:
    return "t_" + path.rsplit("-", 1)[-1]


@query("s10_create_table_as", with_tables("mro", summary_sql("hourly", "day", "hour"), hourly=HOURLY))
def create_table_as(spark, sf):
    path = tables.scratch_path(spark, "ctas")
    tables.save_as_table(summary(hourly(spark, sf), "day", "hour"), _catalog_name(path), path=path)
    return spark.table(_catalog_name(path))


@query("s11_drop_partition", with_tables("mro", f"""
{summary_sql("hourly", "day", "hour")} having day <> '19970101' and not (day = '19980101' and hour = '02')
""", hourly=HOURLY))
def drop_partition(spark, sf):
    path = tables.scratch_path(spark, "drop")
    name = _catalog_name(path)
    tables.save_as_table(hourly(spark, sf), name, ("day", "hour"), path=path)
    tables.drop_partition(spark, name, "19970101")
    tables.drop_partition(spark, name, "19980101", "02")
    return summary(spark.table(name), "day", "hour")


@query("s12_compaction", with_tables("mro", summary_sql("hourly", "day", "hour"), hourly=HOURLY))
def compaction(spark, sf):
    source, path = _written(spark, sf, "loose"), tables.scratch_path(spark, "compact")
    tables.compact(tables.read_partition(spark, source, schema=schemas.MRO), path)
    return summary(tables.read_partition(spark, path, schema=schemas.MRO), "day", "hour")


@query("s14_csv_export", with_tables("mro", summary_sql("hourly", "day", "hour"), hourly=HOURLY))
def csv_export(spark, sf):
    path = tables.scratch_path(spark, "export")
    tables.export_csv(summary(hourly(spark, sf), "day", "hour"), path, single_file=True)
    return spark.read.option("header", True).schema("day string, hour string, n bigint, strength bigint").csv(path)


@query("s15_redistribute", with_tables("mro", summary_sql("hourly", "hour", "objectid"), hourly=HOURLY))
def redistribute(spark, sf):
    return summary(tables.by_columns(hourly(spark, sf), "hour"), "hour", "objectid")


@query("s16_input_guard", with_tables("mro", summary_sql("hourly", "day", "hour"), hourly=HOURLY))
def input_guard(spark, sf):
    rows = hourly(spark, sf)
    if not tables.has_rows(rows) or tables.has_rows(rows.where("day = 'none'")):
        raise ValueError("the guard is wrong")
    return summary(rows, "day", "hour")


@query("e1_locate_all_hours", with_tables("mro finger sites", """
select * replace (left(day, 4) || '0101' as day, lpad(cast(cast(mmeues1apid as bigint) % 4 as varchar), 2, '0') as hour)
from samples
""", **located_chain("all")))
def locate_all_hours(spark, sf):
    floor_path, result_path = tables.scratch_path(spark, "floor"), tables.scratch_path(spark, "result")
    hourly_plan.locate_hours(spark, _written(spark, sf, "mro"), d.finger_ground(spark, sf), d.finger_upper(spark, sf),
                             d.sites(spark, sf), floor_path, result_path)
    return tables.read_partition(spark, result_path, schema=hourly_plan.PLACED)
