"""Grid, floor and sample reports of one day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscope import schemas
from gridscope.operators import kpi
from gridscope.plans.hourly import PLACED
from gridscope.sources.tables import by_columns, export_csv, overwrite_partition, read_partition


@dataclass(frozen=True)
class DayTables:
    """Folders of the day's tables, each partitioned by day."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str, day: str) -> DataFrame:
        """Replace the day's rows and read them back."""
        path = self.path(table)
        overwrite_partition(df, path, day=day)
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/day={day}")


def report_day(spark: SparkSession, located_path: str, mro_path: str, ground: DataFrame, root: str, day: str,
               grid_building: DataFrame | None = None, csv_root: str | None = None) -> dict[str, DataFrame]:
    """All tables of a day, by name; every step reads what the step before has written.

    With ``csv_root`` the grid result and the sample positions are delivered as CSV too (S14).
    """
    tables = DayTables(root)
    samples = read_partition(spark, located_path, day, schema=PLACED).drop("day")
    samples = tables.write(by_columns(samples, "hour"), "samples", day)
    mro = read_partition(spark, mro_path, day, schema=schemas.MRO)
    made = {"samples": samples}
    facts = tables.write(kpi.sample_facts(samples, mro), "sample_facts", day)
    made["sample_facts"] = facts
    made["overlaps"] = tables.write(kpi.overlap_of(facts), "overlaps", day)
    made["grid_kpi"] = tables.write(kpi.grid_kpi(samples, made["overlaps"], ground), "grid_kpi", day)
    made["grid_loss"] = tables.write(kpi.loss_of(facts), "grid_loss", day)
    made["grid_result"] = tables.write(
        kpi.grid_result(made["grid_kpi"], made["grid_loss"], ground), "grid_result", day)
    made["sample_positions"] = tables.write(
        by_columns(kpi.sample_positions(samples, ground), "hour"), "sample_positions", day)
    if grid_building is not None:
        made["floor_rsrp"] = tables.write(kpi.floor_rsrp(made["grid_kpi"], grid_building), "floor_rsrp", day)
    if csv_root is not None:
        for name in ("grid_result", "sample_positions"):
            export_csv(made[name], f"{csv_root}/{name}/{day}")
    return {name: df.withColumn("day", F.lit(day)) for name, df in made.items()}
