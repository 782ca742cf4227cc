"""Build the user-feature tables from a folder of text lines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from gridscope.operators import features
from gridscope.sources.tables import export_csv, write_table


def build(spark: SparkSession, folder: str, values_path: str, wide_path: str, slots: int = features.LIST_SLOTS,
          csv_path: str | None = None) -> None:
    """Every value in the long table, one row per line in the wide one, on request also its numbered columns as CSV."""
    lines = spark.read.text(folder)
    write_table(features.feature_values(lines), values_path, mode="overwrite")
    wide = features.user_features_wide(lines, slots)
    write_table(wide, wide_path, mode="overwrite")
    if csv_path is not None:
        flat = [c for c, kind in wide.dtypes if not kind.startswith("array")]
        export_csv(spark.read.schema(wide.schema).parquet(wide_path).select(*flat), csv_path)
