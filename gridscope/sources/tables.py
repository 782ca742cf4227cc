"""Tables on shared storage: scans, partition writes, compaction."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors can reach, as the cluster names it.

    Where the setting is missing it is a folder of the warehouse, which is shared as well.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_partition(spark: SparkSession, path: str, day: str | None = None, hour: str | None = None,
                   fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """One day or hour of a table partitioned by day and hour; other folders are not read.

    With ``fmt='csv'`` and a schema it reads delimited text (S5). Day and hour
    are text, also where they look like numbers.
    """
    if schema is None:
        found = spark.read.format(fmt).load(path).drop("day", "hour").schema
    else:
        found = T.StructType.fromDDL(schema)
    typed = T.StructType(found.fields).add("day", "string").add("hour", "string")
    df = spark.read.format(fmt).schema(typed).load(path)
    if day is not None:
        df = df.where(F.col("day") == day)
    if hour is not None:
        df = df.where(F.col("hour") == hour)
    return df


def partition_folders(df: DataFrame, columns: Sequence[str]) -> list[dict[str, str]]:
    """Values of the partition columns in the folders that a scan reads, from the names of its files; nothing is read."""
    found = set()
    for file in df.inputFiles():
        parts = dict(part.split("=", 1) for part in file.split("/") if "=" in part)
        if all(column in parts for column in columns):
            found.add(tuple(unquote(unquote(parts[column])) for column in columns))
    return [dict(zip(columns, values)) for values in sorted(found)]


def has_rows(df: DataFrame) -> bool:
    """Whether there is anything to work on."""
    return not df.isEmpty()


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                mode: str = "error", **options: str) -> None:
    """Write as a new table, append to it or replace it."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("day", "hour"),
                         fmt: str = "parquet") -> None:
    """Replace exactly the partitions that occur in ``df``; a rerun changes nothing."""
    write_table(df, path, partition_by, fmt, "overwrite", partitionOverwriteMode="dynamic")


def overwrite_partition(df: DataFrame, path: str, fmt: str = "parquet", **partition: str) -> None:
    """Replace one named partition; with no rows it becomes empty."""
    place = "/".join(f"{name}={value}" for name, value in partition.items())
    df.drop(*partition).write.format(fmt).mode("overwrite").save(f"{path}/{place}")


def save_as_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                  mode: str = "error", path: str | None = None) -> None:
    """Catalog table, created from the rows; with ``path`` its files lie there."""
    writer = df.write.format(fmt).mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def drop_partition(spark: SparkSession, table: str, day: str, hour: str | None = None) -> None:
    """Drop a day or hour of a catalog table before it is computed again."""
    if not all(value is None or value.isalnum() for value in (day, hour)):
        raise ValueError(f"not a day or hour: {day}, {hour}")
    hours = [hour]
    if hour is None:
        shown = spark.sql(f"SHOW PARTITIONS {table} PARTITION (day = '{day}')").collect()
        hours = [row.partition.rsplit("hour=", 1)[-1] for row in shown]
    parts = ", ".join(f"PARTITION (day = '{day}', hour = '{h}')" for h in hours)
    if parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def by_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of equal values together, for few files per value.

    A value with many rows is split over several tasks and files, small ones share a task.
    """
    return df.hint("rebalance", *columns)


def compact(df: DataFrame, path: str, partition_by: Sequence[str] = ("day", "hour"), fmt: str = "parquet") -> None:
    """Write many small files again as few files per partition."""
    overwrite_partitions(by_columns(df, *partition_by), path, partition_by, fmt)


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Number of files and bytes of each folder of a table, from the file listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def compact_small_files(spark: SparkSession, path: str, partition_by: Sequence[str] = ("day", "hour"),
                        file_bytes: int = 128 << 20, fmt: str = "parquet") -> list[dict[str, str | None]]:
    """S12 in place: write again only partitions with more files than their bytes ask for; all other files stay as they are.

    Returns the values of the partitions written, one row per folder. A large partition is written by several tasks
    (:func:`by_columns`), so ``file_bytes`` should not be below the session's advisory partition size.
    """
    loose = folder_sizes(spark, path).where(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)))
    some = []
    for row in loose.select("folder").collect():
        parts = dict(part.split("=", 1) for part in row.folder.split("/") if "=" in part)
        values = {name: unquote(parts[name]) for name in partition_by}
        some.append({name: None if value == "__HIVE_DEFAULT_PARTITION__" else value for name, value in values.items()})
    if some:
        fields = spark.read.format(fmt).load(path).drop(*partition_by).schema.fields
        typed = T.StructType(fields + [T.StructField(name, T.StringType()) for name in partition_by])
        chosen = reduce(lambda a, b: a | b, (
            reduce(lambda a, b: a & b, (F.col(name).eqNullSafe(F.lit(value)) for name, value in row.items())) for row in some))
        table = spark.read.format(fmt).schema(typed).load(path).where(chosen)
        overwrite_partitions(by_columns(table, *partition_by), path, partition_by, fmt)
    return some


def export_csv(df: DataFrame, path: str, limit: int | None = None,
               order_by: Sequence[str] = (), single_file: bool = False) -> None:
    """Delimited export with header; ``limit`` keeps the first rows.

    ``single_file`` writes with one task and is meant for small reports; what comes before stays spread.
    """
    if order_by and limit is not None:
        df = df.orderBy(*order_by)
    if limit is not None:
        df = df.limit(limit)
    if single_file:
        df = df.repartition(1)
    df.write.mode("overwrite").option("header", True).csv(path)
