"""JDBC tables (S1, S13). Connection settings come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Connections that a write opens unless told otherwise.
CONNECTIONS = 8

# Fixed value: rows per insert batch.
BATCH_ROWS = 500

# Columns of the result tables in a database.
SAMPLE_TABLE = ("objectid", "mmeues1apid", "time_stamp", "gridid", "height")
FLOOR_TABLE = ("buildid", "floor", "rsrp")
GRID_TABLE = ("gridid", "longitude", "latitude", "rsrp")
LOSS_TABLE = ("gridid", "uldlqcicount", "ulqci1count", "ulqci1rate", "dlqci1count", "dlqci1rate",
              "pusum", "pdsum")


def read_options(url: str, table: str, partition_column: str | None = None, lower=None, upper=None,
                 partitions: int | None = None, **options: str) -> dict[str, str]:
    """Options of a scan; with a partition column it is read in ranges by many tasks."""
    chosen = {"url": url, "dbtable": table, **options}
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partition column needs lower, upper and partitions")
        chosen |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                   "upperBound": str(upper), "numPartitions": str(partitions)}
    return chosen


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """S1."""
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def write_options(url: str, table: str, batch_rows: int = BATCH_ROWS,
                  connections: int | None = CONNECTIONS, **options: str) -> dict[str, str]:
    chosen = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **options}
    if connections is not None:
        chosen["numPartitions"] = str(connections)
    return chosen


def write_rows(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Batch insert, one connection per partition and at most ``connections`` of them."""
    df.write.format("jdbc").mode(mode).options(**write_options(url, table, **options)).save()


def sample_rows(located: DataFrame) -> DataFrame:
    return located.select(*SAMPLE_TABLE)


def floor_rows(floors: DataFrame) -> DataFrame:
    return floors.select("buildingid", "height", "rsrp").toDF(*FLOOR_TABLE)


def grid_rows(finger_means: DataFrame) -> DataFrame:
    return finger_means.select("gridid", "longitude", "latitude", "avgrsrp").toDF(*GRID_TABLE)


def loss_rows(loss: DataFrame) -> DataFrame:
    return loss.select("gridid", "udtotal", "uptotal", "uplost", "dltotal", "dllost",
                       "pusum", "pdsum").toDF(*LOSS_TABLE)


def kpi_rows(kpi: DataFrame, report_day) -> DataFrame:
    """Grid measures with a report date column; ``report_day`` is a ``yyyyMMdd`` column."""
    from pyspark.sql import functions as F

    return kpi.withColumn("reporttime", F.to_date(report_day, "yyyyMMdd"))
