"""Tables by path and by name."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ingotflow.schemas import BRONZE_FILE, BRONZE_STREAM
from ingotflow.snapshots import SnapshotTable
from ingotflow.streaming.batches import INGESTION_DATE, has_batches, read_batches

ORDER_DATE = "order_date"


def bronze_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, INGESTION_DATE)


def silver_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ORDER_DATE)


def read_bronze_file(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Bronze of the file profile, all of it or the dates from ``since`` on.

    Whole appends are snapshots, appends of newly landed files are micro-batches; a table may have both.
    """
    table = bronze_table(spark, path)
    if not table.exists():
        return read_batches(spark, path, BRONZE_FILE, since)
    rows = table.read(since=since)
    if not has_batches(spark, path):
        return rows
    return rows.unionByName(read_batches(spark, path, rows.schema, since))


def read_bronze_stream(spark: SparkSession, path: str, since: date | None = None,
                       schema: T.StructType = BRONZE_STREAM) -> DataFrame:
    """Bronze of the stream profile: every micro-batch, or those of the dates from ``since`` on."""
    return read_batches(spark, path, schema, since)


def read_named(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """A plain Parquet directory addressed by path in SQL."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")
