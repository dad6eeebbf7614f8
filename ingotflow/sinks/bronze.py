"""Batch append to bronze, and its compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ingotflow.schemas import BRONZE_FILE
from ingotflow.snapshots import SMALL_FILE_BYTES, Snapshot
from ingotflow.sources.tables import bronze_table
from ingotflow.streaming.batches import compact_batches


def append_bronze(df: DataFrame, path: str, optimize_write: bool = False, tasks: int | None = None) -> Snapshot:
    """Append records with file metadata, by ``ingestion_date``.

    A batch has one ingestion date and its tasks are sized by the scan, so sizing the files by a
    shuffle is off by default; ``compact_bronze`` joins whatever came out small. ``tasks`` are so many that
    nothing comes out small.
    """
    rows = df.coalesce(tasks) if tasks else df
    return bronze_table(df.sparkSession, path).append(rows, rebalance=optimize_write, sized=bool(tasks))


def compact_bronze(spark: SparkSession, path: str, small_file_bytes: int = SMALL_FILE_BYTES,
                   schema: T.StructType = BRONZE_FILE) -> None:
    """Same rows, fewer files: of snapshots, and of micro-batches (whose columns are ``schema``)."""
    table = bronze_table(spark, path)
    if table.exists():
        table.compact(small_file_bytes)
    compact_batches(spark, path, schema, small_file_bytes)
