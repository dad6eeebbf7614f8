"""Landed Parquet files, all of them or the new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ingotflow.schemas import EVENT

#: A file age that leaves no file out.
ANY_AGE = "36500d"


def read_landing(spark: SparkSession, path: str, schema: T.StructType = EVENT) -> DataFrame:
    """Every Parquet file below ``path``; hour directories do not become columns.

    The schema is given, so no footer is read to infer it.
    """
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def read_landing_stream(spark: SparkSession, path: str, schema: T.StructType = EVENT,
                        max_bytes: int | None = None, max_file_age: str = ANY_AGE) -> DataFrame:
    """The same files as a stream: a query's checkpoint remembers which it has read.

    ``max_file_age`` is how far a file's modification time may lie behind the newest one read and the
    file still be taken. By default no landed file is too old, so late copies and backfills arrive; the
    price is that the list of files read, in the checkpoint and on the driver, keeps every name. A
    shorter age bounds that list, and silently leaves older files out.
    """
    reader = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
              .option("maxFileAge", max_file_age))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
