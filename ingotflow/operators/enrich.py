"""Ingest metadata, casts, derived columns and the fixed column lists of each layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingotflow.functions.avro import decode_record
from ingotflow.functions.columns import event_time, line_total
from ingotflow.functions.framing import strip_header
from ingotflow.schemas import (
    ORDER_SCHEMA_JSON,
    SILVER_BASE_COLUMNS,
    SILVER_FILE_COLUMNS,
    SILVER_STREAM_OPTIONAL,
    record_fields,
)


def parse_messages(messages: DataFrame, schema_json: str = ORDER_SCHEMA_JSON,
                   mode: str = "FAILFAST", use_spark_avro: bool | None = None) -> DataFrame:
    """Topic rows to flat records plus their source position: strip, decode, flatten."""
    decoded = messages.withColumn(
        "_record", decode_record(strip_header(F.col("value")), schema_json, mode, use_spark_avro))
    names = [name for name, _, _ in record_fields(schema_json)]
    return decoded.select(
        *[F.col("_record").getField(name).alias(name) for name in names],
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("timestamp").alias("_kafka_timestamp"),
    )


def add_file_metadata(df: DataFrame, batch_id: str) -> DataFrame:
    """Bronze metadata of the file profile. ``df`` must come straight from a file scan."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
        F.to_date(F.current_timestamp()).alias("ingestion_date"),
    )


def add_stream_metadata(df: DataFrame) -> DataFrame:
    """Bronze metadata of the stream profile; the time is that of the micro-batch."""
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.to_date(F.current_timestamp()).alias("ingestion_date"),
    )


def cast_and_derive(df: DataFrame, timestamp: str = "order_timestamp",
                    date: str = "order_date") -> DataFrame:
    """Event time as a timestamp, and its calendar date."""
    moment = event_time(timestamp, df.schema[timestamp].dataType)
    return df.withColumn(timestamp, moment).withColumn(date, F.col(timestamp).cast("date"))


def select_file_columns(df: DataFrame) -> DataFrame:
    return df.select(*SILVER_FILE_COLUMNS)


def select_stream_columns(df: DataFrame) -> DataFrame:
    present = [c for c in SILVER_STREAM_OPTIONAL if c in df.columns]
    return df.select(*SILVER_BASE_COLUMNS, *present)


def with_line_total(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount", line_total(F.col("quantity"), F.col("unit_price")))
