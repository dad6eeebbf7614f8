"""Schemas of every layer, and the mapping from an Avro record schema to Spark types."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ingotflow import storage

# The event's enum symbols and its sixteen fields, in wire order.
ORDER_STATUSES = ["PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"]
CURRENCIES = ["USD", "EUR", "BRL"]
ORDER_RECORD = {
    "type": "record",
    "name": "Order",
    "fields": [
        {"name": "order_id", "type": "string"},
        {"name": "customer_id", "type": "string"},
        {"name": "customer_name", "type": "string"},
        {"name": "customer_email", "type": "string"},
        {"name": "order_status",
         "type": {"type": "enum", "name": "OrderStatus", "symbols": ORDER_STATUSES}},
        {"name": "product_id", "type": "string"},
        {"name": "product_name", "type": "string"},
        {"name": "product_category", "type": "string"},
        {"name": "quantity", "type": "int"},
        {"name": "unit_price", "type": "double"},
        {"name": "total_amount", "type": "double"},
        {"name": "currency",
         "type": {"type": "enum", "name": "Currency", "symbols": CURRENCIES}},
        {"name": "order_timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "shipping_address_city", "type": "string"},
        {"name": "shipping_address_state", "type": "string"},
        {"name": "shipping_address_country", "type": "string"},
    ],
}

# Avro primitive (or logical) type -> Spark type, for the flat records the pipelines carry.
AVRO_TO_SPARK = {
    "string": T.StringType(),
    "enum": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp-millis": T.TimestampType(),
}


def load_record_schema(spark: SparkSession, path: str) -> str:
    """The JSON text of a record schema file, on any file system that Spark reads."""
    return storage.read_text(spark, path)


def record_fields(schema_json: str) -> list[tuple[str, str, list[str]]]:
    """``(name, kind, enum symbols)`` per field; ``kind`` is a key of ``AVRO_TO_SPARK``."""
    record = json.loads(schema_json)
    if record.get("type") != "record":
        raise ValueError("the top level of a record schema must be of type 'record'")
    fields = []
    for field in record["fields"]:
        declared = field["type"]
        if isinstance(declared, dict):
            kind = declared.get("logicalType", declared["type"])
            symbols = declared.get("symbols", [])
        else:
            kind, symbols = declared, []
        if not isinstance(kind, str) or kind not in AVRO_TO_SPARK:
            raise ValueError(f"field {field['name']!r} has unsupported type {declared!r}")
        fields.append((field["name"], kind, symbols))
    return fields


def struct_from_record(schema_json: str) -> T.StructType:
    """The Spark struct a record of this schema decodes to."""
    return T.StructType(
        [T.StructField(name, AVRO_TO_SPARK[kind]) for name, kind, _ in record_fields(schema_json)])


def _extended(base: T.StructType, *extra: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(base.fields + [T.StructField(n, t) for n, t in extra])


ORDER_SCHEMA_JSON = json.dumps(ORDER_RECORD)
EVENT = struct_from_record(ORDER_SCHEMA_JSON)
EVENT_COLUMNS = EVENT.names

# The columns of Spark's public Kafka source.
KAFKA_ROW = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

BRONZE_FILE = _extended(
    EVENT,
    ("_ingested_at", T.TimestampType()),
    ("_source_file", T.StringType()),
    ("_batch_id", T.StringType()),
    ("ingestion_date", T.DateType()),
)
BRONZE_STREAM = _extended(
    EVENT,
    ("_kafka_partition", T.IntegerType()),
    ("_kafka_offset", T.LongType()),
    ("_kafka_timestamp", T.TimestampType()),
    ("_ingested_at", T.TimestampType()),
    ("ingestion_date", T.DateType()),
)

# Silver keeps the event columns with the derived date after the event time.
_AT = EVENT_COLUMNS.index("order_timestamp") + 1
SILVER_BASE_COLUMNS = [*EVENT_COLUMNS[:_AT], "order_date", *EVENT_COLUMNS[_AT:], "_ingested_at"]
SILVER_FILE_COLUMNS = [*SILVER_BASE_COLUMNS, "_source_file", "_batch_id"]
SILVER_STREAM_OPTIONAL = ["_kafka_partition", "_kafka_offset", "_kafka_timestamp"]
