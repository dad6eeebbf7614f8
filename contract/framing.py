"""Test input: order rows as framed topic messages. The library itself only decodes."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingotflow.functions.framing import MARKER
from ingotflow.schemas import EVENT_COLUMNS, ORDER_SCHEMA_JSON, record_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA_ID = (1).to_bytes(4, "big")


def _varints(values: np.ndarray) -> pa.Array:
    """Zig-zag variable-length integers as a binary column."""
    signed = values.astype(np.int64)
    raw = ((signed << 1) ^ (signed >> 63)).astype(np.uint64)
    groups = raw[:, None] >> (np.arange(10, dtype=np.uint64) * np.uint64(7))
    used = np.maximum((groups != 0).sum(axis=1), 1)
    keep = np.arange(10) < used[:, None]
    more = np.arange(10) < (used - 1)[:, None]
    data = ((groups & np.uint64(0x7F)).astype(np.uint8) | (more * 0x80).astype(np.uint8))[keep]
    offsets = np.concatenate([[0], np.cumsum(used)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _encoded(column: pa.Array, kind: str, symbols: list[str]) -> list[pa.Array]:
    if kind == "string":
        text = column.cast(pa.binary())
        return [_varints(pc.binary_length(text).to_numpy()), text]
    if kind == "enum":
        return [_varints(pc.index_in(column, pa.array(symbols, column.type)).to_numpy())]
    if kind == "double":
        raw = np.ascontiguousarray(column.to_numpy(), "<f8")
        return [pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(8), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())]
    if kind == "timestamp-millis":
        column = pc.divide(column.cast(pa.timestamp("us")).cast(pa.int64()), 1000)
    return [_varints(column.to_numpy())]


def encode_record(record: Column) -> Column:
    """A struct of the event's columns (none NULL) as a binary record."""
    fields = record_fields(ORDER_SCHEMA_JSON)

    @F.arrow_udf(T.BinaryType())
    def encode(batch: pa.Array) -> pa.Array:
        if not len(batch):
            return pa.array([], pa.binary())
        parts = [part for column, (_, kind, symbols) in zip(batch.flatten(), fields)
                 for part in _encoded(column, kind, symbols)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))

    return encode.asNondeterministic()(record)


def as_messages(orders: DataFrame, partition: Column, offset: Column,
                timestamp: Column, *beside: Column) -> DataFrame:
    """Order rows (amounts as doubles) as rows of the topic, with columns ``beside`` these."""
    value = F.concat(F.lit(MARKER + SCHEMA_ID), encode_record(F.struct(*EVENT_COLUMNS)))
    return orders.select(
        F.col("order_id").cast("binary").alias("key"), value.alias("value"),
        F.lit("orders.raw").alias("topic"), partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"), timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"), *beside)
