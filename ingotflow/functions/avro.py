"""Binary Avro records as a struct column.

Where the ``spark-avro`` module is on the classpath its JVM decoder does the work. Where it is not,
an Arrow UDF decodes whole column batches with NumPy: one pass per *field*, not per row.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ingotflow.schemas import record_fields, struct_from_record

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODES = ("FAILFAST", "PERMISSIVE")
MAX_MICROS = np.iinfo(np.int64).max


def spark_avro_loaded(spark: SparkSession) -> bool:
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        return False
    return True


def decode_record(payload: Column, schema_json: str, mode: str = "FAILFAST",
                  use_spark_avro: bool | None = None) -> Column:
    """Decode ``payload`` (no frame header) into a struct of the record's fields.

    ``FAILFAST`` fails the query on a malformed record, ``PERMISSIVE`` yields NULL for it.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if use_spark_avro is None:
        use_spark_avro = spark_avro_loaded(SparkSession.active())
    if use_spark_avro:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema_json, {"mode": mode})

    fields = record_fields(schema_json)
    fail_fast = mode == "FAILFAST"

    @F.arrow_udf(struct_from_record(schema_json))
    def decode(batch: pa.Array) -> pa.Array:
        return decode_batch(batch, fields, fail_fast)

    # Deterministic UDFs are copied into every filter pushed below the projection, and run again.
    return decode.asNondeterministic()(payload)


class _Cursor:
    """One read position per record over the shared byte buffer of a column batch."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        self.data, self.pos, self.end = data, start.astype(np.int64), end.astype(np.int64)
        self.bad = np.zeros(len(start), dtype=bool)

    def bytes_at(self, positions: np.ndarray) -> np.ndarray:
        return self.data[np.minimum(positions, len(self.data) - 1)]

    def varint(self) -> np.ndarray:
        """Zig-zag variable-length integers, seven bits per byte, at most ten bytes."""
        raw = np.zeros(len(self.pos), dtype=np.uint64)
        more = ~self.bad
        for shift in range(0, 70, 7):
            self.bad |= more & (self.pos >= self.end)
            more &= ~self.bad
            if not more.any():
                break
            byte = np.where(more, self.bytes_at(self.pos), 0).astype(np.uint64)
            raw |= (byte & np.uint64(0x7F)) << np.uint64(shift)
            self.pos += more
            more &= byte >= 0x80
        self.bad |= more
        return (raw >> np.uint64(1)).astype(np.int64) ^ -(raw & np.uint64(1)).astype(np.int64)

    def take(self, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Advance by ``length`` bytes: where each slice starts, and its checked length."""
        self.bad |= (length < 0) | (length > self.end - self.pos)
        length = np.where(self.bad, 0, length)
        start = self.pos.copy()
        self.pos += length
        return start, length

    def strings(self) -> pa.Array:
        start, length = self.take(self.varint())
        offsets = np.zeros(len(length) + 1, dtype=np.int64)
        np.cumsum(length, out=offsets[1:])
        gather = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
        return pa.LargeStringArray.from_buffers(
            len(length), pa.py_buffer(offsets), pa.py_buffer(self.data[gather])).cast(pa.string())

    def doubles(self) -> pa.Array:
        start, _ = self.take(np.full(len(self.pos), 8, dtype=np.int64))
        return pa.array(self.bytes_at(start[:, None] + np.arange(8)).copy().view("<f8").ravel())

    def integers(self) -> pa.Array:
        value = self.varint()
        self.bad |= value != value.astype(np.int32)
        return pa.array(value.astype(np.int32))

    def symbols(self, names: list[str]) -> pa.Array:
        index = self.varint()
        self.bad |= (index < 0) | (index >= len(names))
        return pa.array(names, pa.string()).take(pa.array(np.where(self.bad, 0, index)))

    def read(self, kind: str, names: list[str]) -> pa.Array:
        if kind == "string":
            return self.strings()
        if kind == "enum":
            return self.symbols(names)
        if kind == "int":
            return self.integers()
        if kind == "double":
            return self.doubles()
        value = self.varint()
        if kind == "timestamp-millis":
            self.bad |= np.abs(value // 1000) > MAX_MICROS // 1_000_000
            return pa.array(np.where(self.bad, 0, value) * 1000).cast(pa.timestamp("us", "UTC"))
        return pa.array(value)


def decode_batch(batch: pa.Array, fields: list[tuple[str, str, list[str]]],
                 fail_fast: bool) -> pa.Array:
    rows = len(batch)
    _, offset_buffer, data_buffer = batch.buffers()
    if rows:
        width = np.int64 if pa.types.is_large_binary(batch.type) else np.int32
        offsets = np.frombuffer(offset_buffer, width)[batch.offset:batch.offset + rows + 1]
    else:
        offsets = np.zeros(1, np.int32)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    present = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
    cursor = _Cursor(data if len(data) else np.zeros(1, np.uint8),
                     offsets[:-1][present], offsets[1:][present])
    columns = [cursor.read(kind, names) for _, kind, names in fields]
    if fail_fast and cursor.bad.any():
        raise ValueError(f"{int(cursor.bad.sum())} malformed record(s) in a batch of {rows}")
    decoded = pa.StructArray.from_arrays(columns, [name for name, _, _ in fields])
    if len(present) == rows and not cursor.bad.any():
        return decoded
    source = np.zeros(rows, dtype=np.int64)
    missing = np.ones(rows, dtype=bool)
    source[present] = np.arange(len(present))
    missing[present] = cursor.bad
    return decoded.take(pa.array(source, mask=missing))
