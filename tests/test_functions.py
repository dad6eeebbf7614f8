import struct
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from conftest import DEFAULTS
from pyspark.sql import functions as F

from contract.framing import _varints, encode_record
from ingotflow.functions.avro import _Cursor, decode_batch, decode_record, spark_avro_loaded
from ingotflow.functions.columns import hour_bucket, line_total
from ingotflow.functions.framing import strip_header
from ingotflow.schemas import (
    EVENT,
    EVENT_COLUMNS,
    ORDER_SCHEMA_JSON,
    load_record_schema,
    record_fields,
    struct_from_record,
)


@pytest.mark.parametrize("value, expected", [
    (None, None), ("", ""), ("0001", "0001"), ("0000000001", ""), ("0000000001616263", "616263"),
    ("0100000001616263", "0100000001616263"), ("00000000", "00000000"),
])
def test_header_strip_edges(spark, value, expected):
    raw = None if value is None else bytearray.fromhex(value)
    row = spark.createDataFrame([(raw,)], "value binary").select(strip_header(F.col("value"))).first()
    assert (None if row[0] is None else bytes(row[0]).hex()) == expected


def test_header_strip_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(b"x",)], "value binary").select(strip_header(F.col("value")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_hour_bucket_pads_and_line_total_rounds(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 7, 59), 3, 0.335)], "ts timestamp, q int, p double")
    row = df.withColumns(hour_bucket(F.col("ts"))).withColumn("t", line_total(F.col("q"), F.col("p"))).first()
    assert (row.year, row.month, row.day, row.hour) == ("2024", "03", "05", "07")
    assert row.t == pytest.approx(1.0, abs=0.011)


def test_schema_file_becomes_a_struct(spark, tmp_path):
    path = tmp_path / "record.json"
    path.write_text(ORDER_SCHEMA_JSON)
    assert struct_from_record(load_record_schema(spark, str(path))) == EVENT


@pytest.mark.parametrize("bad", ['{"type": "string"}', '{"type":"record","name":"r","fields":'
                                 '[{"name":"x","type":["null","string"]}]}'])
def test_unsupported_schema_is_refused_on_the_driver(bad):
    with pytest.raises(ValueError):
        struct_from_record(bad)


def zigzag(value: int) -> bytes:
    """Brute-force variable-length integer, one byte at a time."""
    raw = (value << 1) ^ (value >> 63)
    raw &= (1 << 64) - 1
    out = bytearray()
    while raw > 0x7F:
        out.append((raw & 0x7F) | 0x80)
        raw >>= 7
    out.append(raw)
    return bytes(out)


INTEGERS = [0, -1, 1, 63, 64, -64, -65, 2**31 - 1, -2**31, 2**62, 2**63 - 1, -2**63]


def test_varints_match_brute_force_both_ways():
    expected = [zigzag(v) for v in INTEGERS]
    assert _varints(np.array(INTEGERS)).to_pylist() == expected
    data = np.frombuffer(b"".join(expected), np.uint8)
    ends = np.cumsum([len(e) for e in expected])
    cursor = _Cursor(data, ends - [len(e) for e in expected], ends)
    assert cursor.varint().tolist() == INTEGERS and not cursor.bad.any()
    assert (cursor.pos == ends).all()


SMALL_SCHEMA = ('{"type":"record","name":"r","fields":[{"name":"s","type":"string"},'
                '{"name":"e","type":{"type":"enum","name":"E","symbols":["X","Y"]}},'
                '{"name":"i","type":"int"},{"name":"l","type":"long"},{"name":"d","type":"double"}]}')


def small(s: bytes = b"h\xc3\xa9", e=1, i=-7, l=2**40, d=-2.5) -> bytes:
    return zigzag(len(s)) + s + zigzag(e) + zigzag(i) + zigzag(l) + struct.pack("<d", d)


GOOD = {"s": "hé", "e": "Y", "i": -7, "l": 2**40, "d": -2.5}
MALFORMED = {
    "empty": b"",
    "cut short": small()[:-1],
    "string past the end": zigzag(500) + b"abc",
    "negative length": zigzag(-2) + b"abc",
    "unknown symbol": small(e=2),
    "negative symbol": small(e=-1),
    "int too wide": small(i=2**31),
    "endless varint": b"\xff" * 20,
}


@pytest.mark.parametrize("name", MALFORMED)
def test_malformed_records(name):
    fields = record_fields(SMALL_SCHEMA)
    batch = pa.array([small(), None, MALFORMED[name], small()], pa.binary())
    assert decode_batch(batch, fields, False).to_pylist() == [GOOD, None, None, GOOD]
    with pytest.raises(ValueError, match="malformed"):
        decode_batch(batch, fields, True)


def test_batches_with_offsets_nulls_and_nothing():
    fields = record_fields(SMALL_SCHEMA)
    batch = pa.array([b"junk", small(), None, small(s=b"")], pa.binary())
    assert decode_batch(batch.slice(1), fields, True).to_pylist() == [GOOD, None, {**GOOD, "s": ""}]
    assert decode_batch(batch.slice(4), fields, True).to_pylist() == []
    assert decode_batch(pa.array([], pa.binary()), fields, True).to_pylist() == []
    assert decode_batch(pa.array([None], pa.binary()), fields, True).to_pylist() == [None]
    large = batch.slice(1).cast(pa.large_binary())
    assert decode_batch(large, fields, True).to_pylist()[0] == GOOD


def test_trailing_bytes_are_ignored():
    batch = pa.array([small() + b"more"], pa.binary())
    assert decode_batch(batch, record_fields(SMALL_SCHEMA), True).to_pylist() == [GOOD]


def test_decode_column_modes(spark, events):
    good = events({}, {"order_id": "ü" * 100}).select(
        "*", encode_record(F.struct(*EVENT_COLUMNS)).alias("payload"))
    decoded = good.select("order_id", decode_record(F.col("payload"), ORDER_SCHEMA_JSON).alias("r"))
    rows = {r.order_id: r.r.asDict() for r in decoded.collect()}
    assert rows["A"] == DEFAULTS and rows["ü" * 100]["order_id"] == "ü" * 100

    bad = spark.createDataFrame([(b"\x02",)], "payload binary")
    lenient = decode_record(F.col("payload"), ORDER_SCHEMA_JSON, "PERMISSIVE").alias("r")
    assert bad.select(lenient).select("r.*").first().order_id is None
    with pytest.raises(Exception, match="malformed"):
        bad.select(decode_record(F.col("payload"), ORDER_SCHEMA_JSON)).collect()
    with pytest.raises(ValueError):
        decode_record(F.col("payload"), ORDER_SCHEMA_JSON, "DROPMALFORMED")


def test_filter_does_not_repeat_the_decode(spark):
    if spark_avro_loaded(spark):
        pytest.skip("the JVM decoder is in use")
    df = spark.createDataFrame([(b"\x02",)], "payload binary")
    decoded = df.select(decode_record(F.col("payload"), ORDER_SCHEMA_JSON).alias("r")).select("r.*")
    plan = decoded.filter("quantity > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("decode(") <= 2  # the evaluation and the name it binds
