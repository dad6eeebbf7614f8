"""Small helpers that the operators share."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ingotflow import storage

#: Rows and text bytes that a Python worker holds decoded at once.
SLICE_ROWS, SLICE_BYTES = 1024, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, divisor: int) -> Column:
    """``crc32`` of the column as text, modulo ``divisor``."""
    return F.crc32(F.col(column).cast("string")) % divisor


def bounded_sample(rows: DataFrame, limit: int) -> DataFrame:
    """Up to ``limit`` rows of each ``label``: those of the lowest ``hash``, of equal hashes one.

    ``rows`` has ``label`` (not null) and ``hash`` (64 bits). The number of distinct hashes of a label gives a
    bound that about twice as many stay under, so what a task ranks does not grow with the input. One number
    per label passes the driver.
    """
    sizes = rows.groupBy("label").agg(F.approx_count_distinct("hash").alias("n")).collect()
    if not sizes:
        return rows.limit(0)
    bounds = {r["label"]: min((1 << 64) * 2 * (limit + 20) // max(r["n"], 1), (1 << 64) - 1) - (1 << 63) for r in sizes}
    bound = F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair))
    lowest = Window.partitionBy("label").orderBy("hash")
    return (rows.where(F.col("hash") <= bound[F.col("label")]).dropDuplicates(["label", "hash"])
            .withColumn("_rank", F.row_number().over(lowest)).where(F.col("_rank") <= limit).drop("_rank"))


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded rows and text bytes (one row at least); ``text`` is the column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= SLICE_ROWS or held + size > most):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def map_slices(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], text: int,
               schema: str | StructType, most: int = SLICE_BYTES) -> DataFrame:
    """Map each slice of the frame's Arrow batches; rows stay in their partitions."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, most):
                yield function(part)

    return df.mapInArrow(apply, schema)


def id_cells(ids: pa.Array, bits: int) -> np.ndarray:
    """Which of ``2 ** bits`` cells each id falls into (ids of any type; nulls like an empty text)."""
    if pa.types.is_integer(ids.type):
        values = pc.fill_null(ids, 0).cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64)
        values = (values ^ values >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        return (values ^ values >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
    return np.array([zlib.crc32((t or "").encode()) >> (32 - bits) for t in ids.cast(pa.string()).to_pylist()], np.uint64)


def id_bitmap(ids: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the cells of the frame's only column, as bytes: ``2 ** bits`` bits, whatever the input."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.unique(id_cells(batch.column(0), bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells)], ["cell"])

    words = (ids.mapInArrow(apply, "cell long").groupBy(F.shiftright("cell", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 AS int))")).alias("bits")).toPandas())
    out = np.zeros(1 << bits - 6, np.uint64)
    out[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out.view(np.uint8)


def in_id_bitmap(bitmap: np.ndarray, ids: pa.Array) -> np.ndarray:
    """Whether each id's cell is set: true for every id of the bitmap, and for some others."""
    cells = id_cells(ids, len(bitmap).bit_length() + 2)
    return (bitmap[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which every executor sees.

    A local session without that setting (tests) uses its warehouse; a cluster must set it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "checkpoints")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as Parquet in the shared folder, read again: lineage ends there.

    Safe when executors are lost, since the files are not on them.
    """
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``written``, with the folder, for ``discard`` once nothing reads it any more."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        storage.delete_tree(spark, path)
