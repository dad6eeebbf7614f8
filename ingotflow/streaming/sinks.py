"""Stream sinks for the landing and bronze layers.

Bronze has the layout of ``streaming.batches``. In landing each micro-batch has a directory of its own::

    <root>/gen=<query id>/batch=<batch id>/<partition columns>/part-*.parquet

The query id lives in the checkpoint. A restarted query keeps it, so a batch that was begun is written
again in place, and a landed one that was finished is not; a query with a fresh checkpoint has a new one, so a
full replay appends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ingotflow import storage
from ingotflow.functions.columns import HOUR_BUCKET, hour_bucket
from ingotflow.schemas import EVENT_COLUMNS
from ingotflow.session import setting
from ingotflow.streaming.batches import (
    BATCH,
    GENERATION,
    SMALL_BYTES,
    compact_batches,
    write_batch_by_date,
)

FLUSH_ROWS = 10_000
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def current_query_id(df: DataFrame) -> str:
    query_id = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query_id is None:
        raise RuntimeError("a micro-batch is only written inside foreachBatch")
    return query_id


def write_batch(df: DataFrame, batch_id: int, path: str, partition_by: list[str],
                max_records_per_file: int = 0, optimize_write: bool = True) -> None:
    """Write one micro-batch in place of any unfinished attempt at it.

    An attempt that was finished, but not committed by the stream, is left alone: its files may have
    been read already, and a rewrite would bring the same rows under other names.

    ``optimize_write`` lets adaptive execution choose few, evenly sized files, for one shuffle of
    the batch; switch it off when each task already has a file's worth of rows for few partitions.
    """
    target = f"{path}/{GENERATION}={current_query_id(df)}/{BATCH}={batch_id}"
    if storage.exists(df.sparkSession, f"{target}/_SUCCESS"):
        return
    sized = df.hint("rebalance", *partition_by) if optimize_write else df
    (sized.write.mode("overwrite")
     .option("compression", "snappy")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partition_by)
     .parquet(target))


def _start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
           processing_time: str | None) -> StreamingQuery:
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return (df.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_bronze(df: DataFrame, path: str, checkpoint: str, processing_time: str | None = None,
                 optimize_write: bool = True, compact_every: int | None = None) -> StreamingQuery:
    """Append records with ingest metadata to bronze, by ``ingestion_date``.

    Without ``processing_time`` the query takes all available data in rate-limited micro-batches
    and stops. ``compact_every`` joins the small files of settled batches after each so many. With
    ``optimize_write`` a task reads at most ``SMALL_BYTES`` of files, since large batches are not shuffled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_by_date(batch, current_query_id(batch), batch_id, path, optimize_write)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_batches(batch.sparkSession, path, batch.schema)

    spark = df.sparkSession
    if not optimize_write:
        return _start(df, write, checkpoint, processing_time)
    # the query keeps the settings it starts with
    with setting(spark, SPLIT_BYTES, min(SMALL_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())):
        return _start(df, write, checkpoint, processing_time)


def with_hour_bucket(df: DataFrame, timestamp: str = "_kafka_timestamp") -> DataFrame:
    return df.withColumns(hour_bucket(F.col(timestamp)))


def start_landing(df: DataFrame, path: str, checkpoint: str, processing_time: str | None = None,
                  max_records_per_file: int = FLUSH_ROWS,
                  optimize_write: bool = True) -> StreamingQuery:
    """Land parsed messages as Snappy Parquet by the hour of the *message* time."""
    landed = with_hour_bucket(df).select(*EVENT_COLUMNS, *HOUR_BUCKET)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, HOUR_BUCKET, max_records_per_file, optimize_write)

    return _start(landed, write, checkpoint, processing_time)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Block until the query stops; its failure is raised here. Interrupts stop it cleanly."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
    return query
