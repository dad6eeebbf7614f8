"""The message topic as a stream of Kafka rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingotflow.schemas import KAFKA_ROW
from ingotflow.sources.landing import ANY_AGE

MAX_OFFSETS_PER_TRIGGER = 10_000


def topic_options(servers: str, topic: str,
                  max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str,
               max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Subscribe to a topic from its start; needs Spark's Kafka module on the classpath."""
    return (spark.readStream.format("kafka")
            .options(**topic_options(servers, topic, max_offsets)).load())


def write_topic_files(df: DataFrame, path: str, offsets_per_file: int) -> None:
    """Append topic rows as files that each hold a run of at most ``offsets_per_file`` offsets of a partition.

    Rows go by ranges of partition and offset, so a large partition spreads over the tasks.
    """
    ranges = F.floor(F.col("offset") / offsets_per_file)
    (df.withColumn("_range", ranges).repartitionByRange("partition", "_range", "offset")
     .sortWithinPartitions("partition", "offset").drop("_range")
     .write.mode("append").option("maxRecordsPerFile", offsets_per_file).parquet(path))


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None,
                     max_bytes: int | None = None, max_file_age: str = ANY_AGE,
                     max_offsets: int | None = None, offsets_per_file: int | None = None) -> DataFrame:
    """The same rows from Parquet files of the topic's seven columns, new files as they appear.

    ``max_offsets`` limits a micro-batch to so many rows, as ``maxOffsetsPerTrigger`` does for a topic, if
    no file holds more than ``offsets_per_file`` (see ``write_topic_files``); ``max_files`` or ``max_bytes``
    limit it directly. Vanished files are tolerated as ``failOnDataLoss=false`` tolerates vanished offsets.
    ``max_file_age`` is that of ``read_landing_stream``: by default no file is too old.
    """
    if max_offsets is not None:
        if max_files is not None or offsets_per_file is None or not 0 < offsets_per_file <= max_offsets:
            raise ValueError("a limit in offsets needs files of at most as many, and no limit in files")
        max_files = max_offsets // offsets_per_file
    reader = (spark.readStream.schema(KAFKA_ROW).option("ignoreMissingFiles", "true")
              .option("maxFileAge", max_file_age))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
