"""The composite pipelines between layers."""

from __future__ import annotations

import logging
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ingotflow import storage
from ingotflow.operators.dedup import latest_per_key
from ingotflow.operators.enrich import (
    add_file_metadata,
    add_stream_metadata,
    cast_and_derive,
    parse_messages,
    select_file_columns,
    select_stream_columns,
)
from ingotflow.operators.gold import gold_models
from ingotflow.operators.places import BITS, FILE, ROW, files_of, has_places, marks, taken, with_places
from ingotflow.operators.quality import validate
from ingotflow.operators.upsert import MATCHED, is_newer, merge_statement, require_same_columns
from ingotflow.schemas import EVENT_COLUMNS, ORDER_SCHEMA_JSON
from ingotflow.session import setting
from ingotflow.sinks.bronze import append_bronze, compact_bronze
from ingotflow.sinks.catalog import create_databases, register_silver
from ingotflow.sinks.gold import build_table
from ingotflow.snapshots import SMALL_FILE_BYTES, MergeResult, SnapshotTable
from ingotflow.sources.landing import ANY_AGE, read_landing, read_landing_stream
from ingotflow.sources.tables import (
    read_bronze_file,
    read_bronze_stream,
    read_named,
    silver_table,
)
from ingotflow.streaming.sinks import (
    FLUSH_ROWS,
    run_to_end,
    start_bronze,
    start_landing,
)

logger = logging.getLogger(__name__)

KEY = "order_id"
TIMESTAMP = "order_timestamp"
COMPACT_EVERY = 100
#: Table formats whose tables Spark merges into by row. Fixed values.
MERGE_FORMATS = frozenset(["delta", "hudi", "iceberg", "paimon"])
SILVER_TABLE = "silver.orders"
#: Bytes of bronze from which a silver run moves keys and places of rows instead of the rows.
LARGE_BYTES = 32 * 1024 * 1024
#: Where nothing changes, adaptive execution would leave out the step that counts.
EXCLUDED_RULES = "spark.sql.adaptive.optimizer.excludedRules"
KEEP_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
#: Kinds of places: the only newest row of a key, one of several, the first of these, a row of silver to replace.
KIND, SOLE, TIED, FIRST, LOST = "_kind", 0, 1, 2, 3


def topic_to_landing(messages: DataFrame, landing: str, checkpoint: str,
                     schema_json: str = ORDER_SCHEMA_JSON, processing_time: str | None = None,
                     max_records_per_file: int = FLUSH_ROWS,
                     optimize_write: bool = True) -> StreamingQuery:
    """Decode a stream of topic rows and land it by the hour."""
    parsed = parse_messages(messages, schema_json)
    return run_to_end(start_landing(
        parsed, landing, checkpoint, processing_time, max_records_per_file, optimize_write))


def topic_to_bronze(messages: DataFrame, bronze: str, checkpoint: str,
                    schema_json: str = ORDER_SCHEMA_JSON, processing_time: str | None = None,
                    optimize_write: bool = True, compact_every: int | None = COMPACT_EVERY
                    ) -> StreamingQuery:
    """Decode a stream of topic rows into bronze; reruns take only what is new.

    The small files of settled micro-batches are joined after every ``compact_every`` of them, and
    when the query ends; not at all if it is none.
    """
    records = add_stream_metadata(parse_messages(messages, schema_json))
    query = run_to_end(start_bronze(records, bronze, checkpoint, processing_time, optimize_write, compact_every))
    if compact_every:
        compact_bronze(messages.sparkSession, bronze, schema=records.schema)
    return query


def landing_to_bronze(spark: SparkSession, landing: str, bronze: str,
                      batch_id: str | None = None, compact: bool = True) -> str:
    """Append every landed file to bronze again, then compact. Returns the batch id.

    What would be compacted at once is written by as few tasks in the first place, if these are not fewer
    than the task slots.
    """
    batch_id = batch_id or str(uuid.uuid4())
    tasks = storage.size_of(spark, landing) // SMALL_FILE_BYTES if compact else 0
    append_bronze(add_file_metadata(read_landing(spark, landing), batch_id), bronze,
                  tasks=tasks if tasks >= spark.sparkContext.defaultParallelism else None)
    if compact:
        compact_bronze(spark, bronze)
    return batch_id


def new_landing_to_bronze(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                          batch_id: str | None = None, max_bytes: int | None = None,
                          compact: bool = True, max_file_age: str = ANY_AGE) -> str:
    """Append only the files landed since the checkpoint's last run, each of them once.

    Each micro-batch has a directory of its own, which a batch that is run again replaces.
    ``max_bytes`` limits a micro-batch; a first run over a long backlog should set it.
    """
    batch_id = batch_id or str(uuid.uuid4())
    files = read_landing_stream(spark, landing, max_bytes=max_bytes, max_file_age=max_file_age)
    landed = add_file_metadata(files, batch_id)
    run_to_end(start_bronze(landed, bronze, checkpoint, optimize_write=False))
    if compact:
        compact_bronze(spark, bronze, schema=landed.schema)
    return batch_id


def tie_breakers(*metadata: Column) -> list[Column]:
    """An order for records of one key and time: by content, then by ingest metadata.

    Copies that differ in metadata alone resolve to the earliest ingest, so replays change nothing.
    """
    content = [F.col(c).desc() for c in EVENT_COLUMNS if c not in (KEY, TIMESTAMP)]
    return [*content, *metadata]


@dataclass(frozen=True)
class Profile:
    """What differs between the two ways into bronze."""

    read: Callable[..., DataFrame]
    select: Callable[[DataFrame], DataFrame]
    ties: tuple[str, ...]


FILE_PROFILE = Profile(read_bronze_file, select_file_columns,
                       ("_ingested_at", "_source_file", "_batch_id"))
STREAM_PROFILE = Profile(read_bronze_stream, select_stream_columns,
                         ("_kafka_timestamp", "_kafka_partition", "_kafka_offset", "_ingested_at"))
PROFILES = {"file": FILE_PROFILE, "stream": STREAM_PROFILE}


@dataclass(frozen=True)
class SilverRun:
    """What a silver run did. The row counts come from the one pass over bronze; they are log
    figures and may count rows again that a lost executor made Spark recompute."""

    rows_read: int | None  # only counted on request
    rows_valid: int | None  # these three are none if a catalog table's own MERGE did it
    rows_latest: int | None
    merge: MergeResult | None


def merge_into(rows: DataFrame, table: str) -> None:
    """Upsert into a catalog table whose format supports ``MERGE``; creates no table."""
    view = f"silver_rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        rows.sparkSession.sql(merge_statement(table, view, rows.columns, KEY, TIMESTAMP))
    finally:
        rows.sparkSession.catalog.dropTempView(view)


def has_merge(spark: SparkSession, table: str) -> bool:
    """Whether a catalog table's format has a ``MERGE`` of its own."""
    if not spark.catalog.tableExists(table):
        return False
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first()
    return described is not None and described["data_type"].lower() in MERGE_FORMATS


def _merge_snapshot(table: SnapshotTable, rows: DataFrame, counts: dict[str, Observation],
                    compact: bool, source_is_small: bool, key_buckets: int | None) -> MergeResult:
    if table.exists():
        merged = table.merge(rows, KEY, TIMESTAMP, source_is_small, key_buckets)
    else:
        created = table.overwrite(rows, unique_key=KEY)
        merged = MergeResult(created.version, 0, counts["latest"].get["rows"])
    if compact:
        table.compact()
    return merged


def _holds_keys_once(table: SnapshotTable) -> bool:
    """Whether each key has one row at most, and no bucketed keys are kept beside."""
    if not table.exists():
        return True
    snapshot = table.snapshot()
    return snapshot.unique_key == KEY and snapshot.keys is None


def _changed_places(rows: DataFrame, target: DataFrame | None,
                    observe: Callable[..., DataFrame]) -> DataFrame:
    """Where the valid ``rows`` lie that insert or update, and the rows of ``target`` that they replace."""
    by_key = Window.partitionBy(KEY)
    newest_first = by_key.orderBy(F.col(TIMESTAMP).desc())
    newest = (rows.select(KEY, TIMESTAMP, FILE, ROW)
              .withColumns({"_rank": F.rank().over(newest_first), "_number": F.row_number().over(newest_first)})
              .filter(F.col("_rank") == 1)
              .withColumn("_tied", F.count(F.lit(1)).over(by_key) > 1))
    is_first = F.col("_number") == 1
    newest = observe("latest", newest, F.when(is_first, 1))

    def place(kind: int, condition: Column, file: str = FILE, row: str = ROW) -> Column:
        return F.when(condition, F.struct(
            F.lit(kind).alias(KIND), F.col(file).alias(FILE), F.col(row).alias(ROW)))

    found = [place(SOLE, ~F.col("_tied")), place(TIED, F.col("_tied")), place(FIRST, F.col("_tied") & is_first)]
    if target is not None:
        known = with_places(target).select(
            F.col(KEY).alias("_old_key"), F.col(TIMESTAMP).alias("_old_time"), F.col(FILE).alias("_old_file"),
            F.col(ROW).alias("_old_row"), F.lit(True).alias(MATCHED))
        joined = newest.join(known, F.col(KEY) == F.col("_old_key"), "left")
        newest = joined.filter(F.col(MATCHED).isNull() | is_newer(F.col(TIMESTAMP), F.col("_old_time")))
        found.append(place(LOST, is_first & F.col(MATCHED), "_old_file", "_old_row"))
    return newest.select(F.explode(F.array_compact(F.array(*found))).alias("_place")).select("_place.*")


def _merge_by_places(table: SnapshotTable, bronze: DataFrame, profile: Profile,
                     observe: Callable[..., DataFrame]) -> MergeResult | None:
    """The merge of ``silver_rows``, by moving keys and places; none if the rows have no places.

    Only rows that tie for the newest of their key move as a whole, to be told apart by content.
    """
    spark, current = table.spark, table.snapshot() if table.exists() else None
    target = table.read() if current else None
    scans = [df for df in (bronze, target) if df is not None]
    if not all(map(has_places, scans)) or None in (files := [files_of(df) for df in scans]):
        return None
    schema = profile.select(cast_and_derive(bronze)).schema
    if target is not None:
        require_same_columns(target, spark.createDataFrame([], schema))
    scratch = f"{table.root}/staging/merge-{uuid.uuid4().hex}"
    try:
        rows = observe("valid", validate(observe("read", cast_and_derive(with_places(bronze)))))
        with setting(spark, EXCLUDED_RULES, KEEP_EMPTY):
            marked = storage.stage(marks(_changed_places(rows, target, observe), KIND), f"{scratch}/marks")
        chunks, places = defaultdict(dict), defaultdict(int)
        for kind, file, held, count in marked.groupBy(KIND, FILE).agg(
                F.count("*"), F.sum(F.bitmap_count(BITS))).collect():
            chunks[kind][file] = held
            places[kind] += count
        lost = {files[1][file].split("/")[-2] for file in chunks[LOST]}

        def rows_of(kind: int) -> Iterator[DataFrame]:
            return taken(bronze, marked.where(F.col(KIND) == kind), chunks[kind], files[0])

        def frames() -> Iterator[DataFrame]:
            for part in rows_of(SOLE):
                yield profile.select(cast_and_derive(part))
            for part in rows_of(TIED):
                part.write.mode("append").parquet(f"{scratch}/tied")
            if chunks[TIED]:
                tied = spark.read.schema(bronze.schema).parquet(f"{scratch}/tied")
                yield silver_rows(tied, profile)
            if lost:
                losing = {file: path for file, path in files[1].items() if path.split("/")[-2] in lost}
                yield from taken(table.read_partitions(lost), marked.where(F.col(KIND) == LOST), chunks[LOST],
                                 losing, others=True)

        taken_in = table.take_in(frames(), schema, KEY, lost)
        return MergeResult(taken_in.version, places[LOST], places[SOLE] + places[FIRST] - places[LOST])
    finally:
        storage.delete_tree(spark, scratch)


def silver_rows(bronze: DataFrame, profile: Profile,
                observe: Callable[..., DataFrame] = lambda name, df: df) -> DataFrame:
    """Bronze to silver rows: cast, validate, then dedup, so invalid records shadow nothing."""
    typed = observe("read", cast_and_derive(bronze))
    valid = observe("valid", validate(typed))
    ties = tie_breakers(*[F.col(c).asc() for c in profile.ties])
    return profile.select(observe("latest", latest_per_key(valid, ties, KEY, TIMESTAMP)))


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, profile: str = "file",
                     since: date | None = None, compact: bool = True,
                     source_is_small: bool = False, count_read: bool = False,
                     table: str | None = None, key_buckets: int | None = None) -> SilverRun:
    """Upsert bronze into silver; the first run creates it.

    ``since`` reads only bronze partitions from that ingestion date on. ``source_is_small`` says that
    the run's rows are few next to the table's: they are staged, and the target's keys reduced to theirs
    before joining. ``count_read`` also counts the rows read, which keeps the validity filter from
    being pushed into the scan. ``table`` names a catalog table whose format supports ``MERGE``; it is
    then merged into instead of the snapshots below ``silver``, and nothing is counted. So is, unasked,
    ``SILVER_TABLE`` if it has such a format. ``key_buckets`` keeps the snapshots' keys bucketed, so
    that merges shuffle only their source.
    """
    if table is None and has_merge(spark, SILVER_TABLE):
        table = SILVER_TABLE
    shape = PROFILES[profile]
    counts: dict[str, Observation] = {}

    def observe(name: str, df: DataFrame, counted: Column = F.lit(1)) -> DataFrame:
        if table is not None or name == "read" and not count_read:
            return df
        counts[name] = Observation()
        return df.observe(counts[name], F.count(counted).alias("rows"))

    read, snapshots, merged = shape.read(spark, bronze, since=since), silver_table(spark, silver), None
    if table is not None:
        merge_into(silver_rows(read, shape), table)
    else:
        by_places = (storage.size_of(spark, bronze) >= LARGE_BYTES and not source_is_small and not key_buckets
                     and _holds_keys_once(snapshots))
        if by_places and (merged := _merge_by_places(snapshots, read, shape, observe)) and compact:
            snapshots.compact()
        if merged is None:
            merged = _merge_snapshot(snapshots, silver_rows(read, shape, observe), counts, compact,
                                     source_is_small, key_buckets)
    run = SilverRun(*(counts[n].get["rows"] if n in counts else None
                      for n in ("read", "valid", "latest")), merged)
    logger.info("silver: %s", run)
    return run


def silver_to_gold(spark: SparkSession, silver: str, gold_root: str,
                   silver_db: str = "silver", gold_db: str = "gold") -> list[str]:
    """Register silver, then rebuild every gold model as a table. Returns the table names."""
    create_databases(spark, silver_db, gold_db)
    register_silver(spark, silver, f"{silver_db}.orders")
    unique = silver_table(spark, silver).snapshot().unique_key == KEY
    orders = read_named(spark, silver_db, "orders")
    models = gold_models(keys_are_unique=unique)
    for name, model in models.items():
        build_table(model(orders), gold_db, name, f"{gold_root}/{name}")
    return [f"{gold_db}.{name}" for name in models]
