"""Micro-batches as directories by date, and their compaction.

Layout below a root::

    ingestion_date=<date>/gen=<query id>/batch=<number>/part-*.parquet          one micro-batch
    ingestion_date=<date>/gen=<query id>/batch=<first>-<last>/part-*.parquet    several, compacted

The date comes first, so a read from some date on lists no older directory. The query id lives in the
stream's checkpoint: a restarted query replaces the directory of a batch that it runs again, one with a fresh
checkpoint has directories of its own, so a full replay appends.

A compacted directory names the batches it holds, and whatever it covers is no longer read: it takes their
place the moment it is renamed into place. The directories it covers stay until the next compaction, for
readers that began on them. Only settled batches are compacted: a query begins a batch after the one before
is committed, so all but its newest will not be run again.

Older tables have ``gen=<query id>/batch=<number>/ingestion_date=<date>``; these are read too.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingotflow import storage
from ingotflow.session import setting
from ingotflow.snapshots import ALONE_BYTES, ALONE_JOBS, CODEC, MAX_OPEN_FILES, OPEN_FILES

INGESTION_DATE = "ingestion_date"
GENERATION = "gen"
BATCH = "batch"
DRAFT = "_compact-"
SMALL_BYTES = 64 * 1024 * 1024
#: Estimated bytes from which a micro-batch is written by the tasks that read it; ``SMALL_BYTES`` bounds their splits.
LARGE_BATCH_BYTES = 8 * 1024 * 1024


class Piece(NamedTuple):
    """A directory of one batch, or of several compacted ones."""

    date: str
    generation: str
    first: int
    last: int

    @property
    def batch(self) -> str:
        return str(self.first) if self.first == self.last else f"{self.first}-{self.last}"

    @property
    def directory(self) -> str:
        return f"{INGESTION_DATE}={self.date}/{GENERATION}={self.generation}/{BATCH}={self.batch}"

    def covers(self, other: Piece) -> bool:
        return (self != other and self[:2] == other[:2]
                and self.first <= other.first and other.last <= self.last)


def write_batch_by_date(df: DataFrame, query_id: str, batch_id: int, path: str,
                        optimize_write: bool = True) -> None:
    """Write one micro-batch, in place of any earlier attempt at it.

    ``optimize_write`` lets adaptive execution choose few, evenly sized files, for one shuffle of the batch. A
    batch known to be large is not shuffled: the splits of its scan size its files.
    """
    spark = df.sparkSession
    if storage.exists(spark, f"{path}/{GENERATION}={query_id}/{BATCH}={batch_id}/_SUCCESS"):
        return  # finished, but not committed, in the older layout
    located = df.withColumns({GENERATION: F.lit(query_id), BATCH: F.lit(str(batch_id))})
    rebalance = optimize_write and not is_large(df)
    sized = located.hint("rebalance", INGESTION_DATE) if rebalance else located
    with nullcontext() if rebalance else setting(spark, OPEN_FILES, MAX_OPEN_FILES):
        (sized.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("compression", CODEC)
         .partitionBy(INGESTION_DATE, GENERATION, BATCH)
         .parquet(path))


def is_large(batch: DataFrame) -> bool:
    """Whether the planner knows that a micro-batch is large; of some sources it knows nothing."""
    unknown = batch.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    return LARGE_BATCH_BYTES <= batch._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < unknown


def _values(spark: SparkSession, path: str, column: str) -> list[str]:
    names = storage.list_names(spark, path)
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def list_pieces(spark: SparkSession, path: str, since: date | None = None) -> list[Piece]:
    """All directories; dates before ``since`` are not listed."""
    found = []
    for day in _values(spark, path, INGESTION_DATE):
        if since is not None and not since.isoformat() <= day[:10] <= "9999":
            continue
        for generation in _values(spark, f"{path}/{INGESTION_DATE}={day}", GENERATION):
            for batch in _values(spark, f"{path}/{INGESTION_DATE}={day}/{GENERATION}={generation}", BATCH):
                first, _, last = batch.partition("-")
                found.append(Piece(day, generation, int(first), int(last or first)))
    return found


def has_batches(spark: SparkSession, path: str) -> bool:
    return bool(_values(spark, path, INGESTION_DATE) or _values(spark, path, GENERATION))


def live(pieces: list[Piece]) -> list[Piece]:
    """The directories that no other covers."""
    kept: list[Piece] = []
    for piece in sorted(pieces, key=lambda p: (p.date, p.generation, p.first, -p.last)):
        if not (kept and kept[-1].covers(piece)):
            kept.append(piece)
    return kept


def read_batches(spark: SparkSession, path: str, schema: T.StructType, since: date | None = None) -> DataFrame:
    """The rows of every batch once, or those of the dates from ``since`` on."""
    paths = [f"{path}/{piece.directory}" for piece in live(list_pieces(spark, path, since))]
    older = [f"{path}/{GENERATION}={g}" for g in _values(spark, path, GENERATION)]
    frames = [_scan(spark, path, schema, some) for some in (paths, older) if some]
    if not frames:
        return spark.createDataFrame([], schema)
    df = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return df if since is None else df.filter(F.col(INGESTION_DATE) >= F.lit(since))


def _scan(spark: SparkSession, path: str, schema: T.StructType, paths: list[str],
          located: bool = False) -> DataFrame:
    columns = T.StructType(schema.fields + [T.StructField(GENERATION, T.StringType()),
                                            T.StructField(BATCH, T.StringType())])
    df = spark.read.schema(columns).option("basePath", path).parquet(*paths)
    return df if located else df.select(*schema.names)


def _is_small(spark: SparkSession, path: str, piece: Piece, small_bytes: int) -> bool:
    """Whether a directory, or a micro-batch's average file, is small; compacted files are sized already."""
    directory = f"{path}/{piece.directory}"
    size = storage.size_of(spark, directory)
    return size < small_bytes or (piece.first == piece.last
                                  and size < small_bytes * storage.count_files(spark, directory))


def _runs(spark: SparkSession, path: str, pieces: list[Piece], small_bytes: int) -> list[list[Piece]]:
    """Neighbouring small directories of one date and query, two at least."""
    runs, run = [], []
    for piece in [*pieces, None]:
        if piece is not None and _is_small(spark, path, piece, small_bytes):
            run.append(piece)
            continue
        if len(run) > 1:
            runs.append(run)
        run = []
    return runs


def compact_batches(spark: SparkSession, path: str, schema: T.StructType,
                    small_bytes: int = SMALL_BYTES) -> int:
    """Join small directories, and batches of small files, that are settled; how many directories were replaced.

    Each large one is rewritten in a job of its own, by the splits of its scan; only the smallest share a shuffle
    that sizes their files. A compacted directory large enough is never picked again, so repeated
    runs cost what is new. One compaction at a time; streams may write and readers read meanwhile.
    """
    found = list_pieces(spark, path)
    alive = live(found)
    replaced = [p.directory for p in set(found) - set(alive)]
    for name in [*replaced, *(n for n in storage.list_names(spark, path) if n.startswith(DRAFT))]:
        storage.delete_tree(spark, f"{path}/{name}")

    newest: dict[str, int] = {}
    settled: dict[tuple[str, str], list[Piece]] = defaultdict(list)
    for piece in alive:
        newest[piece.generation] = max(newest.get(piece.generation, -1), piece.last)
    for piece in alive:
        if piece.last < newest[piece.generation] and piece.date[:1].isdigit():
            settled[piece.date, piece.generation].append(piece)
    joined = {Piece(*run[0][:3], run[-1].last): run for pieces in settled.values()
              for run in _runs(spark, path, pieces, small_bytes)}
    if not joined:
        return 0

    draft = f"{path}/{DRAFT}{uuid.uuid4().hex}"
    paths_of = {target: [f"{path}/{p.directory}" for p in run] for target, run in joined.items()}
    bytes_of = {target: sum(storage.size_of(spark, p) for p in paths) for target, paths in paths_of.items()}
    alone = [target for target in joined if bytes_of[target] >= min(ALONE_BYTES, 2 * small_bytes)]
    together = {target: run for target, run in joined.items() if target not in alone}

    def rewrite(target: Piece) -> None:  # its scan's tasks are sized already: each joins many files
        (_scan(spark, path, schema, paths_of[target]).drop(INGESTION_DATE)
         .coalesce(max(1, bytes_of[target] // small_bytes))
         .write.option("compression", CODEC).parquet(f"{draft}/{target.directory}"))

    with ThreadPoolExecutor(ALONE_JOBS) as jobs:
        list(jobs.map(rewrite, alone))
    if together:
        _rewrite_together(spark, path, schema, together, draft)
    for target in joined:
        if storage.exists(spark, f"{draft}/{target.directory}"):  # no rows, no directory
            storage.move(spark, f"{draft}/{target.directory}", f"{path}/{target.directory}")
    storage.delete_tree(spark, draft)
    return sum(map(len, joined.values()))


def _rewrite_together(spark: SparkSession, path: str, schema: T.StructType, joined: dict[Piece, list[Piece]],
                      draft: str) -> None:
    targets = spark.createDataFrame(
        [(date.fromisoformat(p.date), p.generation, p.batch, target.batch)
         for target, run in joined.items() for p in run],
        T.StructType([T.StructField("_date", T.DateType()), T.StructField("_gen", T.StringType()),
                      T.StructField("_batch", T.StringType()), T.StructField("_target", T.StringType())]))
    paths = [f"{path}/{p.directory}" for run in joined.values() for p in run]
    rows = _scan(spark, path, schema, paths, located=True)
    (rows.join(F.broadcast(targets), (F.col(INGESTION_DATE) == F.col("_date")) & (F.col(GENERATION) == F.col("_gen"))
               & (F.col(BATCH) == F.col("_batch")))
     .select(*schema.names, GENERATION, F.col("_target").alias(BATCH))
     .hint("rebalance", INGESTION_DATE, GENERATION, BATCH)
     .write.mode("append").option("compression", CODEC).partitionBy(INGESTION_DATE, GENERATION, BATCH).parquet(draft))
