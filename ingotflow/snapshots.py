"""A Parquet table published as numbered snapshots.

Layout below the table's root::

    data/snap_write=<id>/<partition>=<value>/part-*.parquet   every write has its own directory
    snapshots/<number>.json                                    which of them make up a snapshot

A snapshot only names directories, so a new one refers to unchanged partitions instead of copying
them, readers of older ones are undisturbed, and a write that failed is never named. One writer at
a time: the second of two racing publishers fails. Where the cluster has a table format with native
``MERGE``, use that instead (``operators.upsert.merge_statement``).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingotflow import storage
from ingotflow.keys import ADDITIONS, Keys, KeyTable
from ingotflow.operators.upsert import (
    MATCHED,
    OLD_PARTITION,
    changed_rows,
    require_same_columns,
)
from ingotflow.session import setting

WRITE = "snap_write"
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"
SMALL_FILE_BYTES = 64 * 1024 * 1024
#: A partition that holds as many bytes of small files is compacted in a job of its own, without a shuffle;
#: so many of these jobs run at a time.
ALONE_BYTES = 1024 * 1024
ALONE_JOBS = 8
CODEC = "zstd"
#: Files that a task keeps open, so that it need not sort its rows by date.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MAX_OPEN_FILES = 64
#: Table property that says which root's snapshot a numbered table holds.
SNAPSHOT_PROPERTY = "ingotflow.snapshot"


class Piece(NamedTuple):
    """One partition's directory within one write."""

    write: str
    files: int
    bytes: int
    sized: bool  # its files were sized by adaptive execution or by as few tasks


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: T.StructType
    pieces: dict[str, list[Piece]]  # partition directory name -> where its rows lie
    unique_key: str | None = None
    keys: Keys | None = None  # its keys, if merges keep them

    @property
    def fingerprint(self) -> str:
        """Differs for snapshots of other directories, though number and root be the same."""
        held = [[p, *(piece.write for piece in pieces)] for p, pieces in sorted(self.pieces.items())]
        return hashlib.sha256(json.dumps([self.schema.jsonValue(), held]).encode()).hexdigest()


class MergeResult(NamedTuple):
    version: int
    updated: int
    inserted: int


class SnapshotTable:
    """A table partitioned by one date column."""

    def __init__(self, spark: SparkSession, root: str, partition: str) -> None:
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition
        self._data = f"{self.root}/data"

    # -- snapshots ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = storage.list_names(self.spark, f"{self.root}/snapshots")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def exists(self) -> bool:
        """True for a readable snapshot with at least one column."""
        versions = self.versions()
        return bool(versions) and len(self.snapshot(versions[-1]).schema) > 0

    def snapshot(self, version: int | None = None) -> Snapshot:
        if version is None:
            versions = self.versions()
            if not versions:
                raise FileNotFoundError(f"no snapshot below {self.root}")
            version = versions[-1]
        record = json.loads(storage.read_text(self.spark, self._snapshot_path(version)))
        return Snapshot(version, T.StructType.fromJson(record["schema"]),
                        {p: [Piece(*piece) for piece in pieces]
                         for p, pieces in record["pieces"].items()},
                        record["unique_key"], _keys(record.get("keys")))

    def _snapshot_path(self, version: int) -> str:
        return f"{self.root}/snapshots/{version:08d}.json"

    def _publish(self, snapshot: Snapshot) -> Snapshot:
        record = {"schema": snapshot.schema.jsonValue(), "unique_key": snapshot.unique_key,
                  "keys": snapshot.keys and asdict(snapshot.keys),
                  "pieces": {p: pieces for p, pieces in snapshot.pieces.items() if pieces}}
        storage.write_new_text(
            self.spark, self._snapshot_path(snapshot.version), json.dumps(record))
        return snapshot

    # -- reads -------------------------------------------------------------------------------

    def read(self, version: int | None = None, since: date | None = None) -> DataFrame:
        """A snapshot, the newest by default; ``since`` keeps partitions from that date on.

        Partitions before ``since`` are not even listed.
        """
        snapshot = self.snapshot(version)
        wanted = snapshot.pieces
        if since is not None:
            first = f"{self.partition}={since.isoformat()}"
            wanted = {p: pieces for p, pieces in wanted.items()
                      if first <= p and not p.endswith(NULL_VALUE)}
        return self._scan(snapshot.schema, wanted)

    def _scan(self, schema: T.StructType, pieces: dict[str, list[Piece]]) -> DataFrame:
        paths = [self._dir(partition, piece)
                 for partition, found in pieces.items() for piece in found]
        if not paths:
            return self.spark.createDataFrame([], schema)
        with_write = T.StructType(schema.fields + [T.StructField(WRITE, T.StringType())])
        return (self.spark.read.schema(with_write).option("basePath", self._data)
                .parquet(*paths).select(*schema.names))

    def _dir(self, partition: str, piece: Piece) -> str:
        return f"{self._data}/{WRITE}={piece.write}/{partition}"

    # -- writes ------------------------------------------------------------------------------

    def _write(self, df: DataFrame, rebalance: bool = True, sized: bool = False) -> dict[str, Piece]:
        """Write rows to a directory of their own; the pieces they became.

        ``rebalance`` lets adaptive execution size the files per partition and split hot ones,
        for one shuffle of the rows. Without it every task writes its own files; ``sized`` says that the
        tasks are those that a compaction would have.
        """
        write = uuid.uuid4().hex
        rows = df.hint("rebalance", self.partition) if rebalance else df
        target = f"{self._data}/{WRITE}={write}"
        rows.write.option("compression", CODEC).partitionBy(self.partition).parquet(target)
        return {p: Piece(write, *sizes, rebalance or sized)
                for p, sizes in storage.files_and_bytes(self.spark, target).items()}

    def overwrite(self, df: DataFrame, unique_key: str | None = None) -> Snapshot:
        """Replace rows and schema. ``unique_key`` records that ``df`` holds each key once."""
        versions = self.versions()
        written = self._write(df)
        return self._publish(Snapshot(
            versions[-1] + 1 if versions else 0, _nullable(df.schema),
            {p: [piece] for p, piece in written.items()}, unique_key))

    def append(self, df: DataFrame, rebalance: bool = False, sized: bool = False) -> Snapshot:
        """Add rows; creates the table when there is none. ``rebalance`` and ``sized`` are those of ``_write``."""
        versions = self.versions()
        if versions:
            current = self.snapshot(versions[-1])
            require_same_columns(self._scan(current.schema, {}), df)
        else:
            current = Snapshot(-1, _nullable(df.schema), {})
        written = self._write(df.select(*current.schema.names), rebalance, sized)
        return self._publish(replace(
            current, version=current.version + 1, unique_key=None, keys=None,
            pieces=_joined(current.pieces, {p: [piece] for p, piece in written.items()})))

    def take_in(self, frames: Iterable[DataFrame], schema: T.StructType, unique_key: str | None,
                lost: Collection[str] = ()) -> Snapshot:
        """The next snapshot: ``frames`` join it, the partitions ``lost`` leave it; creates the table when there
        is none. Rows are written by the tasks that read them; ``compact`` joins the files.
        """
        current = self.snapshot() if self.exists() else None
        schema = current.schema if current else _nullable(schema)
        versions = self.versions()
        with setting(self.spark, OPEN_FILES, MAX_OPEN_FILES):
            written = [self._write(df.select(*schema.names), rebalance=False) for df in frames]
        rest = {p: found for p, found in current.pieces.items() if p not in lost} if current else {}
        return self._publish(Snapshot(
            versions[-1] + 1 if versions else 0, schema,
            _joined(rest, *({p: [piece] for p, piece in part.items()} for part in written)), unique_key))

    def read_partitions(self, names: Collection[str]) -> DataFrame:
        """The newest snapshot's partitions of these directory names."""
        current = self.snapshot()
        return self._scan(current.schema, {p: current.pieces[p] for p in names})

    def merge(self, source: DataFrame, key: str, timestamp: str, source_is_small: bool = False,
              key_buckets: int | None = None) -> MergeResult:
        """Event-time upsert of ``source`` (one row per key) as the next snapshot.

        Partitions that only gain rows get another directory; only partitions that lose a row to
        an update are rewritten. Every other partition is carried over by name.

        ``key_buckets`` keeps the keys of a key-unique table in so many buckets from now on. This and later
        merges then join the source to these, and the table's own keys are neither read nor shuffled.
        """
        current = self.snapshot()
        target = self._scan(current.schema, current.pieces)
        require_same_columns(target, source)
        source = source.select(*current.schema.names)
        known = KeyTable(self.spark, self.root, current.schema, key, timestamp, self.partition)
        keys = current.keys
        if keys is None and key_buckets and current.unique_key == key:
            keys = known.add(known.create(key_buckets), target, current.version)
        scratch = f"{self.root}/staging/merge-{uuid.uuid4().hex}"
        try:
            if source_is_small:
                source = storage.stage(source, f"{scratch}/source")
            changes = storage.stage(
                changed_rows(known.read(keys) if keys else target, source, self.partition, key, timestamp,
                             source_is_small, keys.buckets if keys else None),
                f"{scratch}/changes")
            losing, updated, inserted, unique = self._summary(changes, key)
            pieces, version = current.pieces, current.version + 1
            if updated or inserted:
                rewritten = {p: pieces[p] for p in losing}
                updated_keys = changes.filter(MATCHED).select(key)
                kept = self._scan(current.schema, rewritten).join(updated_keys, key, "left_anti")
                written = self._write(kept.unionByName(changes.drop(MATCHED, OLD_PARTITION)))
                pieces = _joined({p: found for p, found in pieces.items() if p not in rewritten},
                                 {p: [piece] for p, piece in written.items()})
                if keys and unique:
                    if len(keys.additions) >= ADDITIONS:
                        keys = known.rewritten(keys, current.version)
                    keys = known.add(keys, changes, version)
            published = self._publish(replace(
                current, version=version, pieces=pieces, keys=keys if unique else None,
                unique_key=current.unique_key if unique else None))
            if current.keys and (published.keys is None or published.keys.table != current.keys.table):
                known.drop(current.keys)
            return MergeResult(published.version, updated, inserted)
        finally:
            storage.delete_tree(self.spark, scratch)

    def _summary(self, changes: DataFrame, key: str) -> tuple[list[str], int, int, bool]:
        """Partitions that lose rows, rows updated, rows inserted, and whether the inserted keys, NULL
        apart, are unique. One row per date is collected."""
        per_date = (changes.groupBy(MATCHED, OLD_PARTITION)
                    .agg(F.count("*").alias("rows"), F.count(key).alias("named"),
                         F.count_distinct(key).alias("keys"))
                    .collect())
        matched = [r for r in per_date if r[MATCHED]]
        if any(r["rows"] != r["keys"] for r in matched):
            raise ValueError(f"several source rows update one target row; {key!r} must be unique")
        return ([_partition_name(self.partition, r[OLD_PARTITION]) for r in matched],
                sum(r["rows"] for r in matched),
                sum(r["rows"] for r in per_date if not r[MATCHED]),
                all(r["named"] == r["keys"] for r in per_date))

    def compact(self, small_file_bytes: int = SMALL_FILE_BYTES) -> Snapshot:
        """Same rows, fewer files: rewrite the pieces that are small, or made of small files.

        A piece already sized and large enough is never picked again, so repeated runs cost what
        is new. Partitions are rewritten each in a job of its own, by the splits of its scan; only the smallest
        share a shuffle that sizes their files. Unchanged when there is nothing to gain.
        """
        current = self.snapshot()
        small = {}
        for partition, found in current.pieces.items():
            picked = [p for p in found
                      if p.bytes < small_file_bytes * (1 if p.sized else p.files)]
            if len(picked) > 1 or any(p.files > 1 and not p.sized for p in picked):
                small[partition] = picked
        if not small:
            return current
        bytes_of = {partition: sum(p.bytes for p in picked) for partition, picked in small.items()}
        alone = {p: picked for p, picked in small.items()
                 if bytes_of[p] >= min(ALONE_BYTES, 2 * small_file_bytes)}
        together = {p: picked for p, picked in small.items() if p not in alone}
        written = self._write(self._scan(current.schema, together)) if together else {}
        write = uuid.uuid4().hex

        def rewrite(partition: str) -> None:  # its scan's tasks are sized already: each joins many files
            (self._scan(current.schema, {partition: alone[partition]}).drop(self.partition)
             .coalesce(max(1, bytes_of[partition] // small_file_bytes))
             .write.option("compression", CODEC).parquet(self._dir(partition, Piece(write, 0, 0, True))))

        if alone:
            with ThreadPoolExecutor(ALONE_JOBS) as jobs:
                list(jobs.map(rewrite, alone))
            written |= {p: Piece(write, *sizes, True) for p, sizes in storage.files_and_bytes(
                self.spark, f"{self._data}/{WRITE}={write}").items()}
        rest = {partition: [p for p in found if p not in small.get(partition, [])]
                for partition, found in current.pieces.items()}
        return self._publish(replace(
            current, version=current.version + 1,
            pieces=_joined(rest, {p: [piece] for p, piece in written.items()})))

    # -- catalog -----------------------------------------------------------------------------

    def register(self, name: str, version: int | None = None) -> None:
        """Make a snapshot readable as ``name``, and as ``name_v<n>``.

        The numbered name is an external table holding exactly the snapshot's partitions, so
        queries prune them in the catalog. ``name`` is a view on it that hides the write column.
        A snapshot registered already is not registered again; a numbered name of another table's, or of a
        table that was deleted and built anew, is not taken for it. The numbered name before it stays,
        for queries that began on it; older ones go, their snapshots are still read by version.
        """
        snapshot = self.snapshot(version)
        numbered = f"{name}_v{snapshot.version}"
        if not self._is_registered(snapshot, numbered):
            self._register_numbered(snapshot, numbered)
        listed = ", ".join(f"`{c}`" for c in snapshot.schema.names)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {numbered}")
        database, _, short = name.rpartition(".")
        names = [t.name for t in self.spark.catalog.listTables(database or None, f"{short}_v*")]
        others = sorted((int(number) for n in names if n != numbered.rpartition(".")[2]
                         and (number := n.removeprefix(f"{short}_v")).isdigit()), reverse=True)
        versions = self.versions()
        before = [v for v in others if v in versions and self._is_registered(self.snapshot(v), f"{name}_v{v}")]
        for old in set(others) - set(before[:1]):
            self.spark.sql(f"DROP TABLE {name}_v{old}")

    def _property(self, snapshot: Snapshot) -> str:
        return f"{self.root} {snapshot.fingerprint}"

    def _is_registered(self, snapshot: Snapshot, numbered: str) -> bool:
        if not self.spark.catalog.tableExists(numbered):
            return False
        found = self.spark.sql(f"SHOW TBLPROPERTIES {numbered} ('{SNAPSHOT_PROPERTY}')").first()
        return found["value"] == self._property(snapshot)

    def _register_numbered(self, snapshot: Snapshot, numbered: str) -> None:
        columns = [f for f in snapshot.schema if f.name != self.partition]
        ddl = T.StructType([*columns, T.StructField(WRITE, T.StringType()),
                            snapshot.schema[self.partition]]).toDDL()
        self.spark.sql(f"DROP TABLE IF EXISTS {numbered}")  # external: its files stay
        self.spark.sql(
            f"CREATE TABLE {numbered} ({ddl}) USING parquet "
            f"PARTITIONED BY ({WRITE}, {self.partition}) LOCATION '{self._data}' "
            f"TBLPROPERTIES ('{SNAPSHOT_PROPERTY}' = '{self._property(snapshot)}')")
        specs = [f"PARTITION ({WRITE}='{piece.write}', {_partition_sql(partition)})"
                 for partition, found in snapshot.pieces.items() for piece in found]
        for start in range(0, len(specs), 500):
            self.spark.sql(f"ALTER TABLE {numbered} ADD IF NOT EXISTS "
                           + " ".join(specs[start:start + 500]))


def _keys(record: dict | None) -> Keys | None:
    return Keys(record["table"], record["buckets"], tuple(record["additions"])) if record else None


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _joined(*parts: dict[str, list[Piece]]) -> dict[str, list[Piece]]:
    merged: dict[str, list[Piece]] = {}
    for part in parts:
        for partition, found in part.items():
            merged[partition] = merged.get(partition, []) + list(found)
    return merged


def _partition_name(column: str, value: date | None) -> str:
    return f"{column}={NULL_VALUE if value is None else value.isoformat()}"


def _partition_sql(partition: str) -> str:
    column, value = partition.split("=", 1)
    return f"{column}=null" if value == NULL_VALUE else f"{column}=date'{value}'"


