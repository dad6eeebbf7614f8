"""The keys of a snapshot table, bucketed, so that a merge moves only its source.

For each key the event time and the partition of its row, in a catalog table bucketed by key. A merge adds the
keys it changed; the row of the newest snapshot holds. Buckets are as wide as the join needs them, so neither
finding that row nor joining a source to it shuffles the table. Every addition has an id that the snapshot
names, so additions of a merge that failed are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingotflow import storage

#: Additions after which the table is written anew, without the rows that newer ones replaced.
ADDITIONS = 16
VERSION, ADDITION = "_version", "_addition"


@dataclass(frozen=True)
class Keys:
    """What a snapshot records of its keys."""

    table: str  # folder below the snapshot table's root, and name in the catalog
    buckets: int
    additions: tuple[str, ...]


class KeyTable:
    """The bucketed keys of the snapshot table at ``root``: ``key, timestamp, partition``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, timestamp: str,
                 partition: str) -> None:
        self.spark, self.root, self.key = spark, root, key
        self.columns = [key, timestamp, partition]
        self.ddl = T.StructType([schema[c] for c in self.columns] + [
            T.StructField(VERSION, T.LongType()), T.StructField(ADDITION, T.StringType())]).toDDL()

    def create(self, buckets: int) -> Keys:
        return Keys(f"keys_{uuid.uuid4().hex}", buckets, ())

    def _open(self, keys: Keys) -> None:
        """Name the folder in this session's catalog."""
        if not self.spark.catalog.tableExists(keys.table):
            self.spark.sql(f"CREATE TABLE {keys.table} ({self.ddl}) USING parquet "
                           f"CLUSTERED BY (`{self.key}`) INTO {keys.buckets} BUCKETS "
                           f"LOCATION '{self.root}/{keys.table}'")

    def read(self, keys: Keys) -> DataFrame:
        """The newest row of each key. No shuffle: the buckets are the groups."""
        self._open(keys)
        rows = self.spark.table(keys.table).where(F.col(ADDITION).isin(*keys.additions))
        others = self.columns[1:]
        return (rows.groupBy(self.key).agg(F.max_by(F.struct(*others), VERSION).alias("_row"))
                .select(self.key, *(F.col(f"_row.{c}").alias(c) for c in others)))

    def add(self, keys: Keys, rows: DataFrame, version: int) -> Keys:
        """The keys with those of ``rows`` added; NULL keys match nothing and are left out."""
        self._open(keys)
        addition = uuid.uuid4().hex
        (rows.where(F.col(self.key).isNotNull())
         .select(*self.columns, F.lit(version).cast("bigint").alias(VERSION), F.lit(addition).alias(ADDITION))
         .repartition(keys.buckets, self.key).write.insertInto(keys.table))
        return replace(keys, additions=(*keys.additions, addition))

    def rewritten(self, keys: Keys, version: int) -> Keys:
        """The same keys in a new table, without the rows that newer ones replaced."""
        return self.add(self.create(keys.buckets), self.read(keys), version)

    def drop(self, keys: Keys) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {keys.table}")
        storage.delete_tree(self.spark, f"{self.root}/{keys.table}")
