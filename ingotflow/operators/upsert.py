"""Event-time upsert: newer source rows replace, unknown keys insert, everything else stays.

``merge_latest`` is the whole operator as one join. ``changed_rows`` gives only the source rows
that will be written, which lets a snapshot table rewrite just the partitions that lose a row.
Both expect a source with one row per key, as ``latest_per_key`` gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHED = "_matched"
OLD_PARTITION = "_old_partition"


def is_newer(source_time: Column, target_time: Column) -> Column:
    """Strictly newer; equal times and a NULL on either side are not."""
    return F.coalesce(source_time > target_time, F.lit(False))


def merge_latest(target: DataFrame, source: DataFrame, key: str = "order_id",
                 timestamp: str = "order_timestamp") -> DataFrame:
    """The target after the upsert. NULL keys match nothing, so such source rows are inserted."""
    require_same_columns(target, source)
    old = target.select(F.col(key).alias("_tk"), F.struct("*").alias("_t"))
    new = source.select(F.col(key).alias("_sk"), F.struct(*target.columns).alias("_s"))
    joined = old.join(new, F.col("_tk") == F.col("_sk"), "full_outer")
    take_source = F.col("_t").isNull() | (
        F.col("_s").isNotNull() & is_newer(F.col("_s")[timestamp], F.col("_t")[timestamp]))
    return joined.select(
        F.when(take_source, F.col("_s")).otherwise(F.col("_t")).alias("_row")).select("_row.*")


def changed_rows(target: DataFrame, source: DataFrame, partition: str, key: str = "order_id",
                 timestamp: str = "order_timestamp", source_is_small: bool = False,
                 buckets: int | None = None) -> DataFrame:
    """Source rows that insert or update, each with ``_matched`` and the old row's partition.

    Only three target columns are read. With ``source_is_small`` the target keys are first reduced
    by a semi join, which Spark broadcasts when the source's measured size allows it and shuffles
    otherwise; the source is then read twice, so it should be a written table. ``buckets`` says that the
    target is bucketed by key into so many: the source is dealt out likewise, and the target stays in place.
    """
    known = target.select(key, F.col(timestamp).alias("_old_time"),
                          F.col(partition).alias(OLD_PARTITION), F.lit(True).alias(MATCHED))
    if buckets:
        source = source.repartition(buckets, key)
    elif source_is_small:
        known = known.join(source.select(key), key, "left_semi")
    known = known.withColumnRenamed(key, "_old_key")
    joined = source.join(known, F.col(key) == F.col("_old_key"), "left")
    wins = F.col(MATCHED).isNull() | is_newer(F.col(timestamp), F.col("_old_time"))
    return joined.filter(wins).select(
        *source.columns, F.coalesce(F.col(MATCHED), F.lit(False)).alias(MATCHED), OLD_PARTITION)


def require_same_columns(target: DataFrame, source: DataFrame) -> None:
    if set(target.columns) != set(source.columns):
        raise ValueError(f"source and target columns differ: "
                         f"{sorted(set(target.columns) ^ set(source.columns))}")


def merge_statement(target: str, source: str, columns: list[str], key: str = "order_id",
                    timestamp: str = "order_timestamp") -> str:
    """The same upsert as ``MERGE INTO``, for catalogs whose tables support it."""
    assignments = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (f"MERGE INTO {target} AS t USING {source} AS s ON t.`{key}` = s.`{key}` "
            f"WHEN MATCHED AND s.`{timestamp}` > t.`{timestamp}` THEN UPDATE SET {assignments} "
            f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")
