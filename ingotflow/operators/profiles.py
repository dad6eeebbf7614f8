"""Inspection queries over the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def revenue_by_currency(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("order_date", "currency")
            .agg(F.sum("total_amount").alias("revenue"))
            .orderBy(F.desc("order_date")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def span(df: DataFrame, column: str) -> DataFrame:
    """Row count and the range of one column: ``ingestion_date``, ``_ingested_at``, ``order_date``."""
    return df.agg(F.count("*").alias("row_count"), F.min(column).alias("first"),
                  F.max(column).alias("last"))


def uniqueness(silver: DataFrame, key: str = "order_id") -> DataFrame:
    """Row count beside distinct keys: equal when the dedup holds."""
    return silver.agg(F.count("*").alias("row_count"),
                      F.count_distinct(F.col(key)).alias("distinct_keys"))


def preview(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """The first ``rows`` rows; with ``order`` a top-k, without it any rows."""
    return (df.orderBy(*order) if order else df).limit(rows)
