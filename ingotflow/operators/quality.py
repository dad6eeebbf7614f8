"""Validity filter, enum-domain check, and their counts, each in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingotflow.schemas import CURRENCIES, ORDER_STATUSES


def is_valid() -> Column:
    """NULL amounts or quantities are not valid; NaN amounts are (NaN sorts above every number)."""
    return (F.col("total_amount") > 0) & (F.col("quantity") > 0)


def validate(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def validity_counts(df: DataFrame) -> DataFrame:
    """One row: rows before the filter, after it, and dropped by it."""
    before, after = F.count("*"), F.count_if(is_valid())
    return df.agg(before.alias("rows_before"), after.alias("rows_after"),
                  (before - after).alias("rows_dropped"))


def dedup_counts(df: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: rows before ``latest_per_key``, after it, and removed by it.

    Counts distinct keys of the one narrow column instead of running the dedup; all rows with a
    NULL key count as one key, as they do there.
    """
    before = F.count("*")
    after = F.count_distinct(F.col(key)) + F.max(F.col(key).isNull().cast("int"))
    totals = df.agg(before.alias("rows_before"),
                    F.coalesce(after, F.lit(0)).cast("bigint").alias("rows_after"))
    return totals.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def domain_violations(df: DataFrame) -> DataFrame:
    """One row: rows whose status or currency lies outside its enum. NULL is outside."""
    def outside(name: str, symbols: list[str]) -> Column:
        return F.count_if(~F.coalesce(F.col(name).isin(symbols), F.lit(False)))

    return df.agg(F.count("*").alias("rows_checked"),
                  outside("order_status", ORDER_STATUSES).alias("bad_status"),
                  outside("currency", CURRENCIES).alias("bad_currency"))
