"""The gold models, as aggregates over silver, in their declared order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_revenue(silver: DataFrame, keys_are_unique: bool = False) -> DataFrame:
    """Revenue, distinct orders and mean order value by date and currency.

    On a table known to hold each ``order_id`` once (silver after dedup and upsert),
    ``keys_are_unique`` counts keys instead of distinct keys: the same number, but every key no
    longer has to be shuffled, and the shuffle carries one row per task and group.
    The mean is taken from the sum already kept.
    """
    orders = F.count("order_id") if keys_are_unique else F.count_distinct(F.col("order_id"))
    amount = F.col("total_amount")
    mean = F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))
    return (silver.groupBy("order_date", "currency")
            .agg(F.sum(amount).alias("revenue"), orders.alias("order_count"),
                 mean.alias("avg_order_value"))
            .orderBy(F.desc("order_date"), F.desc("revenue")))


def order_status_summary(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("order_date", "order_status")
            .agg(F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"))
            .orderBy(F.desc("order_date"), F.desc("order_count")))


def top_products(silver: DataFrame) -> DataFrame:
    """Every product, by revenue; the model cuts nothing off."""
    return (silver.groupBy("product_id", "product_name", "product_category")
            .agg(F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units_sold"),
                 F.count("order_id").alias("order_count"))
            .orderBy(F.desc("revenue")))


def gold_models(keys_are_unique: bool = False) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Table name -> model."""
    return {
        "daily_revenue": lambda silver: daily_revenue(silver, keys_are_unique),
        "order_status_summary": order_status_summary,
        "top_products": top_products,
    }
