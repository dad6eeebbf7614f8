"""Databases and named tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ingotflow.sources.tables import silver_table


def create_databases(spark: SparkSession, *names: str, location: str | None = None) -> None:
    for name in names:
        where = f" LOCATION '{location}/{name}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def register_silver(spark: SparkSession, path: str, name: str = "silver.orders",
                    version: int | None = None) -> None:
    """Name a silver snapshot; does nothing while silver has none."""
    table = silver_table(spark, path)
    if table.exists():
        table.register(name, version)


def register_path(spark: SparkSession, name: str, path: str) -> None:
    """Name a plain Parquet directory."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
