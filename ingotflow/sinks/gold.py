"""Gold tables: full refresh, unpartitioned, one per model."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ingotflow import storage

REFRESH = "refresh_"


def build_table(df: DataFrame, database: str, table: str, location: str) -> None:
    """Replace a table's rows; the model's order shapes the files, readers must sort again to rely on it.

    Each refresh writes a folder of its own below ``location`` and names it as a table of its own. ``table`` is
    a view, pointed at it by one statement, so until then, and if anything fails, it stays as it was, whatever the
    columns of the two. The refresh before stays, for readers that began on it; older ones go.
    """
    spark, name = df.sparkSession, f"{database}.{table}"
    refresh = f"{REFRESH}{uuid.uuid4().hex}"
    kept = {refresh, *_refreshes(spark, database, table)[-1:]}
    df.write.parquet(f"{location}/{refresh}")
    backing = f"{name}_{refresh}"
    spark.sql(f"CREATE TABLE {backing} USING parquet LOCATION '{location}/{refresh}'")
    _point(spark, name, backing)
    for old in _refreshes(spark, database, table):
        if old not in kept:
            spark.sql(f"DROP TABLE {name}_{old}")
    for old in storage.list_names(spark, location):
        if old.startswith(REFRESH.rstrip("_")) and old not in kept:
            storage.delete_tree(spark, f"{location}/{old}")


def _refreshes(spark: SparkSession, database: str, table: str) -> list[str]:
    """The refresh that the table shows, if any, and before it the others that are named."""
    found = [t.name.removeprefix(f"{table}_") for t in spark.catalog.listTables(database, f"{table}_{REFRESH}*")]
    shown = _shown(spark, f"{database}.{table}")
    return sorted(found, key=lambda refresh: bool(shown) and shown.endswith(refresh))


def _shown(spark: SparkSession, name: str) -> str | None:
    """The text of a view."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()
    return rows["data_type"].strip("`") if rows else ""


def _point(spark: SparkSession, name: str, backing: str) -> None:
    statement = f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {backing}"
    if _shown(spark, name) != "":
        spark.sql(statement)
        return
    # a table of an earlier release stands under the name
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}_before")
    try:
        spark.sql(statement)
    except Exception:
        spark.sql(f"ALTER TABLE {name}_before RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {name}_before")
