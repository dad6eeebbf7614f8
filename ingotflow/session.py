"""The Spark session the jobs run in."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def create_session(name: str, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution. Sizes and shuffle widths are the cluster's."""
    builder = (SparkSession.builder.appName(name)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true"))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str | int) -> Iterator[None]:
    """Run a block with one of the session's settings changed."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
