"""Scratch folders of the contract queries."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused directory name below ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting falls back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="ingotflow-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
