"""Paths: small driver-side helpers over the Hadoop file system.

``write_new_text`` needs a file system whose rename is atomic and does not overwrite, as HDFS and
local ones have; object stores do not give that.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _hadoop_conf(spark: SparkSession):
    return spark._jsc.hadoopConfiguration()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory; none when it does not exist."""
    hadoop_path = _path(spark, path)
    fs = hadoop_path.getFileSystem(_hadoop_conf(spark))
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = _path(spark, path)
    return hadoop_path.getFileSystem(_hadoop_conf(spark)).exists(hadoop_path)


def files_and_bytes(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Number and bytes of the data files in each directory of ``path``, by its name.

    Spark lists the files, in parallel where there are many directories, and reads none of them. One
    row per directory comes back.
    """
    names = list_names(spark, path)
    if not any("=" in name for name in names):
        return {}
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("length", F.element_at(F.split("path", "/"), -2).alias("directory")))
    sizes = files.groupBy("directory").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    raw = {unquote(r["directory"]): (r["files"], r["bytes"]) for r in sizes.collect()}
    return {name: raw[unquote(name)] for name in names if unquote(name) in raw}


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path = _path(spark, path)
    stream = hadoop_path.getFileSystem(_hadoop_conf(spark)).open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that appears whole or not at all; fails when it exists already."""
    final = _path(spark, path)
    draft = _path(spark, f"{final.getParent()}/.{uuid.uuid4().hex}")
    fs = final.getFileSystem(_hadoop_conf(spark))
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        move(spark, draft.toString(), path)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(final):
            raise FileExistsError(f"{path} was written by another job") from error
        raise


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or directory in one step; fails when the target exists already."""
    jvm, conf = spark._jvm, _hadoop_conf(spark)
    final = _path(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.getFileSystem(conf).getUri(), conf)
    no_overwrite = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(_path(spark, source), final, no_overwrite)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a directory."""
    hadoop_path = _path(spark, path)
    return hadoop_path.getFileSystem(_hadoop_conf(spark)).getContentSummary(hadoop_path).getLength()


def count_files(spark: SparkSession, path: str) -> int:
    """How many data files lie in a directory."""
    hadoop_path = _path(spark, path)
    names = [s.getPath().getName() for s in hadoop_path.getFileSystem(_hadoop_conf(spark)).listStatus(hadoop_path)]
    return sum(not name.startswith(("_", ".")) for name in names)


def make_dir(spark: SparkSession, path: str) -> None:
    hadoop_path = _path(spark, path)
    hadoop_path.getFileSystem(_hadoop_conf(spark)).mkdirs(hadoop_path)


def delete_tree(spark: SparkSession, path: str) -> None:
    hadoop_path = _path(spark, path)
    hadoop_path.getFileSystem(_hadoop_conf(spark)).delete(hadoop_path, True)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
