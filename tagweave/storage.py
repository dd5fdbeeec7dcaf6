"""Scratch space that every executor can reach.

Lineage is cut by writing a table there, so a lost executor costs a re-read and
not a second pass over the source.
"""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@functools.cache
def own_folder() -> str:
    return tempfile.mkdtemp(prefix="tagweave-")


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; one temporary folder per driver where it is unset.

    The temporary folder is for tests on one machine only: any other master, and a
    cluster of processes on one machine, has to name a shared folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return own_folder()
    raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object behind ``path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def absolute(spark: SparkSession, path: str) -> str:
    """``path`` with its file system and full folder, whatever a table location would make of it."""
    fs, hadoop_path = file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root, removed when the driver exits."""
    parent = f"{scratch_root(spark)}/tagweave-{uuid.uuid4().hex}"
    fs, hadoop_parent = file_system(spark, parent)
    fs.mkdirs(hadoop_parent)
    fs.deleteOnExit(hadoop_parent)
    return f"{parent}/{label}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to scratch space once and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(*staged: DataFrame) -> None:
    """Delete what ``stage`` wrote for these frames, once nothing reads it any more."""
    for df in staged:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/tagweave-" in folder:
                fs, path = file_system(spark, folder)
                fs.delete(path, True)


def literal_rows(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A few rows as part of the plan: integers are bigint, numbers with a point double."""
    return spark.createDataFrame(pa.table(columns))


def local_copy(small: DataFrame) -> DataFrame:
    """A result of known small size as part of the plan, so that its work is not repeated."""
    return small.sparkSession.createDataFrame(small.toArrow())
