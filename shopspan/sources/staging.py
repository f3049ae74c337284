"""Staged tables.

A result that several later steps read, or that must not change when a lost
executor forces a recomputation, is written once as parquet into the shared
folder the cluster names in ``spark.checkpoint.dir`` and read back from there.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_scopes: list[list[str]] = []


def staging_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # Only here do driver and tasks share one process and one disk.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folder


def new_staging_path(spark: SparkSession, label: str) -> str:
    path = f"{staging_folder(spark)}/shopspan/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside, once the block has written or read its result."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame over the written files."""
    spark = df.sparkSession
    path = new_staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
