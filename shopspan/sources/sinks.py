"""Partitioned parquet sinks: overwrite, partition-scoped overwrite, merge."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopspan.operators.merging import upsert
from shopspan.sources.staging import staged

CHANGED = "_merge_changed"


def _sized(df: DataFrame, columns) -> DataFrame:
    """Few files per partition value; adaptive execution splits a value that is large."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def overwrite(df: DataFrame, path: str, *columns: str) -> None:
    """Without partition columns every task writes its rows as they are: nothing is moved only for the size of files."""
    if columns:
        _sized(df, columns).write.mode("overwrite").partitionBy(*columns).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partition values present in ``df``."""
    (
        _sized(df, columns).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table, or None without one; with a schema, a table without any file is empty."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def merge_into(
    path: str, source: DataFrame, partition: str, keys: list[str], compare: list[str], update: list[str]
) -> None:
    """Upsert into a partitioned table; only partitions in which a row changes are rewritten.

    The merged rows are stored before the overwrite, because they read the table
    they replace.
    """
    source = staged(source, "merge-source")
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"the merge source repeats a key {keys}")
    if not source.where(F.col(partition).isNull()).isEmpty():
        raise ValueError(f"the merge source has rows without {partition}")
    target = read_if_exists(source.sparkSession, path)
    if target is None:
        overwrite(source, path, partition)
        return
    # One value per week of the source: a handful.
    named = [r[0] for r in source.select(partition).distinct().collect()]
    same_types = source.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    current = target.where(F.col(partition).isin(named))
    merged = staged(upsert(current, same_types, keys, compare, update, CHANGED), "merged")
    touched = [r[0] for r in merged.where(CHANGED).select(partition).distinct().collect()]
    if touched:
        overwrite_partitions(merged.where(F.col(partition).isin(touched)).drop(CHANGED), path, partition)
