"""Household numbers that stay: an append-only table of ids.

Numbering all households anew each run shifts the batch of every household behind a new one. Here a household keeps the number it
got first. A run numbers only the ids that the table does not hold, in id order behind the largest number given, and appends them as
a partition of its own; batches are ranges of numbers, so batches filled before stay as they were.

One run at a time may add numbers. A run that is repeated finds its ids and adds nothing; one that broke off half way goes on behind
what it had stored. Numbers are unique, and without gaps unless such a run lost a file.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopspan.operators.ordering import ordered_positions
from shopspan.sources import sinks
from shopspan.sources.staging import staged

SCHEMA = "hhn bigint, unique_hhn_num bigint, added date"


def unknown_ids(ids: DataFrame, known: DataFrame | None) -> DataFrame:
    """Distinct ids of ``ids`` (column hhn) without a number; null ids get none."""
    wanted = ids.where("hhn IS NOT NULL").select(F.col("hhn").cast("bigint").alias("hhn")).distinct()
    return wanted if known is None else wanted.join(known.select("hhn"), "hhn", "left_anti")


def extend(path: str, ids: DataFrame, added: date) -> int:
    """Number the ids that the table at ``path`` does not hold; how many those were.

    One anti-join on the id, a range sort of the new ids alone, and one number brought to the driver.
    """
    spark = ids.sparkSession
    known = sinks.read_if_exists(spark, path, SCHEMA)
    start = 0
    if known is not None:
        start = known.agg(F.coalesce(F.max("unique_hhn_num") + 1, F.lit(0))).first()[0]
    new = staged(unknown_ids(ids, known), "new-ids")
    n_new = new.count()
    if n_new or known is None:
        numbered = ordered_positions(new, [], [F.asc("hhn")]).select(
            "hhn", (F.col("position") + start).alias("unique_hhn_num"), F.lit(added).alias("added")
        )
        numbered.write.mode("append").partitionBy("added").parquet(path)
    return n_new


def numbers(path: str, spark: SparkSession) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def batches(path: str, spark: SparkSession, per_batch: int = 25_000) -> DataFrame:
    """hhn, unique_hhn_num and hhn_batch_num of every numbered household."""
    return numbers(path, spark).select(
        "hhn", "unique_hhn_num", F.floor(F.col("unique_hhn_num") / per_batch).alias("hhn_batch_num")
    )
