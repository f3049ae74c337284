"""Versioned tables on plain parquet: a folder per version and a small commit table.

Stands in for a table format's time travel where none is installed. A version becomes
visible when its commit row is appended, after all of its data has been written.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopspan.sources.sinks import overwrite, read_if_exists
from shopspan.sources.staging import remove_folder

COMMIT_SCHEMA = (
    "version long, committed_at timestamp, operation string, location string, keep_from timestamp"
)
LONG_HISTORY = timedelta(weeks=104)
SHORT_HISTORY = timedelta(days=30)


class VersionedTable:
    """One writer at a time. The commit table only ever grows, so readers of an older
    state are not disturbed and a failed write leaves no trace."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> DataFrame:
        commits = read_if_exists(self.spark, f"{self.root}/commits")
        return commits if commits is not None else self.spark.createDataFrame([], COMMIT_SCHEMA)

    def _append(self, version, at, operation, location, keep_from) -> None:
        row = self.spark.createDataFrame(
            [(version, at, operation, location, keep_from)], COMMIT_SCHEMA
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def history(self) -> DataFrame:
        """Versions that are still kept: those inside the retention time, and the newest."""
        commits = self._commits()
        oldest = commits.select(F.max("keep_from")).scalar()
        newest = commits.select(F.max("version")).scalar()
        kept = oldest.isNull() | (F.col("committed_at") >= oldest) | (F.col("version") == newest)
        return commits.where((F.col("operation") == "WRITE") & kept).drop("keep_from")

    def write(self, df: DataFrame, *partitions: str, at: datetime | None = None) -> int:
        last = self._commits().agg(F.max("version")).first()[0]
        version = 0 if last is None else last + 1
        location = f"{self.root}/data/v={version}"
        overwrite(df, location, *partitions)
        self._append(version, at or datetime.now(), "WRITE", location, None)
        return version

    def newest_version(self) -> int | None:
        return self.history().agg(F.max("version")).first()[0]

    def read_as_of(self, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        """The given version, the newest at a time, or the newest of all."""
        commits = self.history()
        if version is not None:
            commits = commits.where(F.col("version") == version)
        if timestamp is not None:
            commits = commits.where(F.col("committed_at") <= F.lit(timestamp))
        found = commits.orderBy(F.desc("version")).first()
        if found is None:
            raise ValueError(f"{self.root}: no version {version} as of {timestamp or 'now'}")
        return self.spark.read.parquet(found["location"])

    def last_operation(self, now: datetime | None = None) -> DataFrame:
        """Time of the newest version and whole days since."""
        return self.history().agg(F.max("committed_at").alias("last_commit")).withColumn(
            "days_since", F.abs(F.datediff(F.lit(now or datetime.now()), "last_commit"))
        )

    def expire(self, keep: timedelta = SHORT_HISTORY, now: datetime | None = None) -> None:
        """Forget older versions and remove their folders; the newest stays."""
        at = now or datetime.now()
        self._append(None, at, "EXPIRE", None, at - keep)
        kept = self.history().select("version")
        gone = self._commits().where("operation = 'WRITE'").join(kept, "version", "left_anti")
        for row in gone.select("location").collect():  # versions of one table
            remove_folder(self.spark, row["location"])
