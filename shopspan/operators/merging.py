"""Upsert as a DataFrame operation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], compare: list[str], update: list[str],
    changed: str | None = None,
) -> DataFrame:
    """Merge as one DataFrame.

    Matched rows take ``update`` columns from the source when any ``compare`` column
    differs (an unknown value on either side is no difference); unmatched source rows
    are inserted; everything else stays. ``changed`` names a column that tells which rows
    the merge inserted or updated.
    """
    old, new = F.struct(*target.columns), F.struct(*source.columns)
    joined = target.select(*keys, old.alias("old")).join(
        source.select(*keys, new.alias("new")), keys, "full"
    )
    differs = F.lit(False)
    for c in compare:
        differs = differs | F.coalesce(F.col(f"new.{c}") != F.col(f"old.{c}"), F.lit(False))
    inserted = F.col("old").isNull()
    replaced = F.col("old").isNotNull() & F.col("new").isNotNull() & differs

    def value(c):
        takes_new = (inserted | replaced) if c in update else inserted
        return F.when(takes_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)

    marks = [(inserted | replaced).alias(changed)] if changed else []
    return joined.select(*[value(c) for c in target.columns], *marks)
