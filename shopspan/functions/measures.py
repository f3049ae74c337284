"""Line-level measures and predicates of the sales feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sub-category ids that are not merchandise (coupons, point-of-sale
# support, opening discounts, charity, gift cards, unknown, environment fee).
NON_MERCH_RANGES = (("6994", "7024"), ("7431", "7440"), ("8044", "8104"))
NON_MERCH_IDS = ("6634", "6635", "6636", "6637", "6638", "6639", "8040")
NON_MERCH_NAME = "%C/C RECORD%"


def on_offer() -> Column:
    return F.col("offer_id").isNotNull() & (F.col("offer_id") != 0)


def offer_only(measure) -> Column:
    """The measure on lines sold under an offer, zero elsewhere."""
    return F.when(on_offer(), measure).otherwise(F.lit(0))


def unit_of_measure(weight) -> Column:
    return F.when(weight == 0, "EACH").when(weight != 0, "KG")


def units_sold() -> Column:
    """Piece count for piece goods, weight for weighed goods.

    ``quantity`` and ``weight`` are expected next to ``uom``.
    """
    pieces = F.col("uom").isNull() | (F.col("uom") == "EACH")
    return (
        F.when(pieces & (F.col("quantity") != 0), F.col("quantity"))
        .when(F.col("weight") == 0, F.col("quantity"))
        .otherwise(F.col("weight"))
    )


def is_non_merch() -> Column:
    """Sub-category ids compare as strings, as they are stored."""
    sub_cat = F.col("mdm_sub_cat_id")
    ranges = reduce(Column.__or__, [sub_cat.between(lo, hi) for lo, hi in NON_MERCH_RANGES])
    return ranges | sub_cat.isin(*NON_MERCH_IDS) | F.col("variant_name").like(NON_MERCH_NAME)


def sum_or_zero(measure) -> Column:
    return F.coalesce(F.sum(measure), F.lit(0))


def sum_of_known(measure) -> Column:
    return F.sum(F.coalesce(measure, F.lit(0)))


def unit_offer_ratio(units, offer_units) -> Column:
    """Share of units sold under an offer, clamped to [0, 1]."""
    return (
        F.when(units <= 0, F.lit(0.0))
        .when(offer_units > units, F.lit(1.0))
        .when(offer_units <= 0, F.lit(0.0))
        .otherwise(F.try_divide(offer_units.cast("double"), units.cast("double")))
    )


def clip_at_zero(column) -> Column:
    """Negative becomes zero; null stays null."""
    return F.when(column < 0, F.lit(0)).otherwise(column)
