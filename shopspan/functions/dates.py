"""Date helpers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_end_date(value: date | datetime | str | None) -> date:
    """None is today; strings and timestamps become plain dates."""
    if value is None:
        return date.today()
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.fromisoformat(value.strip()).date()


def reject_future(value: date | str | None) -> date:
    day = normalize_end_date(value)
    if day > date.today():
        raise ValueError(f"date {day} lies in the future")
    return day


def weeks_between(later, earlier) -> Column:
    """Whole weeks from ``earlier`` to ``later``, truncated toward zero."""
    return (F.datediff(later, earlier) / 7).cast("short")


def offset_timestamp(ts) -> Column:
    """ISO timestamp whose UTC offset carries a colon, as pinned reads expect."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def add_offset_colon(text) -> Column:
    """Turn a trailing ``-0700`` into ``-07:00``."""
    return F.regexp_replace(text, r"(\d{2})(\d{2})$", "$1:$2")


def week_phase(week) -> tuple[Column, Column]:
    """Cosine and sine of the week's place in a 52-week year."""
    angle = week * (2 * 3.141592653589793) / 52
    return F.cos(angle), F.sin(angle)
