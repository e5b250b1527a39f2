"""Calendar parts that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic instead of formatting."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1
