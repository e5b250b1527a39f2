"""Lenient text-to-type parsers: a value that does not fit becomes NULL, never an error.

All are JVM expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes and words a parser accepts, and the e-mail shape a valid customer needs. The whole text must fit: "$"
# would let a final newline through.
TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?\z"
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[^@\s]+\z"


def text(c: Column) -> Column:
    """Strip surrounding spaces (spaces only, as the landing may hold tabs on purpose); empty becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def upper_text(c: Column) -> Column:
    return F.upper(text(c))


def lower_text(c: Column) -> Column:
    return F.lower(text(c))


def timestamp(c: Column) -> Column:
    # Without the shape check a bare year such as '2026' would count as a timestamp.
    value = text(c)
    return F.when(value.rlike(TIMESTAMP_SHAPE), value.try_cast("timestamp_ntz"))


def date(c: Column) -> Column:
    value = text(c)
    return F.when(value.rlike(TIMESTAMP_SHAPE), value.try_cast("date"))


def integer(c: Column) -> Column:
    # Through decimal(38,0), because a direct cast to bigint refuses '2.5' instead of rounding it.
    return text(c).try_cast("decimal(38,0)").try_cast("bigint")


def money(c: Column, precision: int = 12) -> Column:
    """Two decimals; a value with more digits than ``precision`` allows becomes NULL."""
    return text(c).try_cast(f"decimal({precision},2)")


def boolean(c: Column) -> Column:
    word = lower_text(c)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def is_email(c: Column) -> Column:
    return c.rlike(EMAIL_SHAPE)
