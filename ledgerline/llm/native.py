"""Column helpers for the operators that use DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import row_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; pure ASCII texts take the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def on_row(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on ``doc_id`` (null equals null) and ``row_key``; the left side's columns stand for both."""
    right = right.withColumnsRenamed({"doc_id": "_right_id", "row_key": "_right_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_right_id")) & (F.col("row_key") == F.col("_right_key"))
    return left.join(right, same, how).drop("_right_id", "_right_key")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key`` and the whole row as ``row``, so that no column of ``docs`` can clash with those of an operator."""
    return docs.select("doc_id", row_key().alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(columns: list[str], **replaced: Column) -> list[Column]:
    """The columns of ``row`` again, some replaced."""
    return [replaced.get(c, F.col("row")[c]).alias(c) for c in columns]


def fresh(name: str, df: DataFrame) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name
