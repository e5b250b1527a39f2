"""Merge-style operators for tables without row-level updates: pure functions from old state and source to new state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def absent_from(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti").select(*df.columns)


def insert_missing(target: DataFrame, source: DataFrame, key: str, match: Column | None = None) -> DataFrame:
    """``target`` plus the source rows whose key is in no target row (for which ``match`` holds)."""
    seen = target if match is None else target.filter(match)
    return target.unionByName(absent_from(source, seen, key), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the others are added."""
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, key: str, when: Column, values: Mapping[str, Column]) -> DataFrame:
    """Update target columns where a source row matches on ``key`` and ``when`` holds.

    ``when`` and ``values`` see target columns as ``t.*`` and source columns as ``s.*``; ``source`` has one row per key.
    """
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    hit = F.col(f"s.{key}").isNotNull() & F.coalesce(when, F.lit(False))
    return joined.select(
        *(
            F.when(hit, values[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in values else F.col(f"t.{c}")
            for c in target.columns
        )
    )
