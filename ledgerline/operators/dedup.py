"""Latest row per key, and the rows it supersedes.

``latest`` filters ``row_number() = 1``; Spark turns that into a per-task group limit before the shuffle, so a key that
holds a third of all rows sends one row per task instead of its whole group. ``superseded`` needs every row but the
winner: the winner of a key is a maximum, which tasks aggregate before the shuffle, and the other rows are found by joins
with these maxima, whose hot keys Spark splits. Only rows of keys with several rows leave the first join. Equal rows are told apart
by their place in the files they are read from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.keys import Stage, in_scratch
from ledgerline.operators.rules import REASON, valid

_RECENCY = {"customers": "updated_at", "products": "updated_at", "stores": "opened_date", "sales": "sale_timestamp"}


def recency_columns(entity: str, by_timestamp: bool = True) -> list[str]:
    """What decides, most important first: timestamp (optional), row in file, file, the remaining columns, load and batch.

    Rows equal in all of them differ in nothing a typed table holds.
    """
    first = [_RECENCY[entity]] if by_timestamp else []
    leading = [*first, "_row_number", "_source_file"]
    rest = [c for c in schemas.BUSINESS_COLUMNS[entity] if c not in (schemas.KEYS[entity], *first)]
    return [*leading, *rest, "_loaded_at", "_batch_id"]


def recency(entity: str, by_timestamp: bool = True) -> list[Column]:
    """Newest first, by a total order."""
    return [F.col(c).desc_nulls_last() for c in recency_columns(entity, by_timestamp)]


def latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per non-null key: the first in ``order``."""
    numbered = df.filter(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return numbered.filter(F.col("_rn") == 1).drop("_rn")


def superseded(df: DataFrame, key: str, rank: list[Column], stage: Stage = in_scratch, contest: Stage = in_scratch) -> DataFrame:
    """Every row with a non-null key but one: the one that ranks highest, or, of equal ones, one of them.

    The first column of the rank decides for nearly all keys. Only rows that tie in it for the first place of their key are
    compared by the whole rank, so what else it holds is not worked out for the others. ``stage`` writes the rows and reads
    them back; rows that are read from files already need no other. ``contest`` does so with the keys of several rows, and with the
    rows that may be superseded: whole rows are shuffled once, to find these, and nothing after it reads the others.
    """
    rows = stage("ranked", df)
    keyed = rows.filter(F.col(key).isNotNull()).select("*", rank[0].alias("_lead"))
    times = keyed.groupBy(F.col(key).alias("_key"), "_lead").agg(F.count(F.lit(1)).alias("_n"))
    heads = times.groupBy("_key").agg(
        F.max("_lead").alias("_first"), F.sum("_n").alias("_rows"),
        F.coalesce(F.max_by("_n", "_lead"), F.sum("_n")).alias("_tied"),  # no row of the key has a value: all tie
    ).filter("_rows > 1")
    heads = contest("repeated_keys", heads)  # what it took to count them is gone before whole rows move
    leads = F.col("_lead").eqNullSafe(F.col("_first"))
    several = keyed.join(heads, F.col(key) == F.col("_key")).filter(~leads | (F.col("_tied") > 1))
    contested = contest("contested", several.select(*df.columns, leads.alias("_leads")))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    tied = contested.filter("_leads").select("*", place.alias("_place"))
    whole = F.struct(*rank, F.col("_place").alias("place"))
    winners = tied.groupBy(F.col(key).alias("_key")).agg(F.max(whole).alias("_best"))
    behind = tied.join(winners, F.col(key) == F.col("_key")).filter(whole < F.col("_best"))
    return contested.filter("NOT _leads").select(*df.columns).unionByName(behind.select(*df.columns))


def latest_valid(assessed: DataFrame, entity: str) -> DataFrame:
    """Validate, then keep the latest: an older valid row survives an invalid newer one (initial load).

    Valid rows sort before invalid ones, so the first row of a key is its latest valid row if it has one. Filtering
    before the window would say the same, but the filter would be pushed below the parsing and repeat it per rule.
    """
    order = [F.col(REASON).isNotNull(), *recency(entity)]
    return valid(latest(assessed, schemas.KEYS[entity], order))


def valid_latest(assessed: DataFrame, entity: str, by_timestamp: bool = True) -> DataFrame:
    """Keep the latest, then validate: an invalid newest row drops its key from the batch (incremental load)."""
    return valid(latest(assessed, schemas.KEYS[entity], recency(entity, by_timestamp)))
