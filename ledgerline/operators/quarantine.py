"""Rejected rows with reason and original payload, guarded so that a replay adds nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.cleanse import META, ORIGINAL, typed
from ledgerline.operators.dedup import recency_columns, superseded
from ledgerline.operators.keys import Stage, in_scratch
from ledgerline.operators.rules import DUPLICATE_SALE, ENTITY_TAGS, REASON, invalid

_GUARD = ["source_file", "entity_name", "business_key", "batch_id", "rejection_reason"]


def _record(rows: DataFrame, entity: str, why: Column, now: Column) -> DataFrame:
    return rows.select(
        F.col("_source_file").alias("source_file"),
        F.lit(ENTITY_TAGS[entity]).alias("entity_name"),
        F.col(schemas.KEYS[entity]).alias("business_key"),
        why.alias("rejection_reason"),
        F.to_variant_object(F.col(ORIGINAL)).alias("raw_record"),
        F.col("_batch_id").alias("batch_id"),
        now.alias("rejected_at"),
    )


def rejected(assessed: DataFrame, entity: str, now: Column) -> DataFrame:
    """Invalid rows in quarantine layout. A projection and a filter: no shuffle."""
    return _record(invalid(assessed), entity, F.col(REASON), now)


def duplicate_sales(cleaned: DataFrame, now: Column, stage: Stage = in_scratch, contest: Stage = in_scratch) -> DataFrame:
    """Sales superseded within their batch, whether or not they are valid. ``stage`` and ``contest`` as for ``superseded``.

    Rows are told apart and recorded by their id, their ingest metadata and their text. The other typed columns follow from the text, so
    they are left behind, and parsed again where row numbers tie.
    """
    rows = cleaned.select("sale_id", *META, ORIGINAL)
    original = F.to_json(F.to_variant_object(F.col(ORIGINAL))).alias("original")  # copies that differ in spelling only
    rank = [F.col(c) if c in META else typed("sales", c, ORIGINAL) for c in recency_columns("sales", by_timestamp=False)]
    losers = superseded(rows, "sale_id", [*rank, original], stage, contest)
    return _record(losers, "sales", F.lit(DUPLICATE_SALE), now)


def unseen(rejects: DataFrame, existing: DataFrame) -> DataFrame:
    """Rejects not yet quarantined, each as often as it occurs more than before.

    Two rejects are the same if file, entity, key, batch, reason and original text are: several rows without an id in one file
    stay several rejects, and a replay adds nothing. Both sides are counted per distinct reject before the shuffle. Where nothing is
    quarantined yet, every reject is new, and none is compared.
    """
    if existing.isEmpty():
        return rejects
    payload = F.to_json("raw_record").alias("_payload")
    times = F.lit(1).cast("long")
    counted = (
        rejects.select(*_GUARD, payload, F.col("rejected_at"), times.alias("_n"))
        .unionByName(existing.select(*_GUARD, payload, F.lit(None).cast("timestamp_ntz").alias("rejected_at"), (-times).alias("_n")))
        .groupBy(*_GUARD, "_payload").agg(F.sum("_n").alias("_n"), F.max("rejected_at").alias("rejected_at"))
    )
    again = counted.filter("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return again.withColumn("raw_record", F.parse_json("_payload")).select(*rejects.columns)
