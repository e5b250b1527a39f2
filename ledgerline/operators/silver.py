"""Silver tables: cleaned, validated, one row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline import schemas
from ledgerline.operators import cleanse, dedup, rules
from ledgerline.operators.merge import absent_from, upsert


def assessed(raw: DataFrame, entity: str, path: str = "initial") -> DataFrame:
    """Typed rows with the reason they fail, the common input of silver and quarantine."""
    return rules.assess(cleanse.clean(raw, entity), entity, path)


def load_silver(assessed: DataFrame, entity: str, existing: DataFrame | None = None) -> DataFrame:
    """Rows to add to the silver table: valid, latest per key, key not there yet."""
    rows = dedup.latest_valid(assessed, entity).select(*schemas.SILVER[entity].fieldNames())
    return rows if existing is None else absent_from(rows, existing, schemas.KEYS[entity])


def customer_changes(assessed: DataFrame) -> DataFrame:
    """One valid row per customer of a batch; the newest row decides, valid or not."""
    return dedup.valid_latest(assessed, "customers").select(*schemas.SILVER["customers"].fieldNames())


def product_changes(assessed: DataFrame) -> DataFrame:
    """One valid row per product of a batch: the latest valid one."""
    return dedup.latest_valid(assessed, "products").select(*schemas.SILVER["products"].fieldNames())


def valid_sales(assessed: DataFrame) -> DataFrame:
    """One valid row per sale of a batch; the last row of the file decides, valid or not."""
    changes = dedup.valid_latest(assessed, "sales", by_timestamp=False)
    return changes.select(*schemas.SILVER["sales"].fieldNames())


def upsert_silver(existing: DataFrame, changes: DataFrame, entity: str) -> DataFrame:
    return upsert(existing, changes, [schemas.KEYS[entity]])
