"""Raw text rows to typed rows: one projection per entity, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import parse

ORIGINAL = "_original"
META = ("_source_file", "_batch_id", "_loaded_at", "_row_number")

_PARSERS = {
    "customers": {
        "email": parse.lower_text, "region": parse.upper_text, "segment": parse.upper_text,
        "created_at": parse.timestamp, "updated_at": parse.timestamp,
    },
    "products": {
        "category": parse.upper_text, "brand": parse.upper_text, "unit_price": parse.money,
        "created_at": parse.timestamp, "updated_at": parse.timestamp, "is_active": parse.boolean,
    },
    "stores": {
        "state": parse.upper_text, "region": parse.upper_text, "store_type": parse.upper_text,
        "opened_date": parse.date,
    },
    "sales": {
        "sale_timestamp": parse.timestamp, "quantity": parse.integer, "unit_price": parse.money,
        "discount_amount": parse.money, "payment_method": parse.upper_text,
    },
}


def typed(entity: str, name: str, within: str | None = None) -> Column:
    """The typed column ``name``, from the text column of that name or from the one ``within`` a struct of them."""
    return _PARSERS[entity].get(name, parse.text)(F.col(f"{within}.{name}" if within else name)).alias(name)


def clean(raw: DataFrame, entity: str) -> DataFrame:
    """Typed columns, ingest metadata, and the untouched text as ``_original`` for the quarantine payload.

    Plans that only keep valid rows never read ``_original``, so column pruning removes it.
    """
    names = schemas.BUSINESS_COLUMNS[entity]
    return raw.select(
        *(typed(entity, name) for name in names),
        *META,
        F.struct(*names).alias(ORIGINAL),
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    return clean(raw, "customers")


def clean_products(raw: DataFrame) -> DataFrame:
    return clean(raw, "products")


def clean_stores(raw: DataFrame) -> DataFrame:
    return clean(raw, "stores")


def clean_sales(raw: DataFrame) -> DataFrame:
    return clean(raw, "sales")
