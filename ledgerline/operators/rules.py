"""Validation rules: an ordered list of (code, failing condition) per entity; the first failing rule names the row.

Rules look only at the cleaned columns. They mention each as seldom as possible (``not known to be good`` covers both
an absent and a bad value), because a filter on the reason is pushed below the cleaning projection, which repeats the
parsing once per mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import parse

REASON = "_reason"

# Accepted payment methods, and the entity tag each table writes into the quarantine.
PAYMENT_METHODS = ("CASH", "CARD", "UPI", "WALLET")
ENTITY_TAGS = {"customers": "CUSTOMER", "products": "PRODUCT", "stores": "STORE", "sales": "SALE"}
DUPLICATE_SALE = "DUPLICATE_SALE_IN_BATCH"

Rules = list[tuple[str, Column]]


def _absent(name: str) -> Column:
    return F.col(name).isNull()


def _not(good: Column) -> Column:
    """``good`` is false or unknown."""
    return ~F.coalesce(good, F.lit(False))


def _not_positive(name: str) -> Column:
    return _not(F.col(name) > 0)


# The reason codes below, in the order in which they are tried.


def _customers_initial() -> Rules:
    return [
        ("MISSING_CUSTOMER_ID", _absent("customer_id")),
        ("MISSING_CUSTOMER_NAME", _absent("customer_name")),
        ("MISSING_EMAIL", _absent("email")),
        ("INVALID_EMAIL", ~parse.is_email(F.col("email"))),
        ("INVALID_CREATED_AT", _absent("created_at")),
        ("INVALID_UPDATED_AT", _absent("updated_at")),
    ]


def _customers_batch() -> Rules:
    return [
        ("MISSING_CUSTOMER_ID", _absent("customer_id")),
        ("MISSING_CUSTOMER_NAME", _absent("customer_name")),
        ("INVALID_EMAIL", _not(parse.is_email(F.col("email")))),
        ("INVALID_TIMESTAMP", _absent("created_at") | _absent("updated_at")),
    ]


def _products() -> Rules:
    return [
        ("MISSING_PRODUCT_ID", _absent("product_id")),
        ("MISSING_PRODUCT_NAME", _absent("product_name")),
        ("INVALID_UNIT_PRICE", _not_positive("unit_price")),
        ("INVALID_CREATED_AT", _absent("created_at")),
        ("INVALID_UPDATED_AT", _absent("updated_at")),
        ("INVALID_IS_ACTIVE", _absent("is_active")),
    ]


def _stores() -> Rules:
    return [
        ("MISSING_STORE_ID", _absent("store_id")),
        ("MISSING_STORE_NAME", _absent("store_name")),
        ("INVALID_OPENED_DATE", _absent("opened_date")),
    ]


def _sales(batch: bool) -> Rules:
    discount, gross = F.col("discount_amount"), F.col("quantity") * F.col("unit_price")
    if batch:
        discounts = [("INVALID_DISCOUNT", _not(discount.between(0, gross)))]
    else:
        discounts = [("INVALID_DISCOUNT", _not(discount >= 0)), ("DISCOUNT_EXCEEDS_GROSS_AMOUNT", discount > gross)]
    return [
        ("MISSING_SALE_ID", _absent("sale_id")),
        ("INVALID_TIMESTAMP" if batch else "INVALID_SALE_TIMESTAMP", _absent("sale_timestamp")),
        ("MISSING_CUSTOMER_ID", _absent("customer_id")),
        ("MISSING_PRODUCT_ID", _absent("product_id")),
        ("MISSING_STORE_ID", _absent("store_id")),
        ("INVALID_QUANTITY", _not_positive("quantity")),
        ("INVALID_UNIT_PRICE", _not_positive("unit_price")),
        *discounts,
        ("INVALID_PAYMENT_METHOD", _not(F.col("payment_method").isin(*PAYMENT_METHODS))),
    ]


def rules(entity: str, path: str = "initial") -> Rules:
    """The ordered rules of ``entity``; ``path`` is ``initial`` or ``batch`` (products and stores have one list)."""
    if path not in ("initial", "batch"):
        raise ValueError(f"unknown path {path!r}")
    batch = path == "batch"
    if entity == "customers":
        return _customers_batch() if batch else _customers_initial()
    if entity == "products":
        return _products()
    if entity == "stores":
        return _stores()
    if entity == "sales":
        return _sales(batch)
    raise ValueError(f"unknown entity {entity!r}")


def reason(ordered: Rules) -> Column:
    """Code of the first failing rule, NULL for a valid row."""
    return F.coalesce(*(F.when(failing, F.lit(code)) for code, failing in ordered))


def assess(cleaned: DataFrame, entity: str, path: str = "initial") -> DataFrame:
    return cleaned.withColumn(REASON, reason(rules(entity, path)))


def valid(assessed: DataFrame) -> DataFrame:
    return assessed.filter(F.col(REASON).isNull()).drop(REASON)


def invalid(assessed: DataFrame) -> DataFrame:
    return assessed.filter(F.col(REASON).isNotNull())
