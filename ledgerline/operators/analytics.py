"""Revenue reports. Facts are summed per dimension key before the join, so the join sees one row per key and a hot
key costs no more than any other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_revenue(summary: DataFrame) -> DataFrame:
    return summary.select("sale_date", "net_sales").orderBy("sale_date")


def _by(fact: DataFrame, dim: DataFrame, key: str, attributes: list[str], **measures: str) -> DataFrame:
    per_key = fact.groupBy(key).agg(*(F.sum(source).alias(name) for name, source in measures.items()))
    labelled = per_key.join(dim.select(key, *attributes), key)
    return labelled.groupBy(*attributes).agg(*(F.sum(name).alias(name) for name in measures))


def revenue_by_region(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """By the region the customer had when buying, since the fact points at that version."""
    return _by(fact, dim_customer, "customer_key", ["region"], net_sales="net_amount").orderBy(F.desc("net_sales"))


def revenue_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    report = _by(fact, dim_product, "product_key", ["category"], net_sales="net_amount", units="quantity")
    return report.orderBy(F.desc("net_sales"))


def store_performance(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    report = _by(fact, dim_store, "store_key", ["store_id", "city"], net_sales="net_amount")
    return report.orderBy(F.desc("net_sales"))
