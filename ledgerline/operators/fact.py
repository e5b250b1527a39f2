"""The sales fact and its daily summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import calendar
from ledgerline.operators.keys import Stage, assign_keys, in_scratch
from ledgerline.operators.merge import absent_from


#: Versions of a customer that a sale is compared with.
BLOCK = 64
#: A customer of at most so many versions is compared with each of them in generated code; a search of an array is interpreted.
FEW = 4


def versions_in_order(dim_customer: DataFrame, *take: str) -> DataFrame:
    """One row per customer: its versions by start, cut into blocks of ``BLOCK``, and the start of each block.

    A block holds every version that is valid at some time between its start and that of the next one, so the block that a time
    falls into is all there is to look at. A customer gets at most one version per batch.
    """
    one = F.struct(F.col("effective_start_date").alias("_from"), F.col("effective_end_date").alias("_to"), *take)
    valid = dim_customer.filter("effective_start_date < effective_end_date")
    rows = valid.groupBy(F.col("customer_id").alias("_id")).agg(F.sort_array(F.collect_list(one["_from"])).alias("_starts"), F.collect_list(one).alias("_all"))
    rows = rows.withColumn("_starts", F.transform(F.sequence(F.lit(0), F.size("_starts") - 1, F.lit(BLOCK)), lambda i: F.get("_starts", i)))
    within = lambda start, i: F.array_sort(F.filter(
        "_all", lambda v: (v["_to"] > start) & F.coalesce(v["_from"] < F.get("_starts", i + 1), F.lit(True))))
    return rows.select("_id", "_starts", F.transform("_starts", within).alias("_blocks"))


def point_in_time_join(sales: DataFrame, dim_customer: DataFrame, *take: str, stage: Stage = in_scratch) -> DataFrame:
    """Each sale with the customer version valid at its timestamp (the latest, if several are); sales without one are dropped.

    The join sees one row per customer, and inside it a sale is looked up by time: among the starts of the blocks, then among the
    versions of one block. That costs about the square root of a customer's versions; the few versions that most customers have are
    tried one by one, latest first. The versions are staged, so Spark knows their size, broadcasts them if that allows it, and
    otherwise can split a customer who owns much of the sales.
    """
    versions = stage("versions_in_order", versions_in_order(dim_customer, *take))
    at = F.col("sale_timestamp")
    holds = lambda v: (v["_from"] <= at) & (at < v["_to"])
    block = F.size(F.filter("_starts", lambda start: start <= at))
    found = F.filter(F.get("_blocks", block - 1), holds)
    only = F.get("_blocks", F.lit(0))
    tried = F.coalesce(*(F.when(holds(F.get(only, F.lit(i))), F.get(only, F.lit(i))) for i in reversed(range(FEW))))
    few = (F.size("_blocks") == 1) & (F.size(only) <= FEW)
    version = F.when(few, tried).otherwise(F.get(found, F.size(found) - 1))
    looked_up = sales.join(versions, F.col("customer_id") == F.col("_id")).select(*sales.columns, version.alias("_version"))
    return looked_up.filter(F.col("_version").isNotNull()).select(*sales.columns, *(f"_version.{c}" for c in take))


def fact_rows(
    sales: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame, stage: Stage = in_scratch
) -> DataFrame:
    """Sales with dimension keys and measures, without the fact's own key. Only keys are read from the dimensions."""
    keyed = (
        point_in_time_join(sales, dim_customer, "customer_key", stage=stage)
        .join(dim_product.select("product_id", "product_key"), "product_id")
        .join(dim_store.select("store_id", "store_key"), "store_id")
    )
    gross = F.col("quantity") * F.col("unit_price")
    return keyed.select(
        "sale_id",
        calendar.date_key(F.col("sale_timestamp").cast("date")).alias("date_key"),
        "customer_key", "product_key", "store_key", "sale_timestamp", "quantity", "unit_price",
        F.col("discount_amount").alias("discount"),
        gross.cast("decimal(14,2)").alias("gross_amount"),
        F.col("discount_amount").cast("decimal(14,2)").alias("discount_amount"),
        (gross - F.col("discount_amount")).cast("decimal(14,2)").alias("net_amount"),
        "payment_method", "_source_file", "_batch_id", "_loaded_at",
    )


def build_fact(
    sales: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
    existing: DataFrame | None = None, after: int | DataFrame = 0, stage: Stage = in_scratch,
) -> DataFrame:
    """New fact rows with keys, leaving out sales the fact already holds."""
    if existing is not None:
        sales = absent_from(sales, existing, "sale_id")
    return numbered(fact_rows(sales, dim_customer, dim_product, dim_store, stage), after, stage)


def numbered(rows: DataFrame, after: int | DataFrame = 0, stage: Stage = in_scratch) -> DataFrame:
    """Fact rows with keys."""
    return assign_keys(rows, "sale_key", after, stage).select(*schemas.FACT_SALES.fieldNames())


def new_valid_sales(valid: DataFrame, silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Valid sales whose id is neither in silver nor in the fact: what makes a replay add nothing.

    Both are laid out by a hash of the id, so a load passes the buckets of its own ids, not all of history.
    """
    known = silver.select("sale_id").union(fact.select("sale_id"))
    return absent_from(valid, known, "sale_id").select(*schemas.SILVER["sales"].fieldNames())


def daily_sales_summary(fact: DataFrame) -> DataFrame:
    """Totals per day. The distinct count groups by (day, sale) first, so a busy day is spread over tasks."""
    return fact.groupBy(F.col("sale_timestamp").cast("date").alias("sale_date")).agg(
        F.countDistinct("sale_id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("gross_amount").alias("gross_sales"),
        F.sum("discount_amount").alias("discount_amount"),
        F.sum("net_amount").alias("net_sales"),
    )


def summed_days(days: DataFrame) -> DataFrame:
    """Totals per day from totals of disjoint sets of sales."""
    measures = [c for c in schemas.DAILY_SALES_SUMMARY.fieldNames() if c != "sale_date"]
    return days.groupBy("sale_date").agg(*(F.sum(c).cast(schemas.DAILY_SALES_SUMMARY[c].dataType).alias(c) for c in measures))
