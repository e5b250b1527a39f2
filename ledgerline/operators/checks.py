"""Data-quality checks. Each returns a small frame to read or to assert on; none changes anything."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import calendar


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rows():
    return F.count(F.lit(1))


def raw_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, distinct files and distinct batches per raw table."""
    return stack(
        [
            df.agg(
                _rows().alias("row_count"),
                F.countDistinct("_source_file").alias("files"),
                F.countDistinct("_batch_id").alias("batches"),
            ).select(F.lit(entity.upper()).alias("entity"), "row_count", "files", "batches")
            for entity, df in raw.items()
        ]
    )


def key_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows against distinct business keys; equal when the keys are unique."""
    return stack(
        [
            df.agg(_rows().alias("row_count"), F.countDistinct(schemas.KEYS[entity]).alias("distinct_keys")).select(
                F.lit(entity.upper()).alias("entity"), "row_count", "distinct_keys"
            )
            for entity, df in tables.items()
        ]
    )


def duplicate_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows beyond one per business key (rows without a key count as duplicates)."""
    counts = key_counts(tables)
    return counts.select("entity", (F.col("row_count") - F.col("distinct_keys")).alias("duplicate_rows"))


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    counted = rejects.groupBy("entity_name", "rejection_reason").agg(_rows().alias("rejected_rows"))
    return counted.orderBy("entity_name", "rejection_reason")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Size of each named table."""
    return stack(
        [df.agg(_rows().alias("value")).select(F.lit(name).alias("check_name"), "value") for name, df in tables.items()]
    )


def multiple_current_versions(dim: DataFrame) -> DataFrame:
    """Customers with more than one current version: none, if all is well."""
    counted = dim.groupBy("customer_id").agg(F.count_if("is_current").alias("current_rows"))
    return counted.filter(F.col("current_rows") > 1)


def fact_orphans(
    fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
    dim_date: DataFrame | None = None,
) -> DataFrame:
    """Fact rows per dimension whose key the dimension lacks.

    One scan counts the fact per key of every dimension (grouping sets), so one anti join handles keys instead of sales.
    """
    sides = {"customer_key": dim_customer, "product_key": dim_product, "store_key": dim_store}
    if dim_date is not None:
        sides["date_key"] = dim_date
    names = list(sides)
    keys = fact.select(*(F.col(name).cast("long").alias(name) for name in names))
    # a grouping set's number has a bit for each column left out, the first column's the highest
    dimension = F.coalesce(*(F.when(F.col("_set") == (1 << len(names)) - 1 - (1 << len(names) - 1 - i), name) for i, name in enumerate(names)))
    counted = keys.groupingSets([[name] for name in names], *names).agg(_rows().alias("_n"), F.grouping_id().alias("_set")).select(
        dimension.alias("dimension"), F.coalesce(*names).alias("_key"), "_n"
    )
    members = stack([dim.select(F.lit(name).alias("dimension"), F.col(name).cast("long").alias("_key")) for name, dim in sides.items()])
    missing = counted.join(members, ["dimension", "_key"], "left_anti").select("dimension", "_n")
    none = fact.sparkSession.createDataFrame([(name, 0) for name in names], "dimension string, _n long")
    return missing.unionByName(none).groupBy("dimension").agg(F.sum("_n").alias("orphans"))


def batch_rows(raw: Mapping[str, DataFrame], batch_id: str | None = None) -> DataFrame:
    """Rows per raw table and batch; a table without rows of the batch is absent."""

    def counted(entity: str, df: DataFrame) -> DataFrame:
        rows = df if batch_id is None else df.filter(F.col("_batch_id") == batch_id)
        per_batch = rows.groupBy("_batch_id").agg(_rows().alias("row_count"))
        return per_batch.select("_batch_id", F.lit(entity.upper()).alias("entity"), "row_count")

    return stack([counted(entity, df) for entity, df in raw.items()])


def _only(df: DataFrame, key: str, ids) -> DataFrame:
    return df if ids is None else df.filter(F.col(key).isin(list(ids)))


def version_history(dim: DataFrame, customer_ids=None) -> DataFrame:
    """Versions in order of validity, of the given customers or of all."""
    columns = (
        "customer_key", "customer_id", "email", "effective_start_date", "effective_end_date", "is_current", "is_inferred",
    )
    return _only(dim, "customer_id", customer_ids).select(*columns).orderBy("customer_id", "effective_start_date")


def inferred_state(dim: DataFrame, customer_ids=None) -> DataFrame:
    """Per customer: lowest key, number of versions and how many of them are inferred."""
    return _only(dim, "customer_id", customer_ids).groupBy("customer_id").agg(
        F.min("customer_key").alias("customer_key"), _rows().alias("versions"),
        F.count_if("is_inferred").alias("inferred_rows"),
    )


def product_prices(dim: DataFrame, product_ids=None) -> DataFrame:
    rows = _only(dim, "product_id", product_ids)
    return rows.select("product_id", "unit_price", "updated_at").orderBy("product_id")


def batch_fact_totals(fact: DataFrame, batch_id: str | None = None) -> DataFrame:
    rows = fact if batch_id is None else fact.filter(F.col("_batch_id") == batch_id)
    return rows.groupBy("_batch_id").agg(_rows().alias("fact_rows"), F.sum("net_amount").alias("net_sales"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(key).agg(_rows().alias("row_count")).filter(F.col("row_count") > 1)


def quarantine_duplicates(rejects: DataFrame) -> DataFrame:
    """Rejects sharing file, entity, key, batch and reason. Rows that arrived together may do so rightly."""
    guard = ("source_file", "entity_name", "business_key", "batch_id", "rejection_reason")
    return rejects.groupBy(*guard).agg(_rows().alias("quarantine_rows")).filter(F.col("quarantine_rows") > 1)


def rerun_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Table sizes before and after a rerun, side by side."""
    return before.withColumnRenamed("value", "rows_before").join(
        after.withColumnRenamed("value", "rows_after"), "check_name"
    )


def undated_facts(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Days with sales that the calendar does not cover."""
    days = fact.groupBy(F.col("sale_timestamp").cast("date").alias("full_date")).agg(_rows().alias("fact_rows"))
    keyed = days.select(calendar.date_key(F.col("full_date")).alias("date_key"), "full_date", "fact_rows")
    return keyed.join(dim_date.select("date_key"), "date_key", "left_anti")
