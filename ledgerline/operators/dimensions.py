"""Dimensions: initial members, Type 1 and Type 2 maintenance, inferred members, and the calendar."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import calendar
from ledgerline.operators.keys import Stage, assign_keys, in_scratch
from ledgerline.operators.merge import absent_from

# Validity bounds, the start of a customer without creation time, the inferred-member label, the calendar.
OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 23:59:59"
DEFAULT_START = "2026-01-01 00:00:00"
UNKNOWN = "UNKNOWN"
CALENDAR_START = date(2025, 1, 1)
CALENDAR_DAYS = 1095

TRACKED = ("customer_name", "email", "phone", "region", "segment")
_META = ("_source_file", "_batch_id", "_loaded_at")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _shape(df: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` in its order, absent ones as NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *(
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        )
    )


# --- members created by the initial load -------------------------------------------------------------------------


def init_dim_customer(
    silver: DataFrame, dim: DataFrame | None = None, after: int | DataFrame = 0, stage: Stage = in_scratch
) -> DataFrame:
    """New open versions for customers without a current version in ``dim``."""
    fresh = silver if dim is None else absent_from(silver, dim.filter("is_current"), "customer_id")
    rows = fresh.select(
        "customer_id", *TRACKED,
        F.coalesce("created_at", _ts(DEFAULT_START)).alias("effective_start_date"),
        _ts(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_current"), F.lit(False).alias("is_inferred"), *_META,
    )
    return _shape(assign_keys(rows, "customer_key", after, stage), schemas.DIM_CUSTOMER)


def _init_type1(silver: DataFrame, dim: DataFrame | None, after, stage: Stage, entity: str, key: str, schema) -> DataFrame:
    fresh = silver if dim is None else absent_from(silver, dim, schemas.KEYS[entity])
    rows = fresh.withColumn("is_inferred", F.lit(False))
    return _shape(assign_keys(rows, key, after, stage), schema)


def init_dim_product(
    silver: DataFrame, dim: DataFrame | None = None, after: int | DataFrame = 0, stage: Stage = in_scratch
) -> DataFrame:
    return _init_type1(silver, dim, after, stage, "products", "product_key", schemas.DIM_PRODUCT)


def init_dim_store(
    silver: DataFrame, dim: DataFrame | None = None, after: int | DataFrame = 0, stage: Stage = in_scratch
) -> DataFrame:
    return _init_type1(silver, dim, after, stage, "stores", "store_key", schemas.DIM_STORE)


def build_dim_date(
    spark: SparkSession, start: date = CALENDAR_START, days: int = CALENDAR_DAYS, existing: DataFrame | None = None
) -> DataFrame:
    """One row per day; days already in ``existing`` are left out."""
    day = F.col("full_date")
    rows = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    rows = rows.select(
        calendar.date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week"),
        calendar.iso_weekday(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        (calendar.iso_weekday(day) >= 6).alias("is_weekend"),
    )
    return rows if existing is None else absent_from(rows, existing, "date_key")


# --- Type 2 customers --------------------------------------------------------------------------------------------


def _differs() -> Column:
    """Any tracked attribute differs, where NULL and the empty text count as equal."""
    empty = F.lit("")
    return reduce(or_, (F.coalesce(f"old.{c}", empty) != F.coalesce(f"new.{c}", empty) for c in TRACKED))


def scd2_versions(current: DataFrame, changes: DataFrame, now: Column, ignore_stale: bool = False) -> DataFrame:
    """Current versions and changes, joined once, as the versions they become; those newly opened have no key yet.

    ``current`` has one version and ``changes`` one row per customer. What follows is decided from that one match, so no step sees
    another's half-done work: an inferred member is resolved under its key and dates and nothing else, a changed one is closed and
    reopened, an unknown one opened, and all others are carried on. With ``ignore_stale`` a change that is not newer than the
    version it would close is left out.
    """
    schema = schemas.DIM_CUSTOMER
    pairs = current.select(F.col("customer_id").alias("_id"), F.struct(*schema.fieldNames()).alias("old")).join(
        changes.select(F.col("customer_id").alias("_new_id"), F.struct(*changes.columns).alias("new")), F.col("_id") == F.col("_new_id"), "full",
    )
    replaces = _differs()
    if ignore_stale:
        replaces = replaces & (F.col("new.updated_at") > F.col("old.effective_start_date"))

    def version(**values: Column) -> Column:
        return F.struct(*(values.get(f.name, F.col(f"old.{f.name}")).cast(f.dataType).alias(f.name) for f in schema.fields))

    given = {c: F.col(f"new.{c}") for c in (*TRACKED, *_META)}
    resolved = version(**given, is_inferred=F.lit(False))
    closed = version(effective_end_date=F.col("new.updated_at"), is_current=F.lit(False), _loaded_at=now)
    opened = version(
        **given, customer_key=F.lit(None), customer_id=F.col("new.customer_id"), effective_start_date=F.col("new.updated_at"),
        effective_end_date=_ts(OPEN_END), is_current=F.lit(True), is_inferred=F.lit(False),
    )
    becomes = (
        F.when(F.col("old").isNull(), F.array(opened)).when(F.col("new").isNull(), F.array(version()))
        .when(F.col("old.is_inferred"), F.array(resolved)).when(replaces, F.array(closed, opened)).otherwise(F.array(version()))
    )
    return pairs.select(F.explode(becomes).alias("v")).select("v.*")


def scd2_keyed(versions: DataFrame, after: int | DataFrame, stage: Stage = in_scratch) -> DataFrame:
    """``scd2_versions``, written before, with keys for the versions that have none."""
    opened = assign_keys(versions.filter("customer_key IS NULL").drop("customer_key"), "customer_key", after, stage)
    schema = schemas.DIM_CUSTOMER
    return _shape(versions.filter("customer_key IS NOT NULL"), schema).unionByName(_shape(opened, schema))


def scd2_apply(dim: DataFrame, changes: DataFrame, now: Column, ignore_stale: bool = False, stage: Stage = in_scratch) -> DataFrame:
    """The whole dimension after one batch of changes: history, newly closed and current versions."""
    versions = stage("versions", scd2_versions(dim.filter("is_current"), changes, now, ignore_stale))
    history = _shape(dim.filter("NOT is_current"), schemas.DIM_CUSTOMER)
    return history.unionByName(scd2_keyed(versions, dim, stage))


# --- Type 1 products ---------------------------------------------------------------------------------------------


def scd1_rows(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """``dim`` after the changes, from one join: latest attributes win and the key stays, an inferred product becomes real, and
    products not met before have no key yet."""
    schema = schemas.DIM_PRODUCT
    source = changes.withColumn("is_inferred", F.lit(False))
    pairs = dim.select(F.col("product_id").alias("_id"), F.struct(*schema.fieldNames()).alias("old")).join(
        source.select(F.col("product_id").alias("_new_id"), F.struct(*source.columns).alias("new")), F.col("_id") == F.col("_new_id"), "full",
    )
    return pairs.select(*(
        (F.col("old.product_key") if f.name == "product_key" else
         F.when(F.col("new").isNull(), F.col(f"old.{f.name}")).otherwise(F.col(f"new.{f.name}"))).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ))


def scd1_upsert(dim: DataFrame, changes: DataFrame, after: int | DataFrame | None = None, stage: Stage = in_scratch) -> DataFrame:
    """``scd1_rows`` with keys for the products that have none."""
    rows = stage("products", scd1_rows(dim, changes))
    added = assign_keys(rows.filter("product_key IS NULL").drop("product_key"), "product_key", dim if after is None else after, stage)
    schema = schemas.DIM_PRODUCT
    return _shape(rows.filter("product_key IS NOT NULL"), schema).unionByName(_shape(added, schema))


# --- inferred members for sales that arrive before their dimension rows ------------------------------------------


def _unknown_ids(sales: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Ids without any dimension row, with their smallest ingest metadata.

    Grouping comes first: its map-side half reduces a hot id to one row per task before anything is shuffled.
    """
    ids = sales.groupBy(key).agg(*(F.min(c).alias(c) for c in _META))
    return absent_from(ids, dim, key)


def infer_customers(
    sales: DataFrame, dim: DataFrame, after: int | DataFrame | None = None, stage: Stage = in_scratch
) -> DataFrame:
    """Placeholder versions, valid for all time, for customers in no version of ``dim``."""
    rows = _unknown_ids(sales, dim, "customer_id").withColumns(
        {
            "customer_name": F.lit(UNKNOWN), "region": F.lit(UNKNOWN), "segment": F.lit(UNKNOWN),
            "effective_start_date": _ts(OPEN_START), "effective_end_date": _ts(OPEN_END),
            "is_current": F.lit(True), "is_inferred": F.lit(True),
        }
    )
    keyed = assign_keys(rows, "customer_key", dim if after is None else after, stage)
    return _shape(keyed, schemas.DIM_CUSTOMER)


def infer_products(
    sales: DataFrame, dim: DataFrame, after: int | DataFrame | None = None, stage: Stage = in_scratch
) -> DataFrame:
    rows = _unknown_ids(sales, dim, "product_id").withColumns(
        {
            "product_name": F.lit(UNKNOWN), "category": F.lit(UNKNOWN), "brand": F.lit(UNKNOWN),
            "is_active": F.lit(True), "is_inferred": F.lit(True),
        }
    )
    keyed = assign_keys(rows, "product_key", dim if after is None else after, stage)
    return _shape(keyed, schemas.DIM_PRODUCT)
