"""Declared schemas of every layer. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "price": T.DecimalType(12, 2),
    "amount": T.DecimalType(14, 2),
    "variant": T.VariantType(),
}


def _schema(*columns: str) -> T.StructType:
    """``"name type"`` per column; a trailing ``!`` on the type marks it required."""
    fields = []
    for column in columns:
        name, kind = column.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


BUSINESS_COLUMNS = {
    "customers": ("customer_id", "customer_name", "email", "phone", "region", "segment", "created_at", "updated_at"),
    "products": (
        "product_id", "product_name", "category", "brand", "unit_price", "created_at", "updated_at", "is_active",
    ),
    "stores": ("store_id", "store_name", "city", "state", "region", "store_type", "opened_date"),
    "sales": (
        "sale_id", "sale_timestamp", "customer_id", "product_id", "store_id", "quantity", "unit_price",
        "discount_amount", "payment_method",
    ),
}

KEYS = {"customers": "customer_id", "products": "product_id", "stores": "store_id", "sales": "sale_id"}

_RAW_META = ("_source_file string", "_loaded_at ts", "_batch_id string", "_row_number long")
_META = ("_source_file string", "_batch_id string", "_loaded_at ts")

RAW = {
    entity: _schema(*(f"{name} string" for name in columns), *_RAW_META)
    for entity, columns in BUSINESS_COLUMNS.items()
}

SILVER = {
    "customers": _schema(
        "customer_id string!", "customer_name string", "email string", "phone string", "region string",
        "segment string", "created_at ts", "updated_at ts", *_META,
    ),
    "products": _schema(
        "product_id string!", "product_name string", "category string", "brand string", "unit_price price",
        "created_at ts", "updated_at ts", "is_active bool", *_META,
    ),
    "stores": _schema(
        "store_id string!", "store_name string", "city string", "state string", "region string",
        "store_type string", "opened_date date", *_META,
    ),
    "sales": _schema(
        "sale_id string!", "sale_timestamp ts", "customer_id string", "product_id string", "store_id string",
        "quantity long", "unit_price price", "discount_amount price", "payment_method string", *_META,
    ),
}

REJECTED_RECORDS = _schema(
    "source_file string", "entity_name string", "business_key string", "rejection_reason string",
    "raw_record variant", "batch_id string", "rejected_at ts",
)

DIM_CUSTOMER = _schema(
    "customer_key long!", "customer_id string!", "customer_name string", "email string", "phone string",
    "region string", "segment string", "effective_start_date ts!", "effective_end_date ts!", "is_current bool!",
    "is_inferred bool!", *_META,
)
DIM_PRODUCT = _schema(
    "product_key long!", "product_id string!", "product_name string", "category string", "brand string",
    "unit_price price", "created_at ts", "updated_at ts", "is_active bool", "is_inferred bool!", *_META,
)
DIM_STORE = _schema(
    "store_key long!", "store_id string!", "store_name string", "city string", "state string", "region string",
    "store_type string", "opened_date date", "is_inferred bool!", *_META,
)
DIM_DATE = _schema(
    "date_key int!", "full_date date!", "day int", "month int", "month_name string", "quarter int", "year int",
    "week int", "day_of_week int", "day_name string", "is_weekend bool",
)
FACT_SALES = _schema(
    "sale_key long!", "sale_id string!", "date_key int!", "customer_key long!", "product_key long!",
    "store_key long!", "sale_timestamp ts!", "quantity long!", "unit_price price!", "discount price!",
    "gross_amount amount!", "discount_amount amount!", "net_amount amount!", "payment_method string", *_META,
)
DAILY_SALES_SUMMARY = T.StructType(
    [
        T.StructField("sale_date", T.DateType()),
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_quantity", T.LongType()),
        T.StructField("gross_sales", T.DecimalType(24, 2)),
        T.StructField("discount_amount", T.DecimalType(24, 2)),
        T.StructField("net_sales", T.DecimalType(24, 2)),
    ]
)

RUN_EVENTS = _schema(
    "run_id string!", "batch_id string", "entity string", "process_name string", "event_at ts!", "status string!",
    "records_read long", "records_rejected long", "records_written long", "error_message string",
)
PIPELINE_MONITORING = _schema(
    "batch_id string", "entity string", "process_name string", "records_processed long", "process_time ts",
    "status string",
)
