"""Registered queries: each pairs a Spark query over the driver's tables with the SQL that states its expected result.

Two kinds: plans built from the raw rows on the spot (``landed`` treats everything landed as one load), and reports on
the tables after the initial load and both batches (``state``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import masking, parse
from ledgerline.operators import analytics, audit, checks, cleanse, dedup, dimensions, fact, merge, quarantine, silver
from ledgerline.operators.keys import as_read, assign_keys
from ledgerline.plans import incremental
from ledgerline.session import remove, scratch_dir
from ledgerline.sources import landing, raw as raw_layer
from ledgerline.streaming import feeds
from ledgerline.streaming.tables import Tables
from workloads import oracle, retail, warehouse
from workloads.oracle import statement

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ENTITIES = tuple(schemas.BUSINESS_COLUMNS)


def _query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = statement(sql)
        return run

    return register


def _landed(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return warehouse.landed(spark, sf_dir, entity)


def _assessed(spark: SparkSession, sf_dir: str, entity: str, path: str = "initial", batch_id: str | None = None) -> DataFrame:
    return silver.assessed(warehouse.landed(spark, sf_dir, entity, batch_id), entity, path)


def _silver(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return silver.load_silver(_assessed(spark, sf_dir, entity), entity)


def _now():
    return F.lit(retail.LOADED_AT["BATCH_02"]).cast("timestamp_ntz")


def _rejects_out(df: DataFrame) -> DataFrame:
    """Quarantine rows for comparison: payload as JSON text, without the wall-clock column."""
    return df.withColumn("raw_record", F.to_json("raw_record")).drop("rejected_at")


# --- flagship: everything landed, to facts and totals per day -----------------------------------------------------


def _initial_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        dimensions.init_dim_customer(_silver(spark, sf_dir, "customers")),
        dimensions.init_dim_product(_silver(spark, sf_dir, "products")),
        dimensions.init_dim_store(_silver(spark, sf_dir, "stores")),
    )


_LANDED_DIMS = f"""c_all AS ({oracle.latest_valid('customers')}), p_all AS ({oracle.latest_valid('products')}),
  t_all AS ({oracle.latest_valid('stores')}), s_all AS ({oracle.latest_valid('sales')}),
  f_all AS (SELECT s.sale_id, cast(strftime(s.sale_timestamp, '%Y%m%d') AS int) AS date_key, c.customer_id, p.product_id,
      t.store_id, s.sale_timestamp, s.quantity, s.unit_price, s.discount_amount AS discount,
      cast(s.quantity * s.unit_price AS decimal(14,2)) AS gross_amount, cast(s.discount_amount AS decimal(14,2)) AS discount_amount,
      cast(s.quantity * s.unit_price - s.discount_amount AS decimal(14,2)) AS net_amount, s.payment_method,
      s._source_file, s._batch_id, s._loaded_at
    FROM s_all s JOIN c_all c ON c.customer_id = s.customer_id AND c.created_at <= s.sale_timestamp
    JOIN p_all p ON p.product_id = s.product_id JOIN t_all t ON t.store_id = s.store_id)"""


def _landed_sql(body: str) -> str:
    """``body`` over ``f_all`` and the other frames of the load of everything landed."""
    text = statement(f"SELECT 1 FROM ({oracle.latest_valid('customers')}), ({oracle.latest_valid('products')}), "
                     f"({oracle.latest_valid('stores')}), ({oracle.latest_valid('sales')})")
    parts = text[: text.rindex("SELECT 1 FROM")].rstrip()
    return f"{parts}, {_LANDED_DIMS}\n{body}"


@_query("daily_sales_summary")
def daily_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals need the dimension members a sale matches, not their numbers, so none are assigned."""
    unnumbered = F.lit(None).cast("bigint")
    customers = _silver(spark, sf_dir, "customers").select(
        "customer_id", F.col("created_at").alias("effective_start_date"),
        F.lit(dimensions.OPEN_END).cast("timestamp_ntz").alias("effective_end_date"), unnumbered.alias("customer_key"),
    )
    products = _silver(spark, sf_dir, "products").select("product_id", unnumbered.alias("product_key"))
    stores = _silver(spark, sf_dir, "stores").select("store_id", unnumbered.alias("store_key"))
    return fact.daily_sales_summary(fact.fact_rows(_silver(spark, sf_dir, "sales"), customers, products, stores))


ORACLE["daily_sales_summary"] = _landed_sql(
    """SELECT cast(sale_timestamp AS date) AS sale_date, count(DISTINCT sale_id) AS total_orders,
  cast(sum(quantity) AS bigint) AS total_quantity, cast(sum(gross_amount) AS decimal(24,2)) AS gross_sales,
  cast(sum(discount_amount) AS decimal(24,2)) AS discount_amount, cast(sum(net_amount) AS decimal(24,2)) AS net_sales
FROM f_all GROUP BY 1"""
)


def _natural(rows: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Fact rows with the members their keys point at, in place of the keys."""
    return (
        rows.join(customers.select("customer_key", "customer_id", F.col("effective_start_date").alias("version_start")), "customer_key")
        .join(products.select("product_key", "product_id"), "product_key")
        .join(stores.select("store_key", "store_id"), "store_key")
        .drop("sale_key", "customer_key", "product_key", "store_key")
    )


@_query("fact_sales_initial")
def fact_sales_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = _initial_dims(spark, sf_dir)
    return _natural(fact.build_fact(_silver(spark, sf_dir, "sales"), *dims), *dims).drop("version_start")


ORACLE["fact_sales_initial"] = _landed_sql("SELECT * FROM f_all")

# --- cleansing and parsing ----------------------------------------------------------------------------------------

for _entity in ENTITIES:

    @_query(
        f"clean_{_entity}",
        f"SELECT {oracle.columns(_entity)}, _source_file, _batch_id, _loaded_at, _row_number FROM typed_{_entity}",
    )
    def _clean(spark: SparkSession, sf_dir: str, entity: str = _entity) -> DataFrame:
        return cleanse.clean(_landed(spark, sf_dir, entity), entity).drop(cleanse.ORIGINAL)

    @_query(f"rejects_{_entity}", oracle.rejects(_entity))
    def _rejects(spark: SparkSession, sf_dir: str, entity: str = _entity) -> DataFrame:
        assessed = _assessed(spark, sf_dir, entity)
        return _rejects_out(quarantine.rejected(assessed, entity, _now()))

    @_query(f"silver_{_entity}", oracle.latest_valid(_entity))
    def _silver_of(spark: SparkSession, sf_dir: str, entity: str = _entity) -> DataFrame:
        return _silver(spark, sf_dir, entity)


_PARSED_TEXTS = {
    "customers": ("customer_id", "customer_name", "email", "phone", "region", "segment", "created_at", "updated_at"),
    "products": ("product_id", "category", "unit_price", "created_at", "updated_at", "is_active"),
    "stores": ("store_id", "state", "region", "store_type", "opened_date"),
    "sales": ("sale_timestamp", "quantity", "unit_price", "discount_amount", "payment_method"),
}


@_query(
    "parse_matrix",
    "SELECT value, count(*) AS occurrences, " + ", ".join(
        f"any_value({expr}) AS {name}" for name, expr in (
            ("as_text", oracle.text("value")), ("as_timestamp", oracle.stamp("value")), ("as_date", oracle.stamp("value", "date")),
            ("as_integer", oracle.integer("value")), ("as_money", oracle.money("value")), ("as_wide_money", oracle.money("value", 18)),
            ("as_boolean", oracle.flag("value")), ("is_email", oracle.email("value")),
        )
    ) + " FROM (" + " UNION ALL ".join(
        f"SELECT unnest([{c}, {c} || chr(10)]) AS value FROM raw_{entity}" for entity, names in _PARSED_TEXTS.items() for c in names
    ) + ") GROUP BY value",
)
def parse_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the parsed columns, as it is and with a final newline, through every parser, once per distinct text."""
    texts = None
    for entity, names in _PARSED_TEXTS.items():
        column = _landed(spark, sf_dir, entity).select(
            F.explode(F.array(*names, *(F.concat(n, F.lit("\n")) for n in names))).alias("value"))
        texts = column if texts is None else texts.unionByName(column)
    value = F.col("value")
    return texts.groupBy("value").agg(F.count(F.lit(1)).alias("occurrences")).select(
        "value", "occurrences", parse.text(value).alias("as_text"), parse.timestamp(value).alias("as_timestamp"),
        parse.date(value).alias("as_date"), parse.integer(value).alias("as_integer"), parse.money(value).alias("as_money"),
        parse.money(value, 18).alias("as_wide_money"),
        parse.boolean(value).alias("as_boolean"), parse.is_email(value).alias("is_email"),
    )


# --- quarantine and deduplication ---------------------------------------------------------------------------------


@_query(
    "rejects_by_reason",
    "SELECT entity_name, rejection_reason, count(*) AS rejected_rows FROM ("
    + " UNION ALL ".join(f"({oracle.rejects(e)})" for e in ENTITIES) + ") GROUP BY ALL",
)
def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = None
    for entity in ENTITIES:
        rows = quarantine.rejected(_assessed(spark, sf_dir, entity), entity, _now())
        found = rows if found is None else found.unionByName(rows)
    return checks.rejects_by_reason(found)


@_query("dedup_latest_then_validate", oracle.valid_latest("customers", None, True))
def dedup_latest_then_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customer_changes(_assessed(spark, sf_dir, "customers", "batch"))


@_query("dedup_latest_valid", oracle.latest_valid("customers"))
def dedup_latest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = _assessed(spark, sf_dir, "customers")
    return dedup.latest_valid(assessed, "customers").select(*schemas.SILVER["customers"].fieldNames())


@_query("sales_batch_valid", oracle.valid_latest("sales", None, False))
def sales_batch_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.valid_sales(_assessed(spark, sf_dir, "sales", "batch"))


@_query("sales_batch_duplicates", oracle.duplicates())
def sales_batch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The rows lie in files as landed; only those that may be superseded are written again.
    return _rejects_out(quarantine.duplicate_sales(cleanse.clean_sales(_landed(spark, sf_dir, "sales")), _now(), as_read))


@_query("rejects_sales_batch", oracle.rejects("sales", None, "batch"))
def rejects_sales_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = _assessed(spark, sf_dir, "sales", "batch")
    return _rejects_out(quarantine.rejected(assessed, "sales", _now()))


@_query("rejects_customer_batch", oracle.rejects("customers", None, "batch"))
def rejects_customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = _assessed(spark, sf_dir, "customers", "batch")
    return _rejects_out(quarantine.rejected(assessed, "customers", _now()))


# --- dimensions ---------------------------------------------------------------------------------------------------


@_query(
    "dim_customer_initial",
    f"""SELECT customer_id, customer_name, email, phone, region, segment, created_at AS effective_start_date,
        timestamp '9999-12-31 23:59:59' AS effective_end_date, true AS is_current, false AS is_inferred,
        _source_file, _batch_id, _loaded_at FROM ({oracle.latest_valid('customers')})""",
)
def dim_customer_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _initial_dims(spark, sf_dir)[0].drop("customer_key")


@_query("dim_product_initial", f"SELECT *, false AS is_inferred FROM ({oracle.latest_valid('products')})")
def dim_product_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _initial_dims(spark, sf_dir)[1].drop("product_key")


@_query("dim_store_initial", f"SELECT *, false AS is_inferred FROM ({oracle.latest_valid('stores')})")
def dim_store_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _initial_dims(spark, sf_dir)[2].drop("store_key")


@_query(
    "dim_date",
    """SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, d AS full_date, cast(day(d) AS int) AS day,
        cast(month(d) AS int) AS month, left(monthname(d), 3) AS month_name, cast(quarter(d) AS int) AS quarter,
        cast(year(d) AS int) AS year, cast(weekofyear(d) AS int) AS week, cast(isodow(d) AS int) AS day_of_week,
        left(dayname(d), 3) AS day_name, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT cast(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS d
          FROM (SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem))""",
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of all days from the first to the last sale."""
    return dimensions.build_dim_date(spark, *warehouse.calendar(spark, sf_dir))


@_query(
    "surrogate_keys",
    f"""SELECT count(*) AS row_count, cast(1 AS bigint) AS first_key, count(*) AS last_key, count(*) AS distinct_keys
        FROM ({oracle.latest_valid('sales')})""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _silver(spark, sf_dir, "sales").select("sale_id")
    return assign_keys(sales, "sale_key").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("sale_key").alias("first_key"),
        F.max("sale_key").alias("last_key"), F.countDistinct("sale_key").alias("distinct_keys"),
    )


@_query(
    "merge_insert_only",
    f"""SELECT * FROM customers_0 UNION ALL SELECT * FROM ({oracle.latest_valid('customers')})
        WHERE customer_id NOT IN (SELECT customer_id FROM customers_0)""",
)
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial customers, completed by customers that came later."""
    target = silver.load_silver(_assessed(spark, sf_dir, "customers", batch_id="INITIAL"), "customers")
    return merge.insert_missing(target, _silver(spark, sf_dir, "customers"), "customer_id")


@_query(
    "merge_update_from",
    f"""SELECT t.customer_id, t.customer_name, t.email, t.phone, t.region,
            CASE WHEN s.updated_at > t.updated_at THEN s.segment ELSE t.segment END AS segment, t.created_at,
            CASE WHEN s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END AS updated_at,
            t._source_file, t._batch_id, t._loaded_at
        FROM customers_0 t LEFT JOIN ({oracle.valid_latest('customers', None, True)}) s ON s.customer_id = t.customer_id""",
)
def merge_update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial customers with the segment of their newest valid change."""
    target = silver.load_silver(_assessed(spark, sf_dir, "customers", batch_id="INITIAL"), "customers")
    changes = silver.customer_changes(_assessed(spark, sf_dir, "customers", "batch"))
    newer = F.col("s.updated_at") > F.col("t.updated_at")
    values = {name: F.col(f"s.{name}") for name in ("segment", "updated_at")}
    return merge.update_from(target, changes, "customer_id", newer, values)


_VERSIONS = ("customer_id", "customer_name", "email", "phone", "region", "segment", "effective_start_date",
             "effective_end_date", "is_current", "is_inferred", "_source_file", "_batch_id", "_loaded_at")


@_query("scd2_apply", f"SELECT {', '.join(_VERSIONS)} FROM versions_1")
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial members, then one batch of changes."""
    initial = silver.load_silver(_assessed(spark, sf_dir, "customers", batch_id="INITIAL"), "customers")
    changes = silver.customer_changes(_assessed(spark, sf_dir, "customers", "batch", "BATCH_01"))
    now = F.lit(retail.LOADED_AT["BATCH_01"]).cast("timestamp_ntz")
    return dimensions.scd2_apply(dimensions.init_dim_customer(initial), changes, now).select(*_VERSIONS)


@_query(
    "point_in_time_join",
    f"""SELECT s.sale_id, s.customer_id, s.sale_timestamp, c.effective_start_date, c.segment
        FROM ({oracle.latest_valid('sales')}) s JOIN dim_customer_2 c ON c.customer_id = s.customer_id
        AND c.effective_start_date <= s.sale_timestamp AND s.sale_timestamp < c.effective_end_date""",
)
def point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _silver(spark, sf_dir, "sales")
    versions = warehouse.state(spark, sf_dir).dim_customer()
    joined = fact.point_in_time_join(sales, versions, "effective_start_date", "segment")
    return joined.select("sale_id", "customer_id", "sale_timestamp", "effective_start_date", "segment")


# --- tables after the initial load and both batches ---------------------------------------------------------------

for _batch_id, _n in (("INITIAL", 0), ("BATCH_01", 1), ("BATCH_02", 2)):
    _suffix = f"after_{_batch_id.lower()}"

    @_query(f"dim_customer_{_suffix}", f"SELECT {', '.join(_VERSIONS)} FROM dim_customer_{_n}")
    def _dim_customer(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        return warehouse.state(spark, sf_dir, batch_id).dim_customer().select(*_VERSIONS)

    @_query(f"dim_product_{_suffix}", f"SELECT * FROM dim_product_{_n}")
    def _dim_product(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        return warehouse.state(spark, sf_dir, batch_id).read("gold/dim_product").drop("product_key")

    @_query(f"fact_{_suffix}", f"SELECT * FROM fact_{_n}")
    def _fact(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        state = warehouse.state(spark, sf_dir, batch_id)
        stores = state.read("gold/dim_store")
        return _natural(state.read("gold/fact_sales"), state.dim_customer(), state.read("gold/dim_product"), stores)

    @_query(f"daily_summary_{_suffix}", f"SELECT * FROM summary_{_n}")
    def _summary(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        return warehouse.state(spark, sf_dir, batch_id).read("gold/daily_sales_summary")

    @_query(f"rejected_records_{_suffix}", f"SELECT * FROM rejects_{_n}")
    def _rejected(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        return _rejects_out(warehouse.state(spark, sf_dir, batch_id).read("silver/rejected_records"))

    @_query(f"silver_customers_{_suffix}", f"SELECT * FROM customers_{_n}")
    def _silver_customers(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        return warehouse.state(spark, sf_dir, batch_id).read("silver/customers")

    @_query(f"silver_sales_{_suffix}", f"SELECT * FROM sales_{_n}")
    def _silver_sales(spark: SparkSession, sf_dir: str, batch_id: str = _batch_id) -> DataFrame:
        return warehouse.state(spark, sf_dir, batch_id).read("silver/sales")


@_query("silver_products_after_batch_02", "SELECT * FROM products_2")
def silver_products_after_batch_02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.state(spark, sf_dir).read("silver/products")


@_query("new_valid_sales", "SELECT * FROM new_sales_2")
def new_valid_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = warehouse.state(spark, sf_dir, "BATCH_01")
    valid = silver.valid_sales(_assessed(spark, sf_dir, "sales", "batch", "BATCH_02"))
    return fact.new_valid_sales(valid, before.read("silver/sales"), before.read("gold/fact_sales"))


@_query("inferred_customers", f"SELECT {', '.join(_VERSIONS)} FROM inferred_customers_1")
def inferred_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.state(spark, sf_dir, "BATCH_01").dim_customer().filter("is_inferred").select(*_VERSIONS)


@_query("inferred_products", "SELECT * FROM inferred_products_1")
def inferred_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = warehouse.state(spark, sf_dir, "BATCH_01").read("gold/dim_product")
    return dim.filter("is_inferred").drop("product_key")


@_query(
    "resolve_inferred",
    """SELECT o.customer_id, n.customer_name, n.region, n.is_inferred AS still_inferred, true AS same_key
       FROM dim_customer_1 o JOIN dim_customer_2 n ON n.customer_id = o.customer_id
            AND n.effective_start_date = o.effective_start_date WHERE o.is_inferred""",
)
def resolve_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members inferred by the first batch, as they are after the second, found by their key."""
    was = warehouse.state(spark, sf_dir, "BATCH_01").dim_customer().filter("is_inferred")
    now = warehouse.state(spark, sf_dir).dim_customer()
    pairs = was.select("customer_key", F.col("customer_id").alias("was_id")).join(now, "customer_key")
    return pairs.select(
        "customer_id", "customer_name", "region", F.col("is_inferred").alias("still_inferred"),
        (F.col("was_id") == F.col("customer_id")).alias("same_key"),
    )


@_query(
    "stream_replay_idempotent",
    "SELECT check_name, value AS rows_before, value AS rows_after FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS value FROM {part}" for name, part in (
            ("SILVER_CUSTOMERS", "customers_2"), ("SILVER_PRODUCTS", "products_2"), ("SILVER_SALES", "sales_2"),
            ("REJECTED_RECORDS", "rejects_2"), ("DIM_CUSTOMER", "dim_customer_2"), ("DIM_PRODUCT", "dim_product_2"),
            ("FACT_SALES", "fact_2"),
        )
    ) + ")",
)
def stream_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch processed once more under new names: no table grows."""

    def sizes(state) -> DataFrame:
        return checks.table_counts(
            {
                "SILVER_CUSTOMERS": state.read("silver/customers"), "SILVER_PRODUCTS": state.read("silver/products"),
                "SILVER_SALES": state.read("silver/sales"), "REJECTED_RECORDS": state.read("silver/rejected_records"),
                "DIM_CUSTOMER": state.dim_customer(), "DIM_PRODUCT": state.read("gold/dim_product"),
                "FACT_SALES": state.read("gold/fact_sales"),
            }
        )

    tables = warehouse.state(spark, sf_dir)
    before, label = sizes(tables).collect(), f"replay-{tables.last().load}"  # seven counts
    for entity, process in (
        ("customers", incremental.process_customers), ("products", incremental.process_products),
        ("sales", incremental.process_sales),
    ):
        batch = raw_layer.read_raw(spark, tables.root, entity, "BATCH_02")
        process(tables, batch, label, entity, lambda: datetime(2002, 4, 1))
    return checks.rerun_comparison(spark.createDataFrame(before, "check_name string, value long"), sizes(tables))


# --- reports and masking ------------------------------------------------------------------------------------------


@_query("daily_revenue", "SELECT sale_date, net_sales FROM summary_2")
def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.daily_revenue(warehouse.state(spark, sf_dir).read("gold/daily_sales_summary"))


@_query(
    "revenue_by_region",
    """SELECT c.region, cast(sum(f.net_amount) AS decimal(34,2)) AS net_sales FROM fact_2 f JOIN dim_customer_2 c
       ON c.customer_id = f.customer_id AND c.effective_start_date = f.version_start GROUP BY 1""",
)
def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = warehouse.state(spark, sf_dir)
    return analytics.revenue_by_region(state.read("gold/fact_sales"), state.dim_customer())


@_query(
    "revenue_by_category",
    """SELECT p.category, cast(sum(f.net_amount) AS decimal(34,2)) AS net_sales, cast(sum(f.quantity) AS bigint) AS units
       FROM fact_2 f JOIN dim_product_2 p ON p.product_id = f.product_id GROUP BY 1""",
)
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = warehouse.state(spark, sf_dir)
    return analytics.revenue_by_category(state.read("gold/fact_sales"), state.read("gold/dim_product"))


@_query(
    "store_performance",
    """SELECT t.store_id, t.city, cast(sum(f.net_amount) AS decimal(34,2)) AS net_sales
       FROM fact_2 f JOIN dim_store t ON t.store_id = f.store_id GROUP BY 1, 2""",
)
def store_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = warehouse.state(spark, sf_dir)
    return analytics.store_performance(state.read("gold/fact_sales"), state.read("gold/dim_store"))


@_query(
    "masked_customers",
    """SELECT 'DATA_ENGINEER' AS viewer, customer_id, email, effective_start_date FROM dim_customer_2
       UNION ALL SELECT 'DATA_VIEWER', customer_id, '***MASKED***', effective_start_date FROM dim_customer_2""",
)
def masked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = warehouse.state(spark, sf_dir).dim_customer()
    views = [
        masking.masked_view(dim, viewer).select(F.lit(viewer).alias("viewer"), "customer_id", "email", "effective_start_date")
        for viewer in ("DATA_ENGINEER", "DATA_VIEWER")
    ]
    return views[0].unionByName(views[1])


# --- checks and audit ---------------------------------------------------------------------------------------------


def _raws(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = warehouse.built(spark, sf_dir).root
    return {entity: raw_layer.read_raw(spark, root, entity) for entity in ENTITIES}


@_query(
    "check_raw_counts",
    " UNION ALL ".join(
        f"""SELECT '{e.upper()}' AS entity, count(*) AS row_count, count(DISTINCT _source_file) AS files,
            count(DISTINCT _batch_id) AS batches FROM raw_{e}""" for e in ENTITIES
    ),
)
def check_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.raw_counts(_raws(spark, sf_dir))


@_query(
    "check_raw_duplicates",
    " UNION ALL ".join(
        f"SELECT '{e.upper()}' AS entity, count(*) - count(DISTINCT {schemas.KEYS[e]}) AS duplicate_rows FROM raw_{e}"
        for e in ENTITIES
    ),
)
def check_raw_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_rows(_raws(spark, sf_dir))


@_query(
    "check_batch_rows",
    " UNION ALL ".join(
        f"SELECT _batch_id, '{e.upper()}' AS entity, count(*) AS row_count FROM raw_{e} GROUP BY 1" for e in ENTITIES
    ),
)
def check_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.batch_rows(_raws(spark, sf_dir))


_SILVER_PARTS = {"customers": "customers_2", "products": "products_2", "stores": "stores_0", "sales": "sales_2"}


@_query(
    "check_key_uniqueness",
    " UNION ALL ".join(
        f"SELECT '{e.upper()}' AS entity, count(*) AS row_count, count(DISTINCT {schemas.KEYS[e]}) AS distinct_keys FROM {p}"
        for e, p in _SILVER_PARTS.items()
    ),
)
def check_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = warehouse.state(spark, sf_dir)
    return checks.key_counts({e: state.read(f"silver/{e}") for e in ENTITIES})


@_query(
    "check_layer_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS value FROM {part}" for name, part in (
            *((f"RAW_{e.upper()}", f"raw_{e}") for e in ENTITIES),
            *((f"SILVER_{e.upper()}", p) for e, p in _SILVER_PARTS.items()),
            ("REJECTED_RECORDS", "rejects_2"), ("DIM_CUSTOMER", "dim_customer_2"), ("DIM_PRODUCT", "dim_product_2"),
            ("DIM_STORE", "dim_store"), ("FACT_SALES", "fact_2"),
        )
    ) + " UNION ALL SELECT 'DIM_DATE', cast(max(l_shipdate) AS date) - cast(min(l_shipdate) AS date) + 1 FROM lineitem",
)
def check_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = warehouse.state(spark, sf_dir)
    tables = {f"RAW_{e.upper()}": df for e, df in _raws(spark, sf_dir).items()}
    tables |= {f"SILVER_{e.upper()}": state.read(f"silver/{e}") for e in ENTITIES}
    tables |= {
        "REJECTED_RECORDS": state.read("silver/rejected_records"), "DIM_CUSTOMER": state.dim_customer(),
        "DIM_PRODUCT": state.read("gold/dim_product"), "DIM_STORE": state.read("gold/dim_store"),
        "FACT_SALES": state.read("gold/fact_sales"), "DIM_DATE": state.read("gold/dim_date"),
    }
    return checks.table_counts(tables)


@_query(
    "check_scd2_current",
    """SELECT customer_id, cast(2 AS bigint) AS current_rows FROM dim_customer_2 WHERE is_current AND segment = 'VIP'""",
)
def check_scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a dimension in which a fault opened every VIP twice; the loaded dimension by itself has no such customer."""
    dim = warehouse.state(spark, sf_dir).dim_customer()
    return checks.multiple_current_versions(dim.unionByName(dim.filter("is_current AND segment = 'VIP'")))


@_query(
    "check_fact_orphans",
    """SELECT 'customer_key' AS dimension, count(*) FILTER (NOT c.is_current) AS orphans FROM fact_2 f JOIN dim_customer_2 c
         ON c.customer_id = f.customer_id AND c.effective_start_date = f.version_start
       UNION ALL SELECT 'product_key', count(*) FROM fact_2 f JOIN dim_product_2 p USING (product_id) WHERE p.category = 'PROMO'
       UNION ALL SELECT 'store_key', count(*) FROM fact_2 f JOIN dim_store t USING (store_id) WHERE t.region = 'ASIA'
       UNION ALL SELECT 'date_key', count(*) FROM fact_2 WHERE date_key >= 19990101""",
)
def check_fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On dimensions that lost closed versions, promotional products, the stores of a region and all days from 1999 on."""
    state = warehouse.state(spark, sf_dir)
    return checks.fact_orphans(
        state.read("gold/fact_sales"), state.dim_customer().filter("is_current"),
        state.read("gold/dim_product").filter("category IS NULL OR category <> 'PROMO'"),
        state.read("gold/dim_store").filter("region IS NULL OR region <> 'ASIA'"), state.read("gold/dim_date").filter("date_key < 19990101"),
    )


@_query("check_no_orphans", "SELECT dimension, cast(0 AS bigint) AS orphans FROM (VALUES ('customer_key'), ('product_key'), ('store_key'), ('date_key')) t(dimension)")
def check_no_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables as loaded."""
    state = warehouse.state(spark, sf_dir)
    return checks.fact_orphans(
        state.read("gold/fact_sales"), state.dim_customer(), state.read("gold/dim_product"), state.read("gold/dim_store"),
        state.read("gold/dim_date"),
    )


@_query(
    "check_undated_facts",
    """SELECT date_key, cast(sale_timestamp AS date) AS full_date, count(*) AS fact_rows FROM fact_2
       WHERE date_key % 100 = 31 GROUP BY 1, 2""",
)
def check_undated_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a calendar without the 31st of any month; the loaded one covers all sales (``check_no_orphans``)."""
    state = warehouse.state(spark, sf_dir)
    return checks.undated_facts(state.read("gold/fact_sales"), state.read("gold/dim_date").filter("day <> 31"))


@_query(
    "check_duplicate_keys",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {key} AS business_key, cast(2 AS bigint) AS row_count FROM {part} WHERE right({key}, 1) = '7'"
        for name, part, key in (
            *((e, p, schemas.KEYS[e]) for e, p in _SILVER_PARTS.items()), ("fact_sales", "fact_2", "sale_id"),
        )
    ),
)
def check_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On tables into which a fault wrote the keys that end in 7 twice; the loaded tables have no repeated key."""
    state = warehouse.state(spark, sf_dir)
    sides = [(e, state.read(f"silver/{e}"), schemas.KEYS[e]) for e in ENTITIES]
    sides.append(("fact_sales", state.read("gold/fact_sales"), "sale_id"))
    found = [
        checks.duplicate_keys(df.unionByName(df.filter(F.col(key).endswith("7"))), key)
        .select(F.lit(name).alias("table_name"), F.col(key).alias("business_key"), "row_count")
        for name, df, key in sides
    ]
    return checks.stack(found)


@_query(
    "check_quarantine_duplicates",
    """SELECT source_file, entity_name, business_key, batch_id, rejection_reason, count(*) AS quarantine_rows
       FROM rejects_2 GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1""",
)
def check_quarantine_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.quarantine_duplicates(warehouse.state(spark, sf_dir).read("silver/rejected_records"))


@_query(
    "scd2_version_history",
    """SELECT customer_id, email, effective_start_date, effective_end_date, is_current, is_inferred FROM dim_customer_2""",
)
def scd2_version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.version_history(warehouse.state(spark, sf_dir).dim_customer()).drop("customer_key")


@_query(
    "check_inferred_state",
    """SELECT customer_id, count(*) AS versions, count(*) FILTER (is_inferred) AS inferred_rows
       FROM dim_customer_2 GROUP BY 1""",
)
def check_inferred_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.inferred_state(warehouse.state(spark, sf_dir).dim_customer()).drop("customer_key")


@_query("check_product_prices", "SELECT product_id, unit_price, updated_at FROM dim_product_2")
def check_product_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.product_prices(warehouse.state(spark, sf_dir).read("gold/dim_product"))


@_query(
    "batch_fact_totals",
    """SELECT _batch_id, count(*) AS fact_rows, cast(sum(net_amount) AS decimal(24,2)) AS net_sales
       FROM fact_2 GROUP BY 1""",
)
def batch_fact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.batch_fact_totals(warehouse.state(spark, sf_dir).read("gold/fact_sales"))


@_query(
    "checkpoint_upsert",
    """SELECT 'INITIAL' AS batch_id, 'ALL' AS entity, 'INITIAL_LOAD' AS process_name,
        (SELECT count(*) FROM fact_2) AS records_processed, 'SUCCESS' AS status""",
)
def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint written by the initial load, brought up to the present fact."""
    state = warehouse.state(spark, sf_dir)
    row = audit.checkpoint(state.read("gold/fact_sales"), _now())
    return audit.upsert_checkpoint(state.read("control/pipeline_monitoring"), row).drop("process_time")


@_query(
    "run_log",
    " UNION ALL ".join(
        f"""SELECT '{batch}' AS batch_id, '{entity}' AS entity, '{process}' AS process_name, 'SUCCESS' AS status,
            (SELECT count(*) FROM raw_{source} WHERE _batch_id = '{batch}') AS records_read,
            {" + ".join(f"(SELECT count(*) FROM {r}_{n})" for r in rejected)} AS records_rejected,
            (SELECT count(*) FROM {written}_{n}) AS records_written, cast(NULL AS varchar) AS error_message"""
        for n, batch in ((1, "BATCH_01"), (2, "BATCH_02"))
        for entity, process, source, rejected, written in (
            ("CUSTOMER", "PROCESS_CUSTOMER_INCREMENTAL", "customers", ("rejects_customers",), "customer_changes"),
            ("PRODUCT", "PROCESS_PRODUCT_INCREMENTAL", "products", ("rejects_products",), "product_changes"),
            ("SALES", "PROCESS_SALES_INCREMENTAL", "sales", ("rejects_sales", "duplicate_sales"), "new_sales"),
        )
    ) + """ UNION ALL SELECT 'BATCH_02', 'CUSTOMER', 'PROCESS_CUSTOMER_INCREMENTAL', 'FAILED',
        (SELECT count(*) FROM raw_customers WHERE _batch_id = 'BATCH_02'), 0, 0, 'broken file'""",
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of the batches, the one that was made to fail included; replays by other queries are left out by their feed."""
    tables = warehouse.built(spark, sf_dir)
    until = F.lit(retail.LOADED_AT["BATCH_02"]).cast("timestamp_ntz")
    events = incremental.run_events(tables).filter(F.col("event_at") <= until)
    message = F.when(F.col("error_message").contains("broken file"), "broken file").otherwise(F.col("error_message"))
    return audit.latest_runs(audit.run_log(events)).withColumn("error_message", message).drop("run_id", "started_at", "completed_at")


@_query("stream_customer_feed", f"SELECT {', '.join(_VERSIONS)} FROM dim_customer_2")
def stream_customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension after its feed has run once more on a trigger: nothing new, nothing changed."""
    tables = warehouse.built(spark, sf_dir)
    feeds.start(tables, ("customers",), availableNow=True).awaitTermination()
    return tables.dim_customer().select(*_VERSIONS)


@_query("stream_sales_feed", "SELECT * FROM fact_2")
def stream_sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after the sales feed has run once more on a trigger."""
    tables = warehouse.built(spark, sf_dir)
    feeds.start(tables, ("sales",), availableNow=True).awaitTermination()
    return _natural(tables.read("gold/fact_sales"), tables.dim_customer(), tables.read("gold/dim_product"), tables.read("gold/dim_store"))


@_query(
    "feed_on_a_trigger",
    f"""SELECT {', '.join(_VERSIONS)}, 'customer' AS member FROM dim_customer_1
        UNION ALL SELECT product_id, product_name, NULL, NULL, NULL, NULL, updated_at, NULL, is_active, is_inferred, {oracle.META}, 'product' FROM dim_product_1""",
)
def feed_on_a_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales, products and customers land together while the one feed runs on a trigger: customers and products come first, and
    nobody is inferred whose row has landed."""
    tables = warehouse.on_a_trigger(spark, sf_dir)
    customers = tables.dim_customer().select(*_VERSIONS, F.lit("customer").alias("member"))
    none, never = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    products = tables.read("gold/dim_product").select(
        "product_id", "product_name", none, none, none, none, "updated_at", never, "is_active", "is_inferred", *oracle.META.split(", "), F.lit("product"),
    )
    return customers.union(products)


@_query(
    "feed_batch_in_pieces",
    """SELECT 'silver' AS layer, sale_id AS business_key, quantity, cast(NULL AS varchar) AS reason, cast(NULL AS varchar) AS raw_record
         FROM sales_1
       UNION ALL SELECT 'fact', sale_id, quantity, NULL, NULL FROM fact_1
       UNION ALL SELECT 'rejects', business_key, NULL, rejection_reason, raw_record FROM rejects_1""",
)
def feed_batch_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of sales that landed over several triggers ends like one that landed at once."""
    state = warehouse.in_pieces(spark, sf_dir)
    none, rejects = F.lit(None).cast("string"), _rejects_out(state.read("silver/rejected_records"))

    def sold(layer: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(layer).alias("layer"), F.col("sale_id").alias("business_key"), "quantity", none.alias("reason"), none.alias("raw_record"))

    return sold("silver", state.read("silver/sales")).union(sold("fact", state.read("gold/fact_sales"))).union(
        rejects.select(F.lit("rejects"), "business_key", F.lit(None).cast("long"), "rejection_reason", "raw_record")
    )


@_query(
    "load_history",
    "SELECT _source_file, _batch_id, count(*) AS row_count, min(_loaded_at) AS first_load_time, "
    "max(_loaded_at) AS last_load_time FROM ("
    + " UNION ALL ".join(f"SELECT _source_file, _batch_id, _loaded_at FROM raw_{e}" for e in ENTITIES)
    + ") WHERE _loaded_at >= timestamp '2002-01-25 00:00:00' GROUP BY 1, 2",
)
def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = ("_source_file", "_batch_id", "_loaded_at")
    loads = checks.stack([df.select(*meta) for df in _raws(spark, sf_dir).values()])
    since = F.lit(datetime(2002, 1, 25)).cast("timestamp_ntz")
    return raw_layer.load_history(loads, since)


# --- CSV landing --------------------------------------------------------------------------------------------------


_CSV = {"header": "true", "nullValue": "NULL", "emptyValue": '""', "escape": '"', "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false"}


def _landing(spark: SparkSession, sf_dir: str, batch_id: str, compression: str) -> str:
    """All raw sales of a batch written as landing files."""
    path = scratch_dir(spark, "landing")
    texts = warehouse.landed(spark, sf_dir, "sales", batch_id).select(*schemas.BUSINESS_COLUMNS["sales"])
    texts.write.options(**_CSV, compression=compression).csv(path)
    return path


def _loaded_sales(spark: SparkSession, sf_dir: str, compression: str, pattern: str) -> DataFrame:
    """All raw sales through landing files and back, batch by batch. The rows are staged as they are loaded, and the landing files then go."""
    loaded = []
    for batch_id in retail.BATCHES:
        path = _landing(spark, sf_dir, batch_id, compression)
        loaded.append(landing.ingest_csv(spark, path, "sales", batch_id, _now(), pattern))
        remove(spark, path)
    return checks.stack(loaded)


@_query(
    "ingest_csv_raw",
    f"SELECT source, {oracle.columns('sales')} FROM raw_sales, (VALUES ('plain'), ('gzip')) t(source)",
)
def ingest_csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales through landing files and back, once plain and once compressed."""
    kinds = {"plain": ("none", "*.csv"), "gzip": ("gzip", "*.csv.gz")}
    loaded = [
        _loaded_sales(spark, sf_dir, compression, pattern).select(F.lit(kind).alias("source"), *schemas.BUSINESS_COLUMNS["sales"])
        for kind, (compression, pattern) in kinds.items()
    ]
    return loaded[0].unionByName(loaded[1])


@_query(
    "ingest_stream_sales",
    f"""SELECT {oracle.columns('sales')}, _batch_id, 'once' AS load FROM raw_sales
        UNION ALL SELECT {oracle.columns('sales')}, _batch_id, 'forced' FROM raw_sales WHERE _batch_id = 'BATCH_01'""",
)
def ingest_stream_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files of all batches, plain and compressed, through streams that load each file once. The landing is offered twice, which
    adds nothing; then one batch is loaded again by force, which adds a copy of it."""
    path, root = scratch_dir(spark, "landing"), scratch_dir(spark, "lake")
    for batch_id, compression in zip(retail.BATCHES, ("none", "gzip", "none")):
        texts = warehouse.landed(spark, sf_dir, "sales", batch_id).select(*schemas.BUSINESS_COLUMNS["sales"])
        texts.write.options(**_CSV, compression=compression).csv(f"{path}/{batch_id}")
    kinds = "*.csv{,.gz}"
    for _ in range(2):
        running = [
            landing.start_landing(spark, f"{path}/{b}", root, "sales", b, _now(), kinds, complete=False) for b in retail.BATCHES
        ]
        for query in running:
            query.awaitTermination()
    again = landing.ingest_csv(spark, f"{path}/BATCH_01", "sales", "BATCH_01", _now() + F.expr("INTERVAL 1 DAY"), kinds)
    raw_layer.append_raw(again, root, "sales", complete=False)
    loaded = raw_layer.read_raw(spark, root, "sales")
    return loaded.select(
        *schemas.BUSINESS_COLUMNS["sales"], "_batch_id", F.when(F.col("_loaded_at") == _now(), "once").otherwise("forced").alias("load")
    )


@_query(
    "csv_row_numbers",
    "SELECT count(*) AS row_count, count(*) AS distinct_positions, true AS dense FROM raw_sales",
)
def csv_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a file are numbered 1, 2, 3, ... without gaps."""
    rows = _loaded_sales(spark, sf_dir, "none", "*.csv")
    per_file = rows.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("_row_number").alias("positions"),
        F.min("_row_number").alias("lo"), F.max("_row_number").alias("hi"),
    )
    return per_file.agg(
        F.sum("n").alias("row_count"), F.sum("positions").alias("distinct_positions"),
        F.every((F.col("lo") == 1) & (F.col("hi") == F.col("n"))).alias("dense"),
    )


def _land_all(spark: SparkSession, sf_dir: str, *entities: str) -> str:
    """All raw rows of the entities as landing files, one folder per entity and batch."""
    path = scratch_dir(spark, "landing")
    for entity in entities:
        texts = _landed(spark, sf_dir, entity).select(*schemas.BUSINESS_COLUMNS[entity], "_batch_id")
        texts.write.options(**_CSV).partitionBy("_batch_id").csv(f"{path}/{entity}")
    return path


for _entity in ("customers", "products", "stores"):

    @_query(f"ingest_{_entity}", f"SELECT {oracle.columns(_entity)}, _batch_id, '{_entity}' AS folder FROM raw_{_entity}")
    def _ingest(spark: SparkSession, sf_dir: str, entity: str = _entity) -> DataFrame:
        """One entity through landing files and back, batch by batch, with the batch and the folder each row came from."""
        path = _land_all(spark, sf_dir, entity)
        present = _landed(spark, sf_dir, entity).select("_batch_id").distinct().collect()  # three at most
        loaded = [
            landing.ingest_csv(spark, f"{path}/{entity}/_batch_id={b}", entity, b, _now(), "*.csv", multiline=True)
            for b in sorted(r[0] for r in present)
        ]
        folder = F.regexp_extract("_source_file", "/([a-z]+)/_batch_id=[^/]+/[^/]+$", 1).alias("folder")
        return checks.stack(loaded).select(*schemas.BUSINESS_COLUMNS[entity], "_batch_id", folder)


@_query("landing_files", " UNION ".join(f"SELECT '{e}' AS entity, _batch_id AS batch_id FROM raw_{e}" for e in ENTITIES))
def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities and batches of which files lie in the landing."""
    files = landing.list_landing(spark, _land_all(spark, sf_dir, *ENTITIES), "*.csv")
    shape = "/([a-z]+)/_batch_id=([^/]+)/[^/]+$"
    return files.filter("length > 0").select(
        F.regexp_extract("path", shape, 1).alias("entity"), F.regexp_extract("path", shape, 2).alias("batch_id")
    ).distinct()


@_query(
    "feed_inserts_only",
    f"SELECT sale_id, quantity, unit_price, _batch_id FROM ({oracle.valid_latest('sales', 'BATCH_01', False)})",
)
def feed_inserts_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales through a change feed with an action column: only what was inserted reaches silver."""
    tables, sales = Tables(spark, scratch_dir(spark, "actions")), _landed(spark, sf_dir, "sales")
    action = F.when(F.col("_batch_id") == "BATCH_01", "INSERT").otherwise("DELETE")
    actions = sales.withColumn("_action", action).withColumn("_batch_id", F.lit("BATCH_01"))
    raw_layer.append_raw(actions, tables.root, "sales")
    feeds.run_available(tables, ("sales",), lambda: retail.LOADED_AT["BATCH_01"])
    return tables.read("silver/sales").select("sale_id", "quantity", "unit_price", "_batch_id")
