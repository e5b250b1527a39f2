"""The driver's tables as retail source files.

Each text below derives one raw entity from whole tables: typed columns become text, batches follow from dates and
market segments, and dirt sits where prices and balances fall into given ranges. The texts are portable SQL, run by
Spark here and by the SQL check on the other side, so that both start from the same raw rows. Some sales are loaded twice, as by a
forced reload a day later, and some texts end in a line break.

Batches: ``INITIAL``, ``BATCH_01``, ``BATCH_02``. Customers of the FURNITURE segment and parts of type PROMO arrive with
BATCH_02 only, after sales that refer to them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
BATCHES = ("INITIAL", "BATCH_01", "BATCH_02")
LOADED_AT = {
    "INITIAL": datetime(2002, 1, 1), "BATCH_01": datetime(2002, 2, 1), "BATCH_02": datetime(2002, 3, 1),
}

_LOADED = """CASE _batch_id WHEN 'INITIAL' THEN timestamp '2002-01-01 00:00:00'
       WHEN 'BATCH_01' THEN timestamp '2002-02-01 00:00:00' ELSE timestamp '2002-03-01 00:00:00' END"""

_CUSTOMER_PEOPLE = """
SELECT c_custkey, c_name, c_acctbal, c_nationkey, c_mktsegment, lower(r_name) AS region,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE '+' || cast(c_nationkey + 10 AS string) || '-' || cast(c_custkey AS string) END AS phone,
       cast(date '1994-01-01' + c_nationkey AS string) || ' 08:00:00' AS created_at
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

CUSTOMERS = """
WITH people AS (""" + _CUSTOMER_PEOPLE + """),
master AS (
  SELECT CASE WHEN c_acctbal < -950 THEN ' ' WHEN c_acctbal > 9000 THEN '  C' || cast(c_custkey AS string) || ' '
              ELSE 'C' || cast(c_custkey AS string) END AS customer_id,
         CASE WHEN c_acctbal >= -950 AND c_acctbal < -900 THEN '' ELSE c_name END AS customer_name,
         CASE WHEN c_acctbal >= -900 AND c_acctbal < -850 THEN NULL
              WHEN c_acctbal >= -850 AND c_acctbal < -800 THEN 'customer' || cast(c_custkey AS string) || '_at_example.com'
              ELSE ' Customer' || cast(c_custkey AS string) || '@Example.COM' END AS email,
         phone, region, lower(c_mktsegment) AS segment,
         CASE WHEN c_acctbal >= -800 AND c_acctbal < -750 THEN '1994-09-31 10:00:00' ELSE created_at END AS created_at,
         CASE WHEN c_acctbal >= -750 AND c_acctbal < -700 THEN 'not-a-timestamp' ELSE created_at END AS updated_at,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'BATCH_02' ELSE 'INITIAL' END AS _batch_id,
         'master' AS origin, c_custkey + 1 AS _row_number
  FROM people
),
profile AS (
  SELECT CASE WHEN o_totalprice < 5000 THEN NULL ELSE 'C' || cast(c_custkey AS string) END AS customer_id,
         CASE WHEN o_totalprice >= 5000 AND o_totalprice < 10000 THEN '   ' ELSE c_name END AS customer_name,
         CASE WHEN o_totalprice >= 10000 AND o_totalprice < 15000 THEN 'customer@@example.com'
              WHEN o_totalprice >= 15000 AND o_totalprice < 20000 THEN ''
              WHEN o_totalprice >= 30000 AND o_totalprice < 35000 THEN 'customer@example.com' || chr(10)
              WHEN o_orderpriority = '1-URGENT' THEN 'customer' || cast(c_custkey AS string) || '@priority.example.com'
              ELSE 'customer' || cast(c_custkey AS string) || '@example.com' END AS email,
         coalesce(phone, '') AS phone, region,
         CASE o_orderstatus WHEN 'F' THEN c_mktsegment WHEN 'O' THEN 'premium' ELSE 'vip' END AS segment,
         CASE WHEN o_totalprice >= 20000 AND o_totalprice < 25000 THEN '1994-13-01 00:00:00' ELSE created_at END AS created_at,
         CASE WHEN o_totalprice >= 25000 AND o_totalprice < 30000 THEN '2026'
              WHEN o_totalprice >= 35000 AND o_totalprice < 40000 THEN cast(o_orderdate AS string) || chr(10)
              ELSE cast(o_orderdate AS string) END AS updated_at,
         CASE WHEN c_mktsegment = 'FURNITURE' OR o_orderdate >= timestamp '1999-07-01 00:00:00' THEN 'BATCH_02'
              ELSE 'BATCH_01' END AS _batch_id,
         'profile' AS origin, o_orderkey + 1 AS _row_number
  FROM {orders} JOIN people ON o_custkey = c_custkey
),
rows_all AS (SELECT * FROM master UNION ALL SELECT * FROM profile)
SELECT customer_id, customer_name, email, phone, region, segment, created_at, updated_at,
       'customers_' || origin || '_' || lower(_batch_id) || '.csv' AS _source_file,
       """ + _LOADED + """ AS _loaded_at, _batch_id, _row_number
FROM rows_all
"""

PRODUCTS = """
WITH master AS (
  SELECT CASE WHEN p_size = 45 THEN '' ELSE 'P' || cast(p_partkey AS string) END AS product_id,
         CASE WHEN p_size = 47 THEN ' ' ELSE p_name END AS product_name,
         lower(p_type) AS category, ' ' || p_brand AS brand,
         CASE WHEN p_size = 48 THEN '-999.00' WHEN p_size = 49 THEN 'Rs. 499'
              ELSE cast(cast(p_retailprice AS decimal(12,2)) AS string) END AS unit_price,
         CASE WHEN p_size = 46 THEN '1994-02-30 00:00:00' ELSE '1994-01-01 00:00:00' END AS created_at,
         CASE WHEN p_size = 44 THEN 'n/a' ELSE '1994-01-01 00:00:00' END AS updated_at,
         CASE WHEN p_size <= 5 THEN 'no' WHEN p_size <= 10 THEN 'off' WHEN p_size <= 15 THEN '0'
              WHEN p_size <= 20 THEN 'Y' WHEN p_size = 50 THEN 'MAYBE' ELSE 'TRUE' END AS is_active,
         CASE WHEN p_type = 'PROMO' THEN 'BATCH_02' ELSE 'INITIAL' END AS _batch_id,
         'master' AS origin, p_partkey + 1 AS _row_number
  FROM {part}
),
prices AS (
  SELECT 'P' || cast(p_partkey AS string) AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CASE WHEN l_quantity = 50 THEN 'ABC' ELSE cast(cast(l_extendedprice AS decimal(12,2)) AS string) END AS unit_price,
         '1994-01-01 00:00:00' AS created_at, cast(l_shipdate AS string) AS updated_at,
         CASE WHEN l_quantity = 49 THEN 'MAYBE' WHEN l_returnflag = 'R' THEN 'off' ELSE 'on' END AS is_active,
         CASE WHEN p_type = 'PROMO' OR l_shipdate >= timestamp '2000-01-01 00:00:00' THEN 'BATCH_02'
              ELSE 'BATCH_01' END AS _batch_id,
         'price' AS origin, l_orderkey * 10 + l_linenumber AS _row_number
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
),
rows_all AS (SELECT * FROM master UNION ALL SELECT * FROM prices)
SELECT product_id, product_name, category, brand, unit_price, created_at, updated_at, is_active,
       'products_' || origin || '_' || lower(_batch_id) || '.csv' AS _source_file,
       """ + _LOADED + """ AS _loaded_at, _batch_id, _row_number
FROM rows_all
"""

STORES = """
SELECT CASE WHEN s_acctbal < -500 THEN '' ELSE 'ST' || cast(s_suppkey AS string) END AS store_id,
       CASE WHEN s_acctbal >= -500 AND s_acctbal < 0 THEN '  ' ELSE s_name END AS store_name,
       'City ' || cast(s_nationkey AS string) AS city, lower(n_name) AS state, lower(r_name) AS region,
       CASE WHEN s_acctbal < 3000 THEN 'mall' WHEN s_acctbal < 6000 THEN 'high_street' ELSE 'hypermarket' END AS store_type,
       CASE WHEN s_acctbal >= 0 AND s_acctbal < 500 THEN '1990-02-30'
            ELSE cast(date '1990-01-01' + s_nationkey AS string) END AS opened_date,
       'stores_initial.csv' AS _source_file, timestamp '2002-01-01 00:00:00' AS _loaded_at, 'INITIAL' AS _batch_id,
       s_suppkey + 1 AS _row_number
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

SALES = """
WITH rows_all AS (
  SELECT CASE WHEN l_extendedprice < 950 THEN ' ' ELSE 'S' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) END AS sale_id,
         CASE WHEN l_extendedprice >= 950 AND l_extendedprice < 1000 THEN '1999-13-45 08:00:00'
              ELSE cast(l_shipdate AS string) END AS sale_timestamp,
         CASE WHEN l_extendedprice >= 1000 AND l_extendedprice < 1100 THEN '  ' ELSE 'C' || cast(o_custkey AS string) END AS customer_id,
         CASE WHEN l_extendedprice >= 1100 AND l_extendedprice < 1200 THEN NULL ELSE ' P' || cast(l_partkey AS string) END AS product_id,
         CASE WHEN l_extendedprice >= 1200 AND l_extendedprice < 1300 THEN '' ELSE 'ST' || cast(l_suppkey AS string) END AS store_id,
         CASE WHEN l_extendedprice >= 1300 AND l_extendedprice < 1500 THEN 'two'
              WHEN l_extendedprice >= 1500 AND l_extendedprice < 1700 THEN '-1'
              ELSE cast(cast(l_quantity AS int) AS string) END AS quantity,
         CASE WHEN l_extendedprice >= 1700 AND l_extendedprice < 1900 THEN 'ABC'
              WHEN l_extendedprice >= 1900 AND l_extendedprice < 2100 THEN '0.00'
              ELSE cast(cast(l_extendedprice AS decimal(12,2)) AS string) END AS unit_price,
         CASE WHEN l_extendedprice >= 2100 AND l_extendedprice < 2300 THEN 'n/a'
              WHEN l_extendedprice >= 2300 AND l_extendedprice < 2500 THEN '-5.00'
              WHEN l_extendedprice >= 2500 AND l_extendedprice < 2700 THEN '99999999.99'
              ELSE cast(cast(l_discount * 100 AS decimal(12,2)) AS string) END AS discount_amount,
         CASE WHEN l_extendedprice >= 2700 AND l_extendedprice < 2900 THEN 'BARTER'
              WHEN l_extendedprice >= 2900 AND l_extendedprice < 3100 THEN NULL
              WHEN l_returnflag = 'A' THEN 'cash' WHEN l_returnflag = 'N' THEN 'Card'
              WHEN l_linestatus = 'F' THEN 'UPI' ELSE ' wallet ' END AS payment_method,
         CASE WHEN l_shipdate < timestamp '1998-01-01 00:00:00' THEN 'INITIAL'
              WHEN l_shipdate < timestamp '2000-01-01 00:00:00' THEN 'BATCH_01' ELSE 'BATCH_02' END AS _batch_id,
         l_partkey + 1 AS _row_number, l_quantity
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
),
reloaded AS (SELECT * FROM rows_all JOIN (VALUES (false), (true)) twice(again) ON NOT again OR l_quantity = 3)
SELECT sale_id, sale_timestamp, customer_id, product_id, store_id, quantity, unit_price, discount_amount, payment_method,
       'sales_' || lower(_batch_id) || '.csv' AS _source_file,
       CASE WHEN again THEN """ + _LOADED + """ + INTERVAL '1' DAY ELSE """ + _LOADED + """ END AS _loaded_at, _batch_id, _row_number
FROM reloaded
"""

RAW_SQL = {"customers": CUSTOMERS, "products": PRODUCTS, "stores": STORES, "sales": SALES}


def tables_of(entity: str) -> list[str]:
    """The tables that the rows of ``entity`` are derived from."""
    return [t for t in TABLES if "{" + t + "}" in RAW_SQL[entity]]


def raw(spark: SparkSession, sf_dir: str, entity: str, batch_id: str | None = None) -> DataFrame:
    """All raw rows of ``entity``, or one of its batches, whose name is then a constant: a write partitioned by it sorts no rows."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(entity)}
    rows = spark.sql(RAW_SQL[entity], **used).withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz"))
    return rows if batch_id is None else rows.filter(rows["_batch_id"] == batch_id).withColumn("_batch_id", F.lit(batch_id))
