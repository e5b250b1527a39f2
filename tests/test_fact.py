import time
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import analytics, audit, checks, dimensions, fact, merge, silver
from tests.conftest import changes_of, rows_of, silver_of


def _stars(raw, stored):
    first = stored(dimensions.init_dim_customer(silver_of(raw("customers", {"region": "north"}), "customers")))
    changes = stored(changes_of(silver.customer_changes, raw("customers", {"region": "south", "updated_at": "2026-03-10 08:00:00"})))
    customers = dimensions.scd2_apply(first, changes, F.lit(datetime(2026, 4, 1)).cast("timestamp_ntz"))
    products = dimensions.init_dim_product(silver_of(raw("products", {}), "products"))
    stores = dimensions.init_dim_store(silver_of(raw("stores", {}), "stores"))
    return stored(customers), stored(products), stored(stores)


def test_fact(raw, stored):
    customers, products, stores = _stars(raw, stored)
    sales = stored(silver_of(
        raw(
            "sales",
            {"sale_id": "before", "sale_timestamp": "2026-03-10 07:59:59"},
            {"sale_id": "at", "sale_timestamp": "2026-03-10 08:00:00", "quantity": "3", "discount_amount": "0.50"},
            {"sale_id": "after", "sale_timestamp": "2026-03-11 00:00:00"},
            {"sale_id": "too early", "sale_timestamp": "2026-01-01 00:00:00"},
            {"sale_id": "no store", "store_id": "ST9"},
            {"sale_id": "no product", "product_id": "P9"},
            {"sale_id": "no customer", "customer_id": "C9"},
        ),
        "sales",
    ))
    built = stored(fact.build_fact(sales, customers, products, stores))
    regions = built.join(customers.select("customer_key", "region"), "customer_key")
    assert rows_of(regions, "sale_id", "region") == [("after", "SOUTH"), ("at", "SOUTH"), ("before", "NORTH")]
    row = built.filter("sale_id = 'at'").first()
    assert (row["date_key"], row["gross_amount"], row["discount"], row["net_amount"]) == (
        20260310, Decimal("30.00"), Decimal("0.50"), Decimal("29.50"),
    )
    assert built.schema["gross_amount"].dataType == schemas.FACT_SALES["gross_amount"].dataType
    assert fact.build_fact(sales, customers, products, stores, existing=built).count() == 0

    assert rows_of(fact.daily_sales_summary(built)) == [
        (date(2026, 3, 10), 2, 5, Decimal("50.00"), Decimal("1.50"), Decimal("48.50")),
        (date(2026, 3, 11), 1, 2, Decimal("20.00"), Decimal("1.00"), Decimal("19.00")),
    ]
    assert [tuple(r) for r in analytics.revenue_by_region(built, customers).collect()] == [
        ("SOUTH", Decimal("48.50")), ("NORTH", Decimal("19.00")),
    ]
    assert rows_of(analytics.revenue_by_category(built, products)) == [("HOME", Decimal("67.50"), 7)]
    assert rows_of(analytics.store_performance(built, stores)) == [("ST1", "Pune", Decimal("67.50"))]
    assert [r[1] for r in rows_of(checks.fact_orphans(built, customers, products, stores))] == [0, 0, 0]
    lost = checks.fact_orphans(built, customers.filter("is_current"), products, stores.limit(0), dimensions.build_dim_date(built.sparkSession))
    assert dict(rows_of(lost)) == {"customer_key": 1, "product_key": 0, "store_key": 3, "date_key": 0}


def test_new_valid_sales_looks_at_silver_and_fact(spark, raw, stored):
    valid = stored(changes_of(silver.valid_sales, raw("sales", {"sale_id": "a"}, {"sale_id": "b"}, {"sale_id": "c"})))
    in_silver, in_fact = valid.filter("sale_id = 'a'"), valid.filter("sale_id = 'b'").select("sale_id")
    assert rows_of(fact.new_valid_sales(valid, in_silver, in_fact), "sale_id") == [("c",)]


def test_a_customer_with_very_many_versions(spark, stored):
    """10,000 versions and 100,000 sales of one customer: each sale is looked up among few versions, and meets the right one."""
    moment = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    dim = stored(spark.range(10_000).select(
        F.lit("C1").alias("customer_id"), moment(F.col("id") * 100).alias("effective_start_date"),
        moment(F.col("id") * 100 + F.when(F.col("id") % 7 == 0, 60).otherwise(100)).alias("effective_end_date"), F.col("id").alias("customer_key"),
    ))
    sales = stored(spark.range(0, 100_000, 1, 4).select(
        F.col("id").alias("sale_id"), F.lit("C1").alias("customer_id"), moment(F.col("id") * 10 + 3 - 50).alias("sale_timestamp")))
    began = time.monotonic()
    found = fact.point_in_time_join(sales, dim, "customer_key").select("sale_id", "customer_key").collect()
    assert time.monotonic() - began < 60
    expected = {i: (i * 10 - 47) // 100 for i in range(5, 100_000)}
    expected = {i: k for i, k in expected.items() if k < 10_000 and (k % 7 or (i * 10 - 47) % 100 < 60)}
    assert {r["sale_id"]: r["customer_key"] for r in found} == expected and len(found) == len(expected)


def test_versions_that_overlap_or_are_empty(spark, stored):
    """A stale change closes a version before its start; whatever the history looks like, a sale meets one version at most."""
    at = lambda day: datetime(2026, 1, day)
    spans = [(5, 2), (2, 20), (3, 9), (8, 12), (15, 16)] + [(20 + i // 40, 21 + i // 40) for i in range(200)]
    dim = stored(spark.createDataFrame(
        [("C1", at(a), at(b), i) for i, (a, b) in enumerate(spans)],
        "customer_id string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, customer_key int"))
    sales = spark.createDataFrame([(d, "C1", at(d)) for d in range(1, 28)], "sale_id int, customer_id string, sale_timestamp timestamp_ntz")
    starts = {r["sale_id"]: r["effective_start_date"] for r in
              fact.point_in_time_join(sales, dim, "effective_start_date").collect()}
    valid = {d: [a for a, b in spans if a <= d < b] for d in range(1, 28)}
    assert starts == {d: at(max(some)) for d, some in valid.items() if some}


def test_orphans_are_counted_in_one_scan(spark, stored):
    fact_ = stored(spark.range(100).select(*(F.col("id").alias(k) for k in ("customer_key", "product_key", "store_key")), F.col("id").cast("int").alias("date_key")))
    dims = [stored(spark.range(n).select(F.col("id").alias(k))) for k, n in (("customer_key", 90), ("product_key", 100), ("store_key", 0))]
    found = checks.fact_orphans(fact_, *dims, spark.range(50).select(F.col("id").cast("int").alias("date_key")))
    assert dict(rows_of(found)) == {"customer_key": 10, "product_key": 0, "store_key": 100, "date_key": 50}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Relation") == 4  # the fact and three dimensions read from files


def test_reports_come_in_order(spark):
    fact_ = spark.createDataFrame([(1, 5), (2, 9), (3, 7)], "customer_key long, net_amount int")
    dim = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "customer_key long, region string")
    assert [r["region"] for r in analytics.revenue_by_region(fact_, dim).collect()] == ["B", "C", "A"]
    days = spark.createDataFrame([(date(2026, 1, d), d) for d in (3, 1, 2)], "sale_date date, net_sales int")
    assert [r["net_sales"] for r in analytics.daily_revenue(days).collect()] == [1, 2, 3]
    rejects = spark.createDataFrame([("B", "x"), ("A", "y"), ("A", "x")], "entity_name string, rejection_reason string")
    assert [tuple(r)[:2] for r in checks.rejects_by_reason(rejects).collect()] == [("A", "x"), ("A", "y"), ("B", "x")]
    runs = spark.createDataFrame([(datetime(2026, 1, d),) for d in (1, 3, 2)], "started_at timestamp")
    assert [r["started_at"].day for r in audit.latest_runs(runs).collect()] == [3, 2, 1]


def test_merges(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert rows_of(merge.upsert(target, source, ["k"])) == [("a", 1), ("b", 20), ("c", 30)]
    assert rows_of(merge.insert_missing(target, source, "k")) == [("a", 1), ("b", 2), ("c", 30)]
    assert rows_of(merge.insert_missing(target, source, "k", F.col("v") < 2)) == [("a", 1), ("b", 2), ("b", 20), ("c", 30)]
    updated = merge.update_from(target, source, "k", F.col("t.v") < F.col("s.v"), {"v": F.col("s.v")})
    assert rows_of(updated) == [("a", 1), ("b", 20)]


def test_checks(spark):
    dim = spark.createDataFrame([("C1", True), ("C1", True), ("C2", True), ("C2", False)], "customer_id string, is_current boolean")
    assert rows_of(checks.multiple_current_versions(dim)) == [("C1", 2)]
    keys = spark.createDataFrame([("S1",), ("S1",), (None,)], "sale_id string")
    assert rows_of(checks.duplicate_keys(keys, "sale_id")) == [("S1", 2)]
    assert rows_of(checks.duplicate_rows({"sales": keys})) == [("SALES", 2)]


def test_hot_customer_is_split_over_tasks(spark, stored):
    """A customer with a third of all sales: the join splits that customer's partition and loses nothing."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("C0")).otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string")))
    sales = stored(
        spark.range(0, 90_000, 1, 8).select(
            F.concat(F.lit("S"), F.col("id").cast("string")).alias("sale_id"), hot.alias("customer_id"),
            F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("sale_timestamp"),
            F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        )
    )
    dim = stored(
        spark.range(997).select(
            F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"),
            F.lit(datetime(1900, 1, 1)).cast("timestamp_ntz").alias("effective_start_date"),
            F.lit(datetime(9999, 1, 1)).cast("timestamp_ntz").alias("effective_end_date"), F.col("id").alias("customer_key"),
        )
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = fact.point_in_time_join(sales, dim, "customer_key")
        assert len(joined.collect()) == 90_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
