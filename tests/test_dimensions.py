from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import checks, dimensions, silver
from tests.conftest import changes_of, rows_of, silver_of

NOW = datetime(2026, 10, 1)
START, END = datetime(2026, 1, 5, 10), datetime(9999, 12, 31, 23, 59, 59)


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def dim(raw, stored):
    """C1, C2 and C3 current (C3 without a phone), C9 inferred."""
    members = raw("customers", {}, {"customer_id": "C2"}, {"customer_id": "C3", "phone": ""})
    first = stored(dimensions.init_dim_customer(silver_of(members, "customers")))
    sales = changes_of(silver.valid_sales, raw("sales", {"customer_id": "C9"}, {"sale_id": "S2"}, batch="BATCH_01"))
    return stored(first.unionByName(dimensions.infer_customers(sales, first)))


def _changes(raw, *rows):
    return changes_of(silver.customer_changes, raw("customers", *rows, batch="BATCH_02", file="b.csv"))


COLUMNS = ("customer_id", "segment", "effective_start_date", "effective_end_date", "is_current", "is_inferred")


def test_initial_members(dim):
    assert rows_of(dim, "customer_id", "effective_start_date", "is_inferred") == [
        ("C1", START, False), ("C2", START, False), ("C3", START, False), ("C9", datetime(1900, 1, 1), True),
    ]
    assert sorted(r[0] for r in dim.select("customer_key").collect()) == [1, 2, 3, 4]


def test_initial_load_skips_current_customers(raw, dim):
    again = silver_of(raw("customers", {"segment": "other"}, {"customer_id": "C4"}), "customers")
    added = dimensions.init_dim_customer(again, dim, dim)
    assert rows_of(added, "customer_key", "customer_id") == [(5, "C4")]


def test_missing_creation_time_starts_at_the_default(spark, raw):
    row = silver_of(raw("customers", {}), "customers").withColumn("created_at", F.lit(None).cast("timestamp_ntz"))
    assert dimensions.init_dim_customer(row).first()["effective_start_date"] == datetime(2026, 1, 1)


def test_scd2_branches(raw, dim, stored):
    rows = (
        {"segment": "gold", "updated_at": "2026-09-05 09:00:00"},  # changed
        {"customer_id": "C2", "updated_at": "2026-09-06 00:00:00"},  # same attributes
        {"customer_id": "C3", "phone": None, "updated_at": "2026-09-06 00:00:00"},  # NULL against empty
        {"customer_id": "C9", "segment": "real", "updated_at": "2026-09-07 00:00:00"},  # was inferred
        {"customer_id": "C5", "updated_at": "2026-09-08 00:00:00"},  # unknown
    )
    changes = stored(_changes(raw, *rows))
    after = stored(dimensions.scd2_apply(dim, changes, _now()))
    changed_at = datetime(2026, 9, 5, 9)
    assert rows_of(after, *COLUMNS) == rows_of(
        after.sparkSession.createDataFrame(
            [
                ("C1", "VIP", START, changed_at, False, False),
                ("C1", "GOLD", changed_at, END, True, False),
                ("C2", "VIP", START, END, True, False),
                ("C3", "VIP", START, END, True, False),
                ("C5", "VIP", datetime(2026, 9, 8), END, True, False),
                ("C9", "REAL", datetime(1900, 1, 1), END, True, False),
            ],
            after.select(*COLUMNS).schema,
        )
    )
    keys = {(r["customer_id"], r["is_current"]): r["customer_key"] for r in after.collect()}
    before = {r["customer_id"]: r["customer_key"] for r in dim.collect()}
    assert keys["C1", False] == before["C1"] and keys["C9", True] == before["C9"]
    assert sorted((keys["C1", True], keys["C5", True])) == [5, 6]
    closed = after.filter("NOT is_current").first()
    assert closed["_loaded_at"] == NOW and closed["_batch_id"] == "INITIAL"
    assert checks.multiple_current_versions(after).count() == 0
    # The same batch again changes nothing.
    assert dimensions.scd2_apply(after, changes, _now()).exceptAll(after).count() == 0


def test_stale_changes(raw, dim, stored):
    stale = stored(_changes(raw, {"segment": "gold", "updated_at": "2025-01-01 00:00:00"}))
    assert dimensions.scd2_apply(dim, stale, _now()).filter("customer_id = 'C1'").count() == 2
    assert dimensions.scd2_apply(dim, stale, _now(), ignore_stale=True).filter("customer_id = 'C1'").count() == 1


def test_scd1(raw, stored):
    products = stored(
        dimensions.init_dim_product(silver_of(raw("products", {}, {"product_id": "P2"}), "products"))
    )
    sales = changes_of(silver.valid_sales, raw("sales", {"product_id": "P9"}, {"sale_id": "S2"}, batch="BATCH_01"))
    products = stored(products.unionByName(dimensions.infer_products(sales, products)))
    keys = {r["product_id"]: r["product_key"] for r in products.collect()}
    changes = stored(changes_of(silver.product_changes, 
        raw(
            "products",
            {"unit_price": "12.00", "updated_at": "2026-05-01 00:00:00"},
            {"unit_price": "11.00", "updated_at": "2026-04-01 00:00:00"},
            {"product_id": "P9", "unit_price": "9.00"},
            {"product_id": "P3", "unit_price": "3.00"},
            {"product_id": "P2", "unit_price": "ABC"},
        )
    ))
    after = dimensions.scd1_upsert(products, changes)
    assert rows_of(after, "product_id", "unit_price", "is_inferred") == [
        (p, pytest.approx(v) if v else v, False) for p, v in (("P1", 12), ("P2", 10), ("P3", 3), ("P9", 9))
    ]
    found = {r["product_id"]: r["product_key"] for r in after.collect()}
    assert {p: found[p] for p in keys} == keys and found["P3"] == max(keys.values()) + 1


def test_inferred_members_are_single(raw, dim, stored):
    """One unknown customer in two files is one member, with the smallest metadata."""
    two_files = raw("sales", {"customer_id": "C7"}, batch="BATCH_02", file="z.csv").unionByName(
        raw("sales", {"sale_id": "S2", "customer_id": "C7", "product_id": "P7"}, batch="BATCH_01", file="y.csv")
    )
    sales = stored(changes_of(silver.valid_sales, two_files))
    found = dimensions.infer_customers(sales, dim)
    assert rows_of(found, "customer_id", "customer_name", "email", "region", "_source_file", "_batch_id") == [
        ("C7", "UNKNOWN", None, "UNKNOWN", "y.csv", "BATCH_01")
    ]


def test_calendar(spark):
    days = dimensions.build_dim_date(spark).cache()
    assert days.count() == 1095
    assert tuple(days.agg(F.min("full_date"), F.max("full_date")).first()) == (date(2025, 1, 1), date(2027, 12, 31))
    row = days.filter("date_key = 20251228").first()
    assert (row["month_name"], row["day_name"], row["day_of_week"], row["is_weekend"], row["week"]) == ("Dec", "Sun", 7, True, 52)
    assert dimensions.build_dim_date(spark, existing=days.filter("year > 2025")).count() == 365
