import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from ledgerline.operators import cleanse, quarantine, silver

NOW = lambda: F.lit("2026-09-02 00:00:00").cast("timestamp_ntz")

# overrides of a valid row -> expected code on the initial path and on the batch path
CASES = {
    "customers": [
        ({}, None, None),
        ({"customer_id": " "}, "MISSING_CUSTOMER_ID", "MISSING_CUSTOMER_ID"),
        ({"customer_id": None, "email": None}, "MISSING_CUSTOMER_ID", "MISSING_CUSTOMER_ID"),
        ({"customer_name": ""}, "MISSING_CUSTOMER_NAME", "MISSING_CUSTOMER_NAME"),
        ({"email": ""}, "MISSING_EMAIL", "INVALID_EMAIL"),
        ({"email": "a@@b.co"}, "INVALID_EMAIL", "INVALID_EMAIL"),
        ({"created_at": "2026-09-31 10:00:00"}, "INVALID_CREATED_AT", "INVALID_TIMESTAMP"),
        ({"updated_at": "x"}, "INVALID_UPDATED_AT", "INVALID_TIMESTAMP"),
        ({"phone": None, "region": "", "segment": None}, None, None),
    ],
    "products": [
        ({}, None, None),
        ({"product_id": ""}, "MISSING_PRODUCT_ID", "MISSING_PRODUCT_ID"),
        ({"product_name": None}, "MISSING_PRODUCT_NAME", "MISSING_PRODUCT_NAME"),
        ({"unit_price": "ABC"}, "INVALID_UNIT_PRICE", "INVALID_UNIT_PRICE"),
        ({"unit_price": "0"}, "INVALID_UNIT_PRICE", "INVALID_UNIT_PRICE"),
        ({"created_at": None}, "INVALID_CREATED_AT", "INVALID_CREATED_AT"),
        ({"updated_at": "2026-13-05 10:00:00"}, "INVALID_UPDATED_AT", "INVALID_UPDATED_AT"),
        ({"is_active": "MAYBE"}, "INVALID_IS_ACTIVE", "INVALID_IS_ACTIVE"),
    ],
    "stores": [
        ({}, None, None),
        ({"store_id": None}, "MISSING_STORE_ID", "MISSING_STORE_ID"),
        ({"store_name": "  "}, "MISSING_STORE_NAME", "MISSING_STORE_NAME"),
        ({"opened_date": "2020-02-30"}, "INVALID_OPENED_DATE", "INVALID_OPENED_DATE"),
    ],
    "sales": [
        ({}, None, None),
        ({"sale_id": ""}, "MISSING_SALE_ID", "MISSING_SALE_ID"),
        ({"sale_timestamp": "2026-02-30 00:00:00"}, "INVALID_SALE_TIMESTAMP", "INVALID_TIMESTAMP"),
        ({"customer_id": None}, "MISSING_CUSTOMER_ID", "MISSING_CUSTOMER_ID"),
        ({"product_id": " "}, "MISSING_PRODUCT_ID", "MISSING_PRODUCT_ID"),
        ({"store_id": ""}, "MISSING_STORE_ID", "MISSING_STORE_ID"),
        ({"quantity": "two"}, "INVALID_QUANTITY", "INVALID_QUANTITY"),
        ({"quantity": "0"}, "INVALID_QUANTITY", "INVALID_QUANTITY"),
        ({"unit_price": None}, "INVALID_UNIT_PRICE", "INVALID_UNIT_PRICE"),
        ({"unit_price": "-1"}, "INVALID_UNIT_PRICE", "INVALID_UNIT_PRICE"),
        ({"unit_price": "12345678901.00"}, "INVALID_UNIT_PRICE", "INVALID_UNIT_PRICE"),
        ({"discount_amount": "n/a"}, "INVALID_DISCOUNT", "INVALID_DISCOUNT"),
        ({"discount_amount": "-0.01"}, "INVALID_DISCOUNT", "INVALID_DISCOUNT"),
        ({"discount_amount": "20.01"}, "DISCOUNT_EXCEEDS_GROSS_AMOUNT", "INVALID_DISCOUNT"),
        ({"discount_amount": "20.00"}, None, None),
        ({"payment_method": "BARTER"}, "INVALID_PAYMENT_METHOD", "INVALID_PAYMENT_METHOD"),
        ({"payment_method": None}, "INVALID_PAYMENT_METHOD", "INVALID_PAYMENT_METHOD"),
        ({"payment_method": " wallet "}, None, None),
    ],
}


@pytest.mark.parametrize("entity", CASES)
def test_codes(raw, entity):
    frame = raw(entity, *(overrides for overrides, _, _ in CASES[entity])).coalesce(1)
    for path, position in (("initial", 1), ("batch", 2)):
        found = {r["_row_number"]: r["_reason"] for r in silver.assessed(frame, entity, path).collect()}
        assert [found[i + 1] for i in range(len(found))] == [case[position] for case in CASES[entity]]


def test_payload_keeps_the_original_text(raw):
    frame = raw("sales", {"unit_price": "ABC", "sale_id": " S9 ", "payment_method": None})
    record = quarantine.rejected(silver.assessed(frame, "sales", "batch"), "sales", NOW())
    row = record.select("business_key", "rejection_reason", F.to_json("raw_record").alias("payload")).first()
    assert (row["business_key"], row["rejection_reason"]) == ("S9", "INVALID_UNIT_PRICE")
    payload = json.loads(row["payload"])
    assert payload["unit_price"] == "ABC" and payload["sale_id"] == " S9 " and payload["payment_method"] is None


def test_guard_drops_only_what_is_known(raw):
    first = quarantine.rejected(silver.assessed(raw("sales", {"sale_id": ""}, {"sale_id": None}, {"quantity": "x"}), "sales"), "sales", NOW())
    # Two rows without an id arrive together: both are kept.
    assert quarantine.unseen(first, first.limit(0)).count() == 3
    assert quarantine.unseen(first, first).count() == 0
    # The same sale rejected for another reason is a new reject.
    other = quarantine.rejected(silver.assessed(raw("sales", {"unit_price": "x"}), "sales"), "sales", NOW())
    assert quarantine.unseen(other, first).count() == 1


def test_first_rejects_of_a_batch_are_not_shuffled(raw):
    first = quarantine.rejected(silver.assessed(raw("sales", {"sale_id": ""}, {"sale_id": ""}, {"unit_price": "x\n\"y"}), "sales"), "sales", NOW())
    new, twice = quarantine.unseen(first, first.limit(0)), quarantine.unseen(first.union(first), first)
    assert "Exchange" not in new._jdf.queryExecution().executedPlan().toString()
    text = [*(c for c in first.columns if c != "raw_record"), F.to_json("raw_record").alias("raw_record")]
    assert rows_of(new, *text) == rows_of(first, *text) == rows_of(twice, *text)


def test_cleaning_normalises_case_and_space(raw):
    row = cleanse.clean_customers(raw("customers", {"customer_id": " C7 ", "email": " Ann@Example.COM ", "region": "north "})).first()
    assert (row["customer_id"], row["email"], row["region"], row["segment"]) == ("C7", "ann@example.com", "NORTH", "VIP")
    store = cleanse.clean_stores(raw("stores", {"city": " Pune "})).first()
    assert (store["city"], store["state"]) == ("Pune", "MH")
    assert cleanse.clean_products(raw("products", {})).first()["category"] == "HOME"
    assert rows_of(cleanse.clean_sales(raw("sales", {"quantity": "2.5"})), "quantity") == [(3,)]
