from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import calendar, masking, parse

MATRIX = [
    # parser, text, expected
    ("text", "  a b ", "a b"),
    ("text", "   ", None),
    ("text", "\t", "\t"),
    ("timestamp", " 2026-09-05 09:00:00 ", datetime(2026, 9, 5, 9)),
    ("timestamp", "2026-09-05T09:00", datetime(2026, 9, 5, 9)),
    ("timestamp", "2026-09-05", datetime(2026, 9, 5)),
    ("timestamp", "2026-09-05\n", None),
    ("timestamp", "2026-09-31 10:00:00", None),
    ("timestamp", "2026-13-45 08:00:00", None),
    ("timestamp", "09/12/2026 25:00", None),
    ("timestamp", "not-a-timestamp", None),
    ("timestamp", "2026", None),
    ("timestamp", "1767225600", None),
    ("date", "2020-02-29", date(2020, 2, 29)),
    ("date", "2021-02-29", None),
    ("date", "2026", None),
    ("integer", " 5 ", 5),
    ("integer", "2.5", 3),
    ("integer", "1e2", 100),
    ("integer", "1,000", None),
    ("integer", "two", None),
    ("integer", "99999999999999999999", None),
    ("money", "12.345", Decimal("12.35")),
    ("money", "1e2", Decimal("100.00")),
    ("money", "-499.00", Decimal("-499.00")),
    ("money", "12345678901.00", None),
    ("money", "Rs. 499", None),
    ("money", "ABC", None),
    ("boolean", "TRUE", True),
    ("boolean", " on ", True),
    ("boolean", "y", True),
    ("boolean", "1", True),
    ("boolean", "Off", False),
    ("boolean", "no", False),
    ("boolean", "0", False),
    ("boolean", "2", None),
    ("boolean", "MAYBE", None),
    ("is_email", "a@b.co", True),
    ("is_email", "rohit@@example.com", False),
    ("is_email", "deepak_at_example.com", False),
    ("is_email", "a b@example.com", False),
    ("is_email", "x a@b.co", False),
]


def test_parsers(spark):
    frame = spark.createDataFrame([(text,) for _, text, _ in MATRIX], "value string").coalesce(1)
    parsers = ("text", "timestamp", "date", "integer", "money", "boolean", "is_email")
    parsed = {r["value"]: r for r in frame.select("value", *(getattr(parse, p)(F.col("value")).alias(p) for p in parsers)).collect()}
    for parser, text, expected in MATRIX:
        assert parsed[text][parser] == expected, (parser, text)


def test_null_stays_null(spark):
    row = spark.createDataFrame([(None,)], "v string").select(
        *(getattr(parse, p)(F.col("v")).alias(p) for p in ("text", "timestamp", "date", "integer", "money", "boolean"))
    ).first()
    assert all(v is None for v in row)


def test_calendar_parts(spark):
    row = spark.sql("SELECT date'2025-12-28' AS d").select(
        calendar.date_key(F.col("d")).alias("k"), calendar.iso_weekday(F.col("d")).alias("w")
    ).first()
    assert tuple(row) == (20251228, 7)


@pytest.mark.parametrize("role,expected", [("DATA_ENGINEER", "a@b.co"), ("ACCOUNTADMIN", "a@b.co"), ("DATA_VIEWER", "***MASKED***")])
def test_masking(spark, role, expected):
    view = masking.masked_view(spark.createDataFrame([("C1", "a@b.co")], "customer_id string, email string"), role)
    assert view.first()["email"] == expected
