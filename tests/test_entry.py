"""The driver's contract, and a few registered queries against DuckDB on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from workloads import retail

SF = "/root/testdata/sf0.001"
QUICK = ("daily_sales_summary", "silver_customers", "rejects_sales", "sales_batch_duplicates", "parse_matrix")


def test_every_statement_belongs_to_a_query():
    queries, statements = contract.queries(), contract.oracle_sql()
    assert set(statements) <= set(queries)
    own = {name for name in queries if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(statements)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", QUICK)
def test_query_matches_its_statement(spark, name):
    found = contract.queries()[name](spark, SF)
    names = sorted(found.columns)
    with duckdb.connect() as db:
        for table in retail.TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        columns = ", ".join(f'"{n}"' for n in names)
        expected = db.execute(f"SELECT {columns} FROM ({contract.oracle_sql()[name]})").fetchall()
    rows = [tuple(r) for r in found.select(*names).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, expected)) and rows
