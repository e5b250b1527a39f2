"""What a load no longer writes, shuffles or tries."""

from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerline.plans import incremental
from ledgerline.session import scratch_dir
from ledgerline.sources.raw import append_raw, raw_path
from ledgerline.streaming import tables as tables_module
from ledgerline.streaming.tables import LAYOUTS, Load, Tables
from tests.conftest import rows_of
from workloads import retail, warehouse

NOW = datetime(2026, 9, 5)


def test_valid_sales_are_not_staged_before_the_guard(spark, raw, tmp_path, monkeypatch):
    """Rows gathered by their id go straight through the guard; superseded, invalid and known sales stay out."""
    staged, real = [], Load.stage
    monkeypatch.setattr(Load, "stage", lambda load, name, *rest: staged.append(name) or real(load, name, *rest))
    lake = Tables(spark, str(tmp_path / "lake"), 2)
    first = raw("sales", {}, {"sale_id": "S2", "quantity": "1"}, {"sale_id": "S2", "quantity": "4"}, {"sale_id": "S3"}, {"sale_id": "S3", "quantity": "x"})
    incremental.process_sales(lake, first, "feed", "1", lambda: NOW)
    second = raw("sales", {"quantity": "9"}, {"sale_id": "S3"}, {"sale_id": ""}, {"sale_id": None}, batch="BATCH_01")
    incremental.process_sales(lake, second, "feed", "2", lambda: NOW)
    only_known = raw("sales", {"quantity": "9"}, {"sale_id": "S4", "quantity": "x"}, batch="BATCH_02")
    incremental.process_sales(lake, only_known, "feed", "3", lambda: NOW)
    assert "assessed_sales" in staged and "valid_sales" not in staged
    assert rows_of(lake.read("silver/sales"), "sale_id", "quantity") == [("S1", 2), ("S2", 4), ("S3", 2)]
    reasons = lake.read("silver/rejected_records").groupBy("batch_id", "rejection_reason").count()
    assert rows_of(reasons) == [
        ("BATCH_01", "MISSING_SALE_ID", 2), ("BATCH_02", "INVALID_QUANTITY", 1), ("INITIAL", "DUPLICATE_SALE_IN_BATCH", 2), ("INITIAL", "INVALID_QUANTITY", 1),
    ]


def customers(spark, segment):
    values = {"customer_id": F.concat(F.lit("C"), F.col("id").cast("string")), "segment": F.lit(segment)}
    fields = LAYOUTS["silver/customers"].schema.fields
    return spark.range(40).select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def test_a_state_is_copied_as_it_lies(spark, monkeypatch):
    """Merged tables are in buckets already: their copy is shuffled by nothing, and what is loaded later does not reach it."""
    lake = Tables(spark, scratch_dir(spark, "lake"), 3)
    for batch in retail.BATCHES[:2]:
        if batch != retail.BATCHES[0]:
            plans, real = [], tables_module.write
            with monkeypatch.context() as during:
                during.setattr(tables_module, "write", lambda df, *rest: plans.append(df._jdf.queryExecution().toString()) or real(df, *rest))
                warehouse.keep_state(lake)
            assert plans and not any("Exchange" in plan or "RebalancePartitions" in plan for plan in plans)
        load = lake.begin("feed", batch)
        load.write("silver/customers", customers(spark, batch))
        load.commit(NOW)
    (state,) = warehouse._states(lake).values()
    assert rows_of(state.read("silver/customers"), "segment") == [("INITIAL",)] * 40
    assert rows_of(lake.read("silver/customers"), "segment") == [("BATCH_01",)] * 40
    was, now = (t.stored("silver/customers").select("customer_id", "bucket") for t in (state, lake))
    assert rows_of(was) == rows_of(now) and was.select("bucket").distinct().count() == 3


def with_dictionary(folder):
    """Columns that have a dictionary in some file below ``folder``."""
    groups = [m.row_group(g) for f in Path(folder).rglob("*.parquet") for m in [pq.ParquetFile(f).metadata] for g in range(m.num_row_groups)]
    assert groups
    return {c.path_in_schema for g in groups for c in map(g.column, range(g.num_columns)) if c.has_dictionary_page}


def test_columns_of_many_values_have_no_dictionary(spark, raw, tmp_path):
    root, rows = str(tmp_path / "lake"), raw("sales", *({"sale_id": f"S{i}"} for i in range(200))).coalesce(1)
    append_raw(rows, root, "sales")
    landed = with_dictionary(raw_path(root, "sales"))
    assert "payment_method" in landed and not landed & {"sale_id", "customer_id", "product_id", "unit_price", "_row_number"}
    lake = Tables(spark, root, 2)
    incremental.process_sales(lake, rows, "feed", "1", lambda: NOW)
    published = with_dictionary(lake.path("silver/sales"))
    assert "payment_method" in published and not published & {"sale_id", "customer_id", "product_id", "unit_price"}
