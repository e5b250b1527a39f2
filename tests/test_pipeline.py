"""Initial load and two batches through the feeds, with failures and replays on the way."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import audit, checks, silver
from ledgerline.operators.fact import daily_sales_summary
from ledgerline.plans import incremental
from ledgerline.plans.initial_load import run_initial_load
from ledgerline.sources import raw as raw_layer
from ledgerline.streaming import feeds, refresh
from ledgerline.streaming import tables as tables_module
from ledgerline.streaming.tables import LAYOUTS, ConflictingLoad, Load, Tables
from tests.conftest import rows_of

NOW = datetime(2026, 10, 1)


def clock():
    return NOW


def _sizes(tables):
    return {name: tables.read(name).count() for name in LAYOUTS if not name.startswith("control/")}


def _land(tables, raw, entity, *rows, batch, file=None):
    raw_layer.append_raw(raw(entity, *rows, batch=batch, file=file or f"{entity}_{batch}.csv"), tables.root, entity)


def _assert_invariants(tables):
    state = tables
    assert checks.multiple_current_versions(state.dim_customer()).count() == 0
    for table, key in (("silver/customers", "customer_id"), ("silver/products", "product_id"), ("silver/sales", "sale_id"),
                       ("gold/fact_sales", "sale_id"), ("gold/fact_sales", "sale_key"), ("gold/dim_product", "product_key")):
        assert checks.duplicate_keys(state.read(table), key).count() == 0, table
    assert checks.duplicate_keys(state.dim_customer(), "customer_key").count() == 0
    orphans = checks.fact_orphans(
        state.read("gold/fact_sales"), state.dim_customer(), state.read("gold/dim_product"),
        state.read("gold/dim_store"), state.read("gold/dim_date"),
    )
    assert all(r["orphans"] == 0 for r in orphans.collect())


@pytest.fixture(scope="module")
def tables(spark, raw, tmp_path_factory):
    made = Tables(spark, str(tmp_path_factory.mktemp("lake")))
    _land(made, raw, "customers", {}, {"customer_id": "C2"}, {"customer_id": "C3", "email": "x"}, batch="INITIAL")
    _land(made, raw, "products", {}, {"product_id": "P2", "unit_price": "0"}, batch="INITIAL")
    _land(made, raw, "stores", {}, batch="INITIAL")
    _land(made, raw, "sales", {}, {"sale_id": "S2", "customer_id": "C9"}, {"sale_id": "S3", "quantity": "x"}, batch="INITIAL")
    run_initial_load(made, NOW)
    return made


def test_1_initial_load(tables):
    sizes = _sizes(tables)
    assert (sizes["silver/customers"], sizes["silver/sales"], sizes["gold/fact_sales"], sizes["silver/rejected_records"]) == (2, 2, 1, 3)
    assert run_initial_load(tables, NOW) is None  # already committed
    run_initial_load(tables, NOW, rerun="again")
    assert _sizes(tables) == sizes
    checkpoint = tables.read("control/pipeline_monitoring")
    assert rows_of(checkpoint, "batch_id", "records_processed", "status") == [("INITIAL", 1, "SUCCESS")]
    _assert_invariants(tables)


def test_2_feeds_have_nothing_to_do_without_new_files(tables):
    loads = tables.last().load
    feeds.run_available(tables, clock=clock)
    assert tables.last().load == loads


def test_3_failure_between_writes_changes_nothing(tables, raw, monkeypatch):
    _land(tables, raw, "customers",
          {"segment": "gold", "updated_at": "2026-09-05 09:00:00"}, {"customer_id": "C4", "customer_name": ""},
          {"customer_id": "C5", "updated_at": "2026-09-05 09:00:00"}, batch="BATCH_01")
    before = _sizes(tables)
    real = Load.write

    def fail_late(self, table, df):
        if table == "gold/dim_customer_closed":
            raise RuntimeError("executor gone")
        real(self, table, df)

    monkeypatch.setattr(Load, "write", fail_late)
    with pytest.raises(Exception, match="executor gone"):
        feeds.run_available(tables, ("customers",), clock)
    monkeypatch.undo()
    assert _sizes(tables) == before
    failures = tables.spark.read.parquet(incremental.failures_path(tables))
    assert rows_of(failures, "entity", "status", "records_read", "records_written") == [("CUSTOMER", "FAILED", 3, 0)]
    assert "executor gone" in failures.first()["error_message"]


def test_4_retry_and_first_batch(tables, raw):
    _land(tables, raw, "sales",
          {"sale_id": "S10", "customer_id": "C99", "sale_timestamp": "2026-09-06 00:00:00"},
          {"sale_id": "S11", "product_id": "P99", "sale_timestamp": "2026-09-06 00:00:00"},
          {"sale_id": "S12", "store_id": "ST9", "sale_timestamp": "2026-09-06 00:00:00"},
          {"sale_id": "S13", "sale_timestamp": "2026-09-01 00:00:00"},
          {"sale_id": "S13", "sale_timestamp": "2026-09-07 00:00:00"},
          {"sale_id": "S1"}, {"sale_id": "", "quantity": "1"}, batch="BATCH_01")
    feeds.run_available(tables, clock=clock)
    state = tables
    dim = state.dim_customer()
    assert rows_of(dim.filter("customer_id = 'C1'"), "segment", "is_current") == [("GOLD", True), ("VIP", False)]
    assert rows_of(dim.filter("is_inferred"), "customer_id", "customer_name") == [("C99", "UNKNOWN")]
    assert rows_of(state.read("gold/dim_product").filter("is_inferred"), "product_id") == [("P99",)]
    fact = state.read("gold/fact_sales")
    assert rows_of(fact, "sale_id") == [("S1",), ("S10",), ("S11",), ("S13",)]
    assert fact.filter("sale_id = 'S13'").first()["sale_timestamp"] == datetime(2026, 9, 7)
    assert state.read("silver/sales").filter("sale_id = 'S12'").count() == 1  # kept, though no store matches
    rejects = state.read("silver/rejected_records").filter("batch_id = 'BATCH_01'")
    assert rows_of(rejects, "entity_name", "rejection_reason") == [
        ("CUSTOMER", "MISSING_CUSTOMER_NAME"), ("SALE", "DUPLICATE_SALE_IN_BATCH"), ("SALE", "MISSING_SALE_ID"),
    ]
    assert audit.run_log(incremental.run_events(tables)).filter("status = 'FAILED'").count() == 1
    runs = audit.latest_runs(audit.run_log(state.read("control/run_events")))
    assert rows_of(runs, "entity", "batch_id", "status", "records_read", "records_rejected", "records_written") == [
        ("CUSTOMER", "BATCH_01", "SUCCESS", 3, 1, 2), ("SALES", "BATCH_01", "SUCCESS", 7, 2, 4),
    ]
    _assert_invariants(tables)


def test_5_second_batch_resolves_in_place(tables, raw):
    before = tables.dim_customer().filter("customer_id = 'C99'").first()
    _land(tables, raw, "customers", {"customer_id": "C99", "updated_at": "2026-09-20 00:00:00"}, batch="BATCH_02")
    _land(tables, raw, "products", {"product_id": "P99", "unit_price": "7.00"}, {"unit_price": "11.00"}, batch="BATCH_02")
    feeds.run_available(tables, clock=clock)
    state = tables
    after = state.dim_customer().filter("customer_id = 'C99'").collect()
    assert len(after) == 1 and after[0]["customer_key"] == before["customer_key"]
    assert (after[0]["is_inferred"], after[0]["customer_name"], after[0]["effective_start_date"]) == (False, "Ann", datetime(1900, 1, 1))
    prices = checks.product_prices(state.read("gold/dim_product"))
    assert [(r["product_id"], float(r["unit_price"])) for r in prices.collect()] == [("P1", 11.0), ("P99", 7.0)]
    assert state.read("gold/dim_product").filter("is_inferred").count() == 0
    _assert_invariants(tables)


def test_6_replays_add_nothing(tables):
    sizes = _sizes(tables)
    for label in ("once more", "and again"):
        for entity, process in feeds.PROCESSES.items():
            for batch_id in ("BATCH_02",) if entity != "sales" else ("BATCH_01",):
                process(tables, raw_layer.read_raw(tables.spark, tables.root, entity, batch_id), label, entity, clock)
    assert _sizes(tables) == sizes
    # The very same batch of a feed is not even looked at.
    loads = tables.last().load
    batch = raw_layer.read_raw(tables.spark, tables.root, "sales", "BATCH_01")
    assert incremental.process_sales(tables, batch, "and again", "sales", clock) is None
    assert tables.last().load == loads
    _assert_invariants(tables)


def test_7_summary_follows_the_fact(tables, raw):
    def expected():
        return rows_of(daily_sales_summary(tables.read("gold/fact_sales")))

    def stored():
        return rows_of(tables.read("gold/daily_sales_summary"))

    assert refresh.refresh_daily_summary(tables, NOW) is not None
    assert stored() == expected()
    assert refresh.refresh_daily_summary(tables, NOW) is None
    _land(tables, raw, "sales", {"sale_id": "S20", "sale_timestamp": "2026-09-07 10:00:00"},
          {"sale_id": "S21", "sale_timestamp": "2026-11-01 00:00:00"}, batch="BATCH_03")
    feeds.run_available(tables, clock=clock)
    query = refresh.start_summary(tables, availableNow=True)
    query.awaitTermination()
    assert stored() == expected() and len(stored()) == 4


def _files(tables, table):
    """Files of a table with their time of change."""
    return {p: p.stat().st_mtime_ns for p in Path(tables.path(table)).rglob("*.parquet")}


def _bucket_of(spark, tables, table, *keys):
    column = {"gold/dim_product": "product_id", "silver/sales": "sale_id"}.get(table, "customer_id")
    return tables.touched(table, spark.createDataFrame([(k,) for k in keys], f"{column} string"))


def test_8_only_touched_buckets_change(tables, raw, spark):
    """Files of buckets without a changed key keep their name and time; nothing is left in staging."""
    watched = ("silver/customers", "gold/dim_customer_current", "silver/products", "gold/dim_product")
    _land(tables, raw, "customers", *({"customer_id": f"M{i}"} for i in range(60)), batch="BATCH_04")
    _land(tables, raw, "products", *({"product_id": f"M{i}"} for i in range(60)), batch="BATCH_04")
    feeds.run_available(tables, clock=clock)
    before = {t: _files(tables, t) for t in watched}
    _land(tables, raw, "customers", {"customer_id": "M7", "segment": "new", "updated_at": "2026-12-01 00:00:00"}, batch="BATCH_05")
    _land(tables, raw, "products", {"product_id": "M9", "unit_price": "3.00"}, batch="BATCH_05")
    feeds.run_available(tables, clock=clock)
    for table in watched:
        (bucket,) = _bucket_of(spark, tables, table, "M7") if "customer" in table else _bucket_of(spark, tables, "gold/dim_product", "M9")
        after = _files(tables, table)
        changed = {p.parent.name for p in set(before[table].items()) ^ set(after.items()) for p in [p[0]]}
        assert changed == {f"bucket={bucket}"} and len({p.parent for p in after}) == tables.buckets, table
    assert rows_of(tables.dim_customer().filter("customer_id = 'M7'"), "segment", "is_current") == [("NEW", True), ("VIP", False)]
    assert not (Path(tables.root) / "staging").exists() or not any((Path(tables.root) / "staging").rglob("*.parquet"))
    _assert_invariants(tables)


def test_9_the_guard_opens_the_buckets_of_the_batch_only(tables, raw, spark):
    """Looking for a batch's ids in silver and the fact reads the files of their buckets and no others."""
    _land(tables, raw, "sales", *({"sale_id": f"B{i}"} for i in range(80)), batch="BATCH_06")
    feeds.run_available(tables, clock=clock)
    for table in ("silver/sales", "gold/fact_sales"):
        every, own = tables.stored(table), tables.stored(table, _bucket_of(spark, tables, "silver/sales", "B3", "S1"))
        opened = {r[0] for r in own.select("_metadata.file_path").distinct().collect()}
        assert {r[0] for r in own.select("bucket").distinct().collect()} == set(_bucket_of(spark, tables, "silver/sales", "B3", "S1"))
        metric = own._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in metric or "PartitionFilters: [bucket" in metric
        assert 0 < len(opened) < every.select("_metadata.file_path").distinct().count()
    before = _sizes(tables)
    _land(tables, raw, "sales", {"sale_id": "B3"}, {"sale_id": "B81"}, batch="BATCH_07")
    feeds.run_available(tables, clock=clock)
    assert _sizes(tables)["gold/fact_sales"] == before["gold/fact_sales"] + 1


def test_a_publication_that_broke_off_is_finished(spark, raw, tmp_path, monkeypatch):
    """The log row decides: what was staged reaches the tables with the next load at the latest, once."""
    made = Tables(spark, str(tmp_path / "lake"))
    for entity in ("customers", "products", "stores", "sales"):
        _land(made, raw, entity, {}, batch="INITIAL")
    run_initial_load(made, NOW)
    real = tables_module.write

    def break_off(df, table, path):
        if table == "gold/dim_customer_current" and "staging" not in path:
            raise RuntimeError("executor gone")
        real(df, table, path)

    monkeypatch.setattr(tables_module, "write", break_off)
    _land(made, raw, "customers", {"segment": "gold", "updated_at": "2026-09-05 09:00:00"}, {"customer_id": "C5"}, batch="BATCH_01")
    with pytest.raises(Exception, match="executor gone"):
        feeds.run_available(made, ("customers",), clock)
    monkeypatch.undo()
    feeds.run_available(made, ("customers",), clock)  # the batch is in the log
    assert rows_of(made.dim_customer(), "customer_id", "segment", "is_current") == [("C1", "GOLD", True), ("C1", "VIP", False), ("C5", "VIP", True)]
    _land(made, raw, "customers", {"customer_id": "C6"}, batch="BATCH_02")
    feeds.run_available(made, ("customers",), clock)
    assert made.dim_customer().count() == 4 and made.read("silver/customers").count() == 3
    _assert_invariants(made)


def test_feeds_run_where_only_some_entities_have_landed(spark, raw, tmp_path):
    made = Tables(spark, str(tmp_path / "lake"))
    feeds.run_available(made, clock=clock)
    _land(made, raw, "sales", {}, batch="BATCH_01")
    feeds.run_available(made, clock=clock)
    assert made.read("silver/sales").count() == 1 and made.dim_customer().filter("is_inferred").count() == 1


def test_what_lands_together_is_taken_in_order(spark, raw, tmp_path):
    """A feed that runs on a trigger while a batch lands, sales first: nobody is inferred whose row has landed."""
    made = Tables(spark, str(tmp_path / "lake"))
    for entity in ("customers", "products", "stores"):
        _land(made, raw, entity, {}, batch="INITIAL")
    run_initial_load(made, NOW)
    query = feeds.start(made, clock=clock, processingTime="1 second")
    try:
        raw_layer.append_raw(raw("sales", {"customer_id": "C2", "product_id": "P2"}, batch="BATCH_01"), made.root, "sales", complete=False)
        raw_layer.append_raw(raw("products", {"product_id": "P2"}, batch="BATCH_01"), made.root, "products", complete=False)
        raw_layer.append_raw(raw("customers", {"customer_id": "C2", "updated_at": "2026-02-28 00:00:00"}, batch="BATCH_01"), made.root, "customers", complete=False)
        raw_layer.complete_batch(spark, made.root, "BATCH_01", "sales", "products", "customers")
        query.processAllAvailable()
    finally:
        query.stop()
    assert made.dim_customer().filter("is_inferred").count() == made.read("gold/dim_product").filter("is_inferred").count() == 0
    assert made.read("gold/fact_sales").count() == 1
    order = made.log().filter("feed <> 'initial_load'").orderBy("load").collect()
    assert [r["feed"] for r in order] == ["customers_feed", "products_feed", "sales_feed"]


def test_only_inserted_rows_of_a_feed_are_processed(spark, raw, tmp_path):
    made = Tables(spark, str(tmp_path / "lake"))
    rows = raw("sales", {}, {"sale_id": "S2"}, {"sale_id": "S3"}, batch="BATCH_01")
    action = F.when(F.col("sale_id") == "S1", "INSERT").when(F.col("sale_id") == "S2", "DELETE")
    raw_layer.append_raw(rows.withColumn("_action", action), made.root, "sales")
    feeds.run_available(made, ("sales",), clock)
    assert rows_of(made.read("silver/sales"), "sale_id") == [("S1",), ("S3",)]  # a row without an action was inserted


def test_a_batch_in_pieces_is_one_batch(spark, raw, tmp_path):
    """One sale in two files, rejects without an id in one file: whatever the triggers in between, the batch decides."""
    made = Tables(spark, str(tmp_path / "lake"))
    for entity in ("customers", "products", "stores", "sales"):
        _land(made, raw, entity, {}, batch="INITIAL")
    run_initial_load(made, NOW)
    pieces = [
        ("a.csv", [{"sale_id": "S5", "quantity": "5"}, {"sale_id": ""}, {"sale_id": "", "quantity": "3"}]),
        ("b.csv", [{"sale_id": "S6"}, {"sale_id": "S5", "quantity": "7"}, {"sale_id": ""}, {"sale_id": "", "quantity": "3"}]),
    ]
    for file, rows in pieces:
        raw_layer.append_raw(raw("sales", *rows, batch="BATCH_01", file=file), made.root, "sales", complete=False)
        feeds.run_available(made, ("sales",), clock)
        assert made.read("silver/sales").filter("sale_id = 'S5'").count() == 0
    raw_layer.complete_batch(spark, made.root, "BATCH_01", "sales")
    feeds.run_available(made, ("sales",), clock)
    state = made
    assert rows_of(state.read("silver/sales").filter("sale_id <> 'S1'"), "sale_id", "quantity") == [("S5", 7), ("S6", 2)]
    rejects = state.read("silver/rejected_records").groupBy("source_file", "rejection_reason").count()
    assert rows_of(rejects) == [("a.csv", "DUPLICATE_SALE_IN_BATCH", 1), ("a.csv", "MISSING_SALE_ID", 2), ("b.csv", "MISSING_SALE_ID", 2)]
    sizes = _sizes(made)
    # A late file of the same batch: what it adds is added, what was decided before stays.
    raw_layer.append_raw(raw("sales", {"sale_id": ""}, {"sale_id": "S7"}, batch="BATCH_01", file="c.csv"), made.root, "sales")
    feeds.run_available(made, ("sales",), clock)
    after = _sizes(made)
    assert (after["silver/sales"], after["silver/rejected_records"]) == (sizes["silver/sales"] + 1, sizes["silver/rejected_records"] + 1)


def test_the_second_of_two_writers_fails_and_nothing_is_lost(spark, raw, tmp_path):
    made = Tables(spark, str(tmp_path / "lake"))
    stores = silver.load_silver(silver.assessed(raw("stores", {}, {"store_id": "ST2"}), "stores"), "stores")
    first, second = made.begin("one", "1"), made.begin("two", "1", in_place=True)
    first.write("silver/stores", stores)
    first.commit(NOW)
    with pytest.raises(ConflictingLoad):
        second.commit(NOW)
    assert made.read("silver/stores").count() == 2
    again = made.begin("two", "1")
    again.write("silver/stores", stores.limit(1))
    again.commit(NOW)
    assert made.read("silver/stores").count() == 3
    assert [r["load"] for r in made.log().orderBy("load").collect()] == [1, 2]
