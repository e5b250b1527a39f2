"""Steps that the loads of large tables share."""

import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import fact
from ledgerline.session import scratch_dir
from ledgerline.sources.raw import append_raw
from ledgerline.streaming.tables import Tables
from tests.conftest import rows_of
from tests.test_disk import shuffle_files
from workloads import retail, warehouse

DAY = datetime(2026, 1, 1)


def test_few_versions_and_many_are_looked_up_alike(spark):
    """Customers of one to three times FEW versions, one with gaps, overlaps and an empty version, one without any, against a plain join."""
    spans = [(f"C{n}", i, 10 * i, 10 * (i + 1)) for n in (1, fact.FEW, fact.FEW + 1, 3 * fact.FEW) for i in range(n)]
    spans += [("odd", 0, 0, 10), ("odd", 1, 5, 30), ("odd", 2, 20, 20), ("odd", 3, 40, 50)]
    dim = spark.createDataFrame(
        [(c, k, DAY + timedelta(a), DAY + timedelta(b)) for c, k, a, b in spans],
        "customer_id string, customer_key long, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz",
    )
    times = [None, *(DAY + timedelta(d) for d in (-1, 0, 4, 5, 9, 10, 20, 29, 35, 39, 40, 49, 50, 119, 120))]
    ids = [*sorted({s[0] for s in spans}), "unknown", None]
    sales = spark.createDataFrame([(c, t) for c in ids for t in times], "customer_id string, sale_timestamp timestamp_ntz")
    at = F.col("sale_timestamp")
    plain = sales.join(dim, "customer_id").filter((F.col("effective_start_date") <= at) & (at < F.col("effective_end_date")))
    expected = plain.groupBy("customer_id", "sale_timestamp").agg(F.max_by("customer_key", "effective_start_date").alias("customer_key"))
    assert expected.count() > 30
    assert rows_of(fact.point_in_time_join(sales, dim, "customer_key")) == rows_of(expected)


def test_a_load_leaves_no_shuffle_files(spark, raw, tmp_path):
    tables, before = Tables(spark, str(tmp_path / "lake"), 2), shuffle_files(spark)
    load = tables.begin("feed", "1")
    values = {"sale_id": F.concat(F.lit("S"), F.col("id").cast("string"))}
    fields = schemas.SILVER["sales"].fields
    sales = spark.range(200).select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))
    load.write("silver/sales", load.stage("rows", sales.repartition(3)))
    load.commit()
    append_raw(raw("sales", {}, {"sale_id": "S2"}).repartition(2), tables.root, "sales")
    assert not shuffle_files(spark) - before
    assert tables.read("silver/sales").count() == 200


@pytest.fixture
def lake(spark, monkeypatch):
    """Tables whose batches arrive as a note only."""
    made, came = Tables(spark, scratch_dir(spark, "lake"), 2), []
    monkeypatch.setattr(warehouse, "_arrive", lambda tables, folder, batch_id, *entities: came.append((batch_id, entities)))
    return made, came


def test_the_next_batch_arrives_beside_a_load_that_goes_on_to_it(spark, lake, monkeypatch):
    tables, came = lake
    both, wanted = threading.Barrier(2, timeout=30), (spark.sparkContext.applicationId, "tables")
    note = warehouse._arrive
    monkeypatch.setattr(warehouse, "_arrive", lambda *given: (both.wait(), note(*given)))
    monkeypatch.setitem(warehouse._wanted, wanted, retail.BATCHES[:2])
    warehouse._process(tables, "tables", "INITIAL", both.wait)  # each waits until the other has begun
    assert came == [("BATCH_01", ("customers", "products", "sales"))] and warehouse._arrived(tables) == {"BATCH_01"}


def test_a_batch_arrives_once_and_none_that_nobody_waits_for(spark, lake, monkeypatch):
    tables, came = lake
    done = []
    monkeypatch.setattr(warehouse, "run_available", lambda *_, **__: done.append("feeds"))
    monkeypatch.setattr(warehouse, "refresh_daily_summary", lambda *_: done.append("summary"))
    monkeypatch.setattr(warehouse, "complete_batch", lambda s, root, batch_id, *entities: done.append(batch_id))
    warehouse._arrived(tables).add("BATCH_01")
    monkeypatch.setitem(warehouse._wanted, (spark.sparkContext.applicationId, "tables"), retail.BATCHES[:2])
    warehouse.load_batch(tables, "tables", "BATCH_01")
    assert came == [] and done == ["BATCH_01", "feeds", "summary"]
    warehouse.load_batch(tables, "other tables", "BATCH_02")
    assert [batch_id for batch_id, _ in came] == ["BATCH_02"] and done[3:] == ["BATCH_02", "feeds", "summary"]


def test_nothing_is_wanted_after_a_load(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_load_up_to", lambda s, folder, wanted: (wanted, dict(warehouse._wanted)))
    wanted, during = warehouse.load_up_to(spark, "tables", "BATCH_01")
    assert wanted == ("INITIAL", "BATCH_01") and list(during.values()) == [wanted] and not warehouse._wanted
