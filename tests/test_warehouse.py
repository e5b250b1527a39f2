import pytest
from pyspark.sql import functions as F

from ledgerline.session import exists, scratch_dir
from ledgerline.streaming.tables import LAYOUTS, Tables
from tests.conftest import rows_of
from workloads import warehouse


@pytest.fixture
def lake(spark, monkeypatch):
    """A lake whose loads write one customer, stated anew by each, and one sale each; what was loaded is noted."""
    steps, folder = [], scratch_dir(spark, "sources")

    def load(tables, batch_id):
        steps.append(batch_id)
        made = tables.begin("feed", batch_id)
        for table, values in (("silver/customers", {"customer_id": "C1", "segment": batch_id}), ("silver/sales", {"sale_id": batch_id})):
            fields = LAYOUTS[table].schema.fields
            made.write(table, spark.range(1).select(*(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields)))
        made.commit()
        return tables

    monkeypatch.setattr(warehouse, "load_initial", lambda s, _: load(Tables(s, scratch_dir(s, "lake"), 2), "INITIAL"))
    monkeypatch.setattr(warehouse, "load_batch", lambda tables, _, batch_id: load(tables, batch_id))
    monkeypatch.setattr(warehouse, "fail_batch", lambda tables, batch_id: steps.append(f"failed {batch_id}"))
    return folder, steps


def seen(state):
    return rows_of(state.read("silver/customers"), "customer_id", "segment"), rows_of(state.read("silver/sales"), "sale_id")


def test_a_state_loads_no_later_batch_and_stays_as_it_was(spark, lake):
    folder, steps = lake
    initial = warehouse.state(spark, folder, "INITIAL")
    customers = initial.read("silver/customers")
    assert steps == ["INITIAL"] and seen(initial) == ([("C1", "INITIAL")], [("INITIAL",)])
    second = warehouse.state(spark, folder, "BATCH_01")
    assert steps == ["INITIAL", "BATCH_01"]
    last = warehouse.state(spark, folder)
    assert steps == ["INITIAL", "BATCH_01", "BATCH_02", "failed BATCH_02"] and warehouse.built(spark, folder) is last
    assert seen(last) == ([("C1", "BATCH_02")], [("BATCH_01",), ("BATCH_02",), ("INITIAL",)])
    assert seen(second) == ([("C1", "BATCH_01")], [("BATCH_01",), ("INITIAL",)])
    assert seen(initial) == seen(warehouse.state(spark, folder, "INITIAL")) == ([("C1", "INITIAL")], [("INITIAL",)])
    assert rows_of(customers, "segment") == [("INITIAL",)]
    assert len(steps) == 4


def test_states_before_the_last_are_there_when_it_was_loaded_first(spark, lake):
    folder, steps = lake
    last = warehouse.built(spark, folder)
    states = [warehouse.state(spark, folder, b) for b in ("BATCH_01", "INITIAL")]
    assert [seen(s)[0] for s in states] == [[("C1", "BATCH_01")], [("C1", "INITIAL")]] and len(steps) == 4
    # Only what later loads overwrite is copied.
    assert exists(spark, f"{last.root}/as_of/INITIAL/silver/customers") and not exists(spark, f"{last.root}/as_of/INITIAL/silver/sales")


def test_a_load_that_breaks_off_is_begun_anew(spark, lake, monkeypatch):
    folder, steps = lake
    load = warehouse.load_batch

    def broken(*_):
        raise RuntimeError("broken")

    monkeypatch.setattr(warehouse, "load_batch", broken)
    with pytest.raises(RuntimeError, match="broken"):
        warehouse.built(spark, folder)
    monkeypatch.setattr(warehouse, "load_batch", load)
    assert seen(warehouse.built(spark, folder))[0] == [("C1", "BATCH_02")]
    assert steps == ["INITIAL", "INITIAL", "BATCH_01", "BATCH_02", "failed BATCH_02"]
