"""One batch of customer, product or sales changes: read, quarantine, merge, commit, leave an audit trail.

Working sets that several steps need are staged as tables, and counted as they are written. Of the lake's tables a batch reads and
writes the buckets that its keys fall into. How tables are joined is Spark's choice, from their sizes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import audit, cleanse, dimensions, fact, quarantine, rules, silver
from ledgerline.operators.keys import as_read
from ledgerline.session import together
from ledgerline.sources.raw import read_or_empty
from ledgerline.streaming.tables import Load, Tables

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _moment(at: datetime) -> Column:
    return F.lit(at).cast("timestamp_ntz")


def _assess(load: Load, batch: DataFrame, entity: str, run: audit.Run, keep_all_originals: bool = False) -> DataFrame:
    """Typed rows with their reason, parsed once for all the steps that need them.

    The original text is kept where it may reach the quarantine.
    """
    assessed = silver.assessed(batch, entity, "batch")
    if not keep_all_originals:
        original = F.when(F.col(rules.REASON).isNotNull(), F.col(cleanse.ORIGINAL))
        assessed = assessed.withColumn(cleanse.ORIGINAL, original)
    name = f"assessed_{entity}"
    assessed = load.stage(name, assessed, F.max("_batch_id").alias("batch_id"))
    run.read, run.batch_id = load.rows[name], load.measured[name].get("batch_id")
    return assessed


def _quarantine(load: Load, rejects: DataFrame, entity: str, run: audit.Run) -> None:
    """New rejects of one entity. Of the quarantine only what the batch's own partition holds of it is read."""
    known = load.tables.read("silver/rejected_records").filter(
        F.col("batch_id").eqNullSafe(F.lit(run.batch_id)) & (F.col("entity_name") == rules.ENTITY_TAGS[entity])
    )
    load.write("silver/rejected_records", quarantine.unseen(rejects, known))
    run.rejected = load.rows["silver/rejected_records"]


def _customers(load: Load, batch: DataFrame, run: audit.Run, now: Column, ignore_stale: bool) -> None:
    assessed = _assess(load, batch, "customers", run)
    _, changes = together(
        lambda: _quarantine(load, quarantine.rejected(assessed, "customers", now), "customers", run),
        lambda: load.stage("customer_changes", silver.customer_changes(assessed)),
    )
    run.written = load.rows["customer_changes"]
    if not run.written:
        return
    tables, touched = load.tables, load.tables.touched("silver/customers", changes)
    before, current = tables.read("silver/customers", touched), tables.read("gold/dim_customer_current", touched)
    _, versions = together(
        lambda: load.write("silver/customers", silver.upsert_silver(before, changes, "customers")),
        lambda: load.stage("versions", dimensions.scd2_versions(current, changes, now, ignore_stale)),
    )
    keyed = dimensions.scd2_keyed(versions, load.last_key("customer_key"), load.stage)
    together(
        lambda: load.write("gold/dim_customer_closed", keyed.filter("NOT is_current")),
        lambda: load.write("gold/dim_customer_current", keyed.filter("is_current")),
    )
    load.advance_key("customer_key", load.rows["rows_for_customer_key"])


def _products(load: Load, batch: DataFrame, run: audit.Run, now: Column) -> None:
    assessed = _assess(load, batch, "products", run)
    _, changes = together(
        lambda: _quarantine(load, quarantine.rejected(assessed, "products", now), "products", run),
        lambda: load.stage("product_changes", silver.product_changes(assessed)),
    )
    run.written = load.rows["product_changes"]
    if not run.written:
        return
    tables, touched = load.tables, load.tables.touched("silver/products", changes)
    before, dim = tables.read("silver/products", touched), tables.read("gold/dim_product", touched)
    together(
        lambda: load.write("silver/products", silver.upsert_silver(before, changes, "products")),
        lambda: load.write("gold/dim_product", dimensions.scd1_upsert(dim, changes, load.last_key("product_key"), load.stage)),
    )
    load.advance_key("product_key", load.rows["rows_for_product_key"])


def _sales(load: Load, batch: DataFrame, run: audit.Run, now: Column) -> None:
    tables, assessed = load.tables, _assess(load, batch, "sales", run, keep_all_originals=True)

    def set_aside() -> None:
        duplicates = quarantine.duplicate_sales(assessed, now, as_read, load.stage)
        _quarantine(load, duplicates.unionByName(quarantine.rejected(assessed, "sales", now)), "sales", run)

    def add_new() -> None:
        # The buckets of all rows that may turn out valid. The valid ones themselves are read once and already gathered by their id.
        touched = tables.touched("silver/sales", rules.valid(assessed))
        known = tables.read("silver/sales", touched), tables.read("gold/fact_sales", touched)
        load.write("silver/sales", fact.new_valid_sales(silver.valid_sales(assessed), *known))

    together(set_aside, add_new)
    new = load.written("silver/sales")
    run.written = load.rows["silver/sales"]
    if not run.written:
        return
    of_customers = tables.touched("gold/dim_customer_current", new)
    of_products = tables.touched("gold/dim_product", new)
    customers, products = tables.dim_customer(of_customers), tables.read("gold/dim_product", of_products)

    def add_members(table: str, key: str, infer, dim: DataFrame) -> DataFrame:
        inferred = load.stage(f"inferred_{key}", infer(new, dim, load.last_key(key), load.stage))
        load.add(table, inferred, f"inferred_{key}")
        load.advance_key(key, load.rows[f"inferred_{key}"])
        return inferred

    inferred = together(
        lambda: add_members("gold/dim_customer_current", "customer_key", dimensions.infer_customers, customers),
        lambda: add_members("gold/dim_product", "product_key", dimensions.infer_products, products),
    )
    rows = fact.fact_rows(
        new, customers.unionByName(inferred[0]), products.unionByName(inferred[1]), tables.read("gold/dim_store"), load.stage
    )
    load.write("gold/fact_sales", fact.numbered(rows, load.last_key("sale_key"), load.stage))
    load.advance_key("sale_key", load.rows["gold/fact_sales"])


def _process(
    tables: Tables, batch: DataFrame, feed: str, feed_batch: str, run: audit.Run, clock: Clock,
    work: Callable[[Load, Column], None],
) -> str | None:
    """Audit and load log around one batch. A failure leaves a FAILED event, no change, and is raised again."""
    with tables.one_writer():
        return _load_batch(tables, batch, feed, feed_batch, run, clock, work)


def _load_batch(
    tables: Tables, batch: DataFrame, feed: str, feed_batch: str, run: audit.Run, clock: Clock,
    work: Callable[[Load, Column], None],
) -> str | None:
    load = tables.begin(feed, feed_batch)
    if load is None:
        return None
    started = clock()
    try:
        work(load, _moment(started))
        if run.read == 0:
            return None
        ended = clock()
        events = [run.started(started), run.event(audit.SUCCESS, ended)]
        load.write("control/run_events", audit.events_frame(tables.spark, events))
        made = load.decide(ended)
    except Exception as error:
        if run.batch_id is None:  # it broke while the batch was read for the first time
            run.read, run.batch_id = batch.agg(F.count(F.lit(1)), F.max("_batch_id")).first()
        failure = run.event(audit.FAILED, clock(), f"{type(error).__name__}: {error}")
        # Outside the load, of which nothing remains.
        audit.events_frame(tables.spark, [failure]).write.mode("append").parquet(failures_path(tables))
        raise
    tables.publish(made)
    return run.summary()


def failures_path(tables: Tables) -> str:
    return f"{tables.root}/control/run_failures"


def run_events(tables: Tables) -> DataFrame:
    """All run events: those committed with their batch, and those of runs that failed."""
    failed = read_or_empty(tables.spark, failures_path(tables), schemas.RUN_EVENTS)
    return tables.read("control/run_events").unionByName(failed.select(*schemas.RUN_EVENTS.fieldNames()))


# The process names below.


def process_customers(
    tables: Tables, batch: DataFrame, feed: str, feed_batch: str, clock: Clock = utc_now, ignore_stale: bool = False
) -> str | None:
    """Upsert silver customers and maintain the Type 2 dimension. Returns the run summary, or None if nothing to do."""
    run = audit.Run("CUSTOMER", "PROCESS_CUSTOMER_INCREMENTAL")
    return _process(
        tables, batch, feed, feed_batch, run, clock, lambda load, now: _customers(load, batch, run, now, ignore_stale)
    )


def process_products(
    tables: Tables, batch: DataFrame, feed: str, feed_batch: str, clock: Clock = utc_now
) -> str | None:
    """Upsert silver products and overwrite the Type 1 dimension."""
    run = audit.Run("PRODUCT", "PROCESS_PRODUCT_INCREMENTAL")
    return _process(tables, batch, feed, feed_batch, run, clock, lambda load, now: _products(load, batch, run, now))


def process_sales(tables: Tables, batch: DataFrame, feed: str, feed_batch: str, clock: Clock = utc_now) -> str | None:
    """Append new valid sales to silver and fact, creating inferred dimension members where needed."""
    run = audit.Run("SALES", "PROCESS_SALES_INCREMENTAL")
    return _process(tables, batch, feed, feed_batch, run, clock, lambda load, now: _sales(load, batch, run, now))
