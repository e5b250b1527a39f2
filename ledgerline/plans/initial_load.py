"""The first load: raw batch ``INITIAL`` through silver and quarantine into the star schema.

The tables are empty, or lack some of what raw holds, so they are written in place, without a second copy of everything in staging.
A load that breaks off is not in the log; run again, it overwrites the partitions it had written.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import audit, cleanse, dimensions, fact, quarantine, rules, silver
from ledgerline.operators.merge import absent_from
from ledgerline.session import together
from ledgerline.sources import raw
from ledgerline.streaming.tables import Logged, Tables

FEED = "initial_load"


def run_initial_load(
    tables: Tables, now: datetime | None = None, rerun: str = "0", calendar_start: date = dimensions.CALENDAR_START,
    calendar_days: int = dimensions.CALENDAR_DAYS,
) -> Logged | None:
    """Load what raw ``INITIAL`` holds and the tables lack. Safe to rerun: pass a new ``rerun`` label to do so."""
    with tables.one_writer():
        return _load(tables, now, rerun, calendar_start, calendar_days)


def _load(tables: Tables, now: datetime | None, rerun: str, calendar_start: date, calendar_days: int) -> Logged | None:
    load = tables.begin(FEED, rerun, in_place=True)
    if load is None:
        return None
    spark = tables.spark
    stamp = F.localtimestamp() if now is None else F.lit(now).cast("timestamp_ntz")

    def entity_rows(entity: str):
        """Silver rows of one entity; returns its rejects."""
        batch = silver.assessed(raw.read_raw(spark, tables.root, entity, raw.INITIAL), entity)
        kept = F.when(F.col(rules.REASON).isNotNull(), F.col(cleanse.ORIGINAL))
        assessed = load.stage(f"assessed_{entity}", batch.withColumn(cleanse.ORIGINAL, kept))
        load.add(f"silver/{entity}", silver.load_silver(assessed, entity, tables.read(f"silver/{entity}")))
        return quarantine.rejected(assessed, entity, stamp)

    rejects = reduce(DataFrame.unionByName, together(*(partial(entity_rows, entity) for entity in schemas.BUSINESS_COLUMNS)))

    def add_members(table: str, key: str, build, source: str, dim: DataFrame) -> None:
        load.add(table, build(tables.read(source), dim, load.last_key(key), load.stage))
        load.advance_key(key, load.rows[table])

    known = tables.read("silver/rejected_records")
    dims = (
        ("gold/dim_customer_current", "customer_key", dimensions.init_dim_customer, "silver/customers", tables.dim_customer()),
        ("gold/dim_product", "product_key", dimensions.init_dim_product, "silver/products", tables.read("gold/dim_product")),
        ("gold/dim_store", "store_key", dimensions.init_dim_store, "silver/stores", tables.read("gold/dim_store")),
    )
    together(
        lambda: load.add("silver/rejected_records", quarantine.unseen(rejects, known)),
        *(partial(add_members, *dim) for dim in dims),
        lambda: load.add("gold/dim_date", dimensions.build_dim_date(spark, calendar_start, calendar_days, tables.read("gold/dim_date"))),
    )
    rows = fact.fact_rows(
        absent_from(tables.read("silver/sales"), tables.read("gold/fact_sales"), "sale_id"),
        tables.dim_customer(), tables.read("gold/dim_product"), tables.read("gold/dim_store"), load.stage,
    )
    load.add("gold/fact_sales", fact.numbered(rows, load.last_key("sale_key"), load.stage))
    load.advance_key("sale_key", load.rows["gold/fact_sales"])
    checkpoint = audit.checkpoint(tables.read("gold/fact_sales"), stamp)
    monitoring = load.stage("monitoring", audit.upsert_checkpoint(tables.read("control/pipeline_monitoring"), checkpoint))
    load.write("control/pipeline_monitoring", monitoring)
    return load.commit(now)
