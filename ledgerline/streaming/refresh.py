"""The maintained daily summary: what new facts add to their days."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline import schemas
from ledgerline.operators.fact import daily_sales_summary, summed_days
from ledgerline.streaming.tables import LOADS, Logged, Tables

FEED = "daily_summary"
FACT, SUMMARY = "gold/fact_sales", "gold/daily_sales_summary"


def refresh_daily_summary(tables: Tables, now: datetime | None = None) -> Logged | None:
    """Bring the summary up to the latest load of facts; None if it is there already.

    A sale enters the fact once, so all totals of a day, its number of sales included, are those it had plus those of its new
    facts. Only the partitions of the new loads and the months of the summary they fall into are read.
    """
    with tables.one_writer():
        return _refresh(tables, now)


def _refresh(tables: Tables, now: datetime | None) -> Logged | None:
    log = tables.log()
    covered = log.filter(F.col("feed") == FEED).agg(F.max(F.col("feed_batch").cast("long"))).first()[0] or 0
    # the loads since then that wrote facts: as many as there were batches
    fresh = [r[0] for r in log.filter((F.col("load") > covered) & F.array_contains("wrote", FACT)).select("load").collect()]
    if not fresh:
        return None
    load = tables.begin(FEED, str(max(fresh)))
    if load is None:
        return None
    added = load.stage("added_days", daily_sales_summary(tables.stored(FACT).filter(F.col("load").isin(fresh))))
    before = tables.read(SUMMARY, tables.touched(SUMMARY, added))
    load.write(SUMMARY, summed_days(before.unionByName(added)).select(*schemas.DAILY_SALES_SUMMARY.fieldNames()))
    return load.commit(now)


def start_summary(tables: Tables, **trigger) -> StreamingQuery:
    """Refresh after loads, every five minutes unless told otherwise. The load log is the stream."""

    def handle(loads: DataFrame, _: int) -> None:
        refresh_daily_summary(tables)

    loads = tables.spark.readStream.schema(LOADS).parquet(tables.log_path)
    writer = loads.writeStream.queryName(FEED).option("checkpointLocation", f"{tables.root}/checkpoints/{FEED}")
    return writer.foreachBatch(handle).trigger(**(trigger or {"processingTime": "5 minutes"})).start()
