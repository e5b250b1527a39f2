"""The change feed: raw batches processed once each and in order, whenever Structured Streaming finds them declared complete.

One stream carries the declarations of all entities. The batches of a trigger are taken in the order in which their first entity was
declared, and within a batch customers and products come before the sales that refer to them; so no member is inferred whose
row has landed with the sale. However many files or triggers a batch took to land, it is read, deduplicated and guarded as a whole.
No feed runs until asked to, and a trigger without new batches runs nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans import incremental
from ledgerline.plans.incremental import Clock, utc_now
from ledgerline.sources.raw import inserted, read_raw, stream_batches
from ledgerline.streaming.tables import Tables

#: In the order of processing.
PROCESSES: dict[str, Callable[..., str | None]] = {
    "customers": incremental.process_customers,
    "products": incremental.process_products,
    "sales": incremental.process_sales,
}
ENTITIES = tuple(PROCESSES)


def ordered(declared: DataFrame) -> DataFrame:
    """One row per batch and entity, in the order of processing."""
    batches = declared.groupBy("entity", "batch_id").agg(F.min("completed_at").alias("at"))
    began = F.min("at").over(W.partitionBy("batch_id"))
    rank = F.array_position(F.array(*[F.lit(e) for e in ENTITIES]), F.col("entity"))
    return batches.withColumn("began", began).orderBy("began", "batch_id", rank)


def _handler(tables: Tables, clock: Clock):
    def handle(declared: DataFrame, _: int) -> None:
        for batch in ordered(declared).collect():  # what was declared since the last trigger
            entity = batch["entity"]
            rows = inserted(read_raw(tables.spark, tables.root, entity, batch["batch_id"], actions=True))
            # Named by the declaration, so that it is not processed again under a new checkpoint.
            PROCESSES[entity](tables, rows, f"{entity}_feed", f"{batch['batch_id']}@{batch['at'].isoformat()}", clock)

    return handle


def start(tables: Tables, entities: tuple[str, ...] = ENTITIES, clock: Clock = utc_now, **trigger) -> StreamingQuery:
    """Start the feed, of all entities or of some; ``trigger`` as for ``DataStreamWriter.trigger`` (default: drain and stop)."""
    name = "_".join(entities)
    writer = stream_batches(tables.spark, tables.root, entities).writeStream.queryName(f"{name}_feed").option(
        "checkpointLocation", f"{tables.root}/checkpoints/{name}"
    )
    return writer.foreachBatch(_handler(tables, clock)).trigger(**(trigger or {"availableNow": True})).start()


def run_available(tables: Tables, entities: tuple[str, ...] = ENTITIES, clock: Clock = utc_now) -> None:
    """Process what is waiting, and return."""
    start(tables, entities, clock).awaitTermination()
