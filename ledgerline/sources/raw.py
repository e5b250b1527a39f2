"""The raw layer: append-only text tables, one folder per batch and load, never changed.

A batch is the unit that feeds process. It may land in several appends; the feed sees it once it is declared complete. Entities
declared together become visible together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.session import KEPT, exists, shuffles_removed

INITIAL = "INITIAL"
#: Optional column of a change feed that says what happened to a row.
ACTION = "_action"


def raw_path(root: str, entity: str) -> str:
    return f"{root}/raw/{entity}"


COMPLETE = T.StructType(
    [T.StructField("entity", T.StringType()), T.StructField("batch_id", T.StringType()), T.StructField("completed_at", T.TimestampNTZType())]
)


def complete_path(root: str) -> str:
    return f"{root}/raw_complete"


#: Partition column that tells the loads of a batch apart.
LOAD = "_load"


def append_raw(rows: DataFrame, root: str, entity: str, complete: bool = True, load: str | None = None) -> int:
    """Append rows of one or more batches; returns how many. Pass ``complete=False`` for a piece of a batch of which more is to come.

    A ``load`` of the same name overwrites what it wrote before, so a step that is repeated adds nothing; without a name every call
    is a load of its own. An ``_action`` column, if there is one, is kept for the feed.
    """
    action = [ACTION] if ACTION in rows.columns else []
    observed = Observation()
    ordered = rows.select(*schemas.RAW[entity].fieldNames(), *action).withColumn(LOAD, F.lit(load or uuid.uuid4().hex)).observe(
        observed, F.collect_set("_batch_id").alias("batches"), F.count(F.lit(1)).alias("rows")
    )
    writer = ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**KEPT)
    with shuffles_removed(rows.sparkSession):
        writer.partitionBy("_batch_id", LOAD).parquet(raw_path(root, entity))
    found = observed.get or {}
    if complete:
        _declare(rows.sparkSession, root, [(entity, batch) for batch in sorted(found.get("batches") or [])])
    return found.get("rows") or 0


def complete_batch(spark: SparkSession, root: str, batch_id: str, *entities: str) -> None:
    """Declare a batch complete, of one entity or of several that landed together, so that feeds take it up as a whole."""
    _declare(spark, root, [(entity, batch_id) for entity in entities])


def _declare(spark: SparkSession, root: str, batches: list[tuple[str, str]]) -> None:
    """One file, so that a feed sees all of its batches or none."""
    declared = spark.createDataFrame(batches, "entity string, batch_id string").withColumn("completed_at", F.localtimestamp())
    declared.coalesce(1).write.mode("append").parquet(complete_path(root))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A declared table that has no files yet reads as an empty frame."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_raw(spark: SparkSession, root: str, entity: str, batch_id: str | None = None, actions: bool = False) -> DataFrame:
    """All rows, or one batch through partition pruning; ``actions`` adds the action column, null where a row came without."""
    schema = schemas.RAW[entity]
    if actions:
        schema = T.StructType([*schema.fields, T.StructField(ACTION, T.StringType())])
    rows = read_or_empty(spark, raw_path(root, entity), schema).select(*schema.fieldNames())
    return rows if batch_id is None else rows.filter(F.col("_batch_id") == batch_id)


def stream_batches(spark: SparkSession, root: str, entities: tuple[str, ...]) -> DataFrame:
    """Batches of ``entities`` declared complete since the consumer's checkpoint. The initial load is not part of the feed.

    Nothing needs to have landed yet.
    """
    path = complete_path(root)
    if not exists(spark, path):
        spark.createDataFrame([], COMPLETE).write.mode("ignore").parquet(path)
    declared = spark.readStream.schema(COMPLETE).parquet(path)
    return declared.filter((F.col("batch_id") != INITIAL) & F.col("entity").isin(*entities))


def load_history(raw: DataFrame, since: Column | None = None) -> DataFrame:
    """Files loaded in the last seven days (or after ``since``), newest first, with their row counts."""
    since = F.localtimestamp() - F.expr("INTERVAL 7 DAYS") if since is None else since
    loads = raw.filter(F.col("_loaded_at") >= since).groupBy("_source_file", "_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("_loaded_at").alias("first_load_time"),
        F.max("_loaded_at").alias("last_load_time"),
    )
    return loads.orderBy(F.desc("last_load_time"), "_source_file")


def inserted(changes: DataFrame) -> DataFrame:
    """The rows of a change feed that were inserted; a row without an action was."""
    if ACTION not in changes.columns:
        return changes
    return changes.filter(F.coalesce(ACTION, F.lit("INSERT")) == "INSERT").drop(ACTION)
