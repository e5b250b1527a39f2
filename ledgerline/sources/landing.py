"""CSV landing: named entity files, plain or gzip, read as text with ingest metadata, by force or once each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.streaming import StreamingQuery

from ledgerline import schemas
from ledgerline.operators.keys import Stage, in_scratch
from ledgerline.sources.raw import append_raw, complete_batch

# Literals that mean NULL in a landing file.
NULL_WORDS = ("NULL", "null")

# Quotes are escaped by doubling; spaces are kept; a row with too few or too many fields fails the load.
CSV_OPTIONS = {
    "header": "true", "sep": ",", "quote": '"', "escape": '"', "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "recursiveFileLookup": "true",
}


def file_pattern(entity: str, batch_id: str) -> str:
    """Glob for the files of one entity and batch, e.g. ``*customers_batch_01.csv`` with or without ``.gz``."""
    return f"*{entity}_{batch_id.lower()}.csv{{,.gz}}"


def _fields(reader, entity: str, path: str, pattern: str, multiline: bool) -> DataFrame:
    """Fields by position; an empty field stays the empty text, only the NULL words become NULL."""
    names = schemas.BUSINESS_COLUMNS[entity]
    reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    rows = reader.options(**CSV_OPTIONS).option("pathGlobFilter", pattern).option("multiLine", multiline).csv(path)
    fields = [
        F.when(F.col(n).isin(*NULL_WORDS), F.lit(None)).otherwise(F.coalesce(n, F.lit(""))).alias(n) for n in names
    ]
    return rows.select(
        *fields, F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def _with_row_numbers(rows: DataFrame, stage: Stage) -> DataFrame:
    """Position of each row in its file, without putting a file into one task.

    A file is read in splits, each in order. The rows are staged, so that the text is parsed once; counting rows per split then gives
    every split its first number, and the scan id counts on from there. There is one count per split, as the driver lists them to
    read the files.
    """
    rows = stage("parsed", rows.withColumn("_scan_id", F.monotonically_increasing_id()))
    splits = rows.groupBy("_source_file", "_block").agg(
        F.min("_scan_id").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = F.sum("_rows").over(
        W.partitionBy("_source_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    )
    shift = splits.select(
        "_source_file", "_block", (F.coalesce(earlier, F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    numbered = rows.join(F.broadcast(shift), ["_source_file", "_block"])
    return numbered.withColumn("_row_number", F.col("_scan_id") + F.col("_shift"))


def _raw_rows(fields: DataFrame, entity: str, batch_id: str, loaded_at: Column | None, stage: Stage) -> DataFrame:
    loaded = F.localtimestamp() if loaded_at is None else loaded_at
    return _with_row_numbers(fields, stage).withColumns({"_loaded_at": loaded, "_batch_id": F.lit(batch_id)}).select(
        *schemas.RAW[entity].fieldNames()
    )


def ingest_csv(
    spark: SparkSession, path: str, entity: str, batch_id: str, loaded_at: Column | None = None,
    pattern: str | None = None, multiline: bool = False, stage: Stage = in_scratch,
) -> DataFrame:
    """Raw rows of the matching files: always a full (forced) load, whatever was loaded before.

    A malformed row raises. ``multiline`` allows line breaks inside quotes at the price of unsplittable files.
    """
    return _raw_rows(_fields(spark.read, entity, path, pattern or file_pattern(entity, batch_id), multiline), entity, batch_id, loaded_at, stage)


def start_landing(
    spark: SparkSession, path: str, root: str, entity: str, batch_id: str, loaded_at: Column | None = None,
    pattern: str | None = None, multiline: bool = False, complete: bool = True, **trigger,
) -> StreamingQuery:
    """Load the files of one entity and batch into raw as they arrive, each once: the checkpoint remembers what was loaded.

    ``trigger`` as for ``DataStreamWriter.trigger`` (default: load what is there and stop). With ``complete`` the batch is declared
    complete after every trigger that loaded something, and a feed takes up what was added. A trigger that is repeated
    after a failure overwrites what it had written. To load files again, use ``ingest_csv``.
    """
    files = _fields(spark.readStream, entity, path, pattern or file_pattern(entity, batch_id), multiline)
    name = f"landing_{entity}_{batch_id.lower()}"
    checkpoint = f"{root}/checkpoints/{name}"

    def load(arrived: DataFrame, trigger_number: int) -> None:
        rows = _raw_rows(arrived, entity, batch_id, loaded_at, in_scratch)
        if append_raw(rows, root, entity, complete=False, load=f"{name}-{trigger_number}") and complete:
            complete_batch(arrived.sparkSession, root, batch_id, entity)

    writer = files.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(load).trigger(**(trigger or {"availableNow": True})).start()


def list_landing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files waiting in the landing. Only their metadata is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(path).select("path", "length", "modificationTime")
