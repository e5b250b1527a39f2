"""Dense surrogate keys, numbered from written files.

A written file keeps its rows in order, and Parquet tells each row its place in it. The number of rows of each file, which the
footers hold, gives every file its first key. So rows are written once and read once, nothing is sorted, shuffled or evaluated
again, and a task that is repeated hands out the same keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.session import SCRATCH, scratch_dir, shuffles_removed

Stage = Callable[[str, DataFrame], DataFrame]


def in_scratch(name: str, df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.options(**SCRATCH).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_read(_: str, df: DataFrame) -> DataFrame:
    """For rows that are read from files already."""
    return df


def assign_keys(df: DataFrame, key: str, after: int | DataFrame = 0, stage: Stage = in_scratch) -> DataFrame:
    """Add ``key``, dense and continuing after ``after``: the last key, or a frame whose highest ``key`` it is.

    ``stage`` writes the rows and reads them back. Which row gets which key depends on the files it writes.
    """
    rows = stage(f"rows_for_{key}", df)
    places = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    # One row per file, whatever the files hold. The driver lists the files to read them, so their counts are small enough for a
    # window without partitions and for a broadcast.
    counts = rows.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1))
    firsts = counts.select("_file", F.coalesce(before, F.lit(0)).alias("_first"))
    if isinstance(after, DataFrame):
        last = after.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
        firsts = firsts.select("_file", (F.col("_first") + last).alias("_first"))
        after = 0
    numbered = places.join(F.broadcast(firsts), "_file")
    return numbered.select((F.col("_first") + F.col("_place") + F.lit(after + 1)).alias(key), *df.columns)
