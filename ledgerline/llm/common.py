"""What the operators of this folder share: bounded Arrow slices, tables between steps, keys of rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

#: The folder this library was imported from.
LIBRARY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows an Arrow batch may hold, and bytes of text that one step of vectorised work takes at a time.
BATCH_ROWS = 512
SLICE_BYTES = 1 << 21


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for whole texts, and let workers find this library where the driver found it.

    On a cluster whose machines do not have it there, it comes with the job as usual (``--py-files``).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if LIBRARY not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, LIBRARY])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(text: str = "text"):
    """Tells repeated ids with different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts hold about ``limit`` bytes; one longer text is a run by itself."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's UTF-8 bytes; a null is empty."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()


def by_slices(work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str):
    """A function for mapInArrow that applies ``work`` to slices of bounded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield work(part)

    return run


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values on end, and where each begins and the last ends; a null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]
