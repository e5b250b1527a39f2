"""Session settings the plans are written for, and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# AQE splits skewed join partitions, also where that costs an extra shuffle, and coalesces small ones. Joins are
# broadcast only under the size threshold, which AQE re-checks against measured shuffle sizes.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def with_recommended_conf(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


#: For files that are written to be read once or twice and removed. Most columns of a batch hold many values, and to try a dictionary
#: for each of them costs more than the rest of the write.
WORKING = {"parquet.enable.dictionary": "false"}

#: For working files below the scratch folder, which stay until the folder is cleared: less than half the bytes for the same CPU time.
SCRATCH = {**WORKING, "compression": "zstd"}

#: Columns that hold about as many values as rows, or as an entity has members: a dictionary tried for them is given up again.
_MANY_VALUES = (
    "sale_id", "customer_id", "product_id", "business_key", "sale_key", "customer_key", "product_key", "email", "phone", "_row_number",
    "unit_price", "gross_amount", "net_amount",
)

#: For files that stay. All other columns have dictionaries.
KEPT = {f"parquet.enable.dictionary#{column}": "false" for column in _MANY_VALUES}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the session's ``spark.checkpoint.dir``.

    Only a session that runs in one process falls back, without that setting, to the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/ledgerline/{purpose}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder."""
    files, folder = _folder(spark, path)
    return files.getContentSummary(folder).getLength()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder, on whatever file system the path names."""
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of working data, if it is there."""
    files, folder = _folder(spark, path)
    files.delete(folder, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, list] = {}  # by session: how many writes are under way, and the setting they found
_counting = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files as they end, instead of leaving them until the driver happens to collect its garbage.

    For frames that are written once: to run one again would repeat its shuffles. Writes of several threads may overlap.
    """
    session = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"
    with _counting:
        under_way = _cleaning.setdefault(session, [0, None])
        if not under_way[0]:
            under_way[1] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        under_way[0] += 1
    try:
        yield
    finally:
        with _counting:
            under_way[0] -= 1
            if not under_way[0]:
                found = _cleaning.pop(session)[1]
                spark.conf.unset(_CLEANUP) if found is None else spark.conf.set(_CLEANUP, found)


def together(*writes: Callable[[], object]) -> list:
    """Run independent writes at the same time and wait for all of them.

    Spark shares the cluster between their jobs, so the last tasks of one write do not keep the others waiting. The
    first failure is raised.
    """
    if not writes:
        return []
    session = SparkSession.getActiveSession()
    carry = inheritable_thread_target(session) if session else lambda write: write  # job groups and cancellation reach them
    with ThreadPoolExecutor(len(writes)) as pool:
        return [job.result() for job in [pool.submit(carry(write)) for write in writes]]
