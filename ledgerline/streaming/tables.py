"""The lake's tables: plain partitioned Parquet, changed by loads.

A table with a business key is laid out by a hash of it (``bucket``), so a load reads and writes only the buckets its keys fall
into. Two kinds of table exist. *Merged* ones hold one current row per key, and a load overwrites the partitions of the buckets it
touches. In *appended* ones every load has partitions of its own (``load``), so writing them again changes nothing.

A load writes what it will change below ``staging/``, then one row into the load log, and then overwrites those partitions from
staging, which is removed at the end. Before the log row nothing has changed; after it the load is done, and should the last step
break off, the next load begins by repeating it. Writers of one application take turns; of two applications that began at the same
load, the second finds the log row taken and fails without having changed anything. There are no versions: a reader who needs all tables as of one
load reads between loads.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.session import KEPT, WORKING, exists, remove, shuffles_removed, together
from ledgerline.sources.raw import read_or_empty

#: Buckets of a new lake: choose so that one bucket of the largest table fits a task. A lake keeps the number it was made with.
BUCKETS = 8


def hashed(key: str) -> Callable[[int], Column]:
    return lambda buckets: F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def month_of(at: str) -> Callable[[int], Column]:
    return lambda _: (F.year(at) * 100 + F.month(at)).cast("int")


@dataclass(frozen=True)
class Layout:
    """Columns of a table, what its buckets are made from, further partition columns, and the order inside a file."""

    schema: T.StructType
    bucket: Callable[[int], Column] | None = None
    merged: bool = False
    by: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    @property
    def partitions(self) -> list[str]:
        return [*(["bucket"] if self.bucket else []), *self.by, *([] if self.merged else ["load"])]

    @property
    def stored(self) -> T.StructType:
        own = [T.StructField(c, T.IntegerType() if c == "bucket" else T.LongType()) for c in self.partitions if c in ("bucket", "load")]
        return T.StructType([*self.schema.fields, *own])


LAYOUTS = {
    "silver/customers": Layout(schemas.SILVER["customers"], hashed("customer_id"), merged=True),
    "silver/products": Layout(schemas.SILVER["products"], hashed("product_id"), merged=True),
    "silver/stores": Layout(schemas.SILVER["stores"]),
    "silver/sales": Layout(schemas.SILVER["sales"], hashed("sale_id")),
    "silver/rejected_records": Layout(schemas.REJECTED_RECORDS, by=("batch_id",)),
    "gold/dim_customer_current": Layout(schemas.DIM_CUSTOMER, hashed("customer_id"), merged=True),
    "gold/dim_customer_closed": Layout(schemas.DIM_CUSTOMER, hashed("customer_id")),
    "gold/dim_product": Layout(schemas.DIM_PRODUCT, hashed("product_id"), merged=True),
    "gold/dim_store": Layout(schemas.DIM_STORE),
    "gold/dim_date": Layout(schemas.DIM_DATE),
    # A span of time is found in each bucket by the statistics of its files and row groups, which are in order of time.
    "gold/fact_sales": Layout(schemas.FACT_SALES, hashed("sale_id"), order=("sale_timestamp",)),
    "gold/daily_sales_summary": Layout(schemas.DAILY_SALES_SUMMARY, month_of("sale_date"), merged=True),
    "control/run_events": Layout(schemas.RUN_EVENTS),
    "control/pipeline_monitoring": Layout(schemas.PIPELINE_MONITORING, lambda _: F.lit(0), merged=True),
}

LOADS = T.StructType(
    [
        T.StructField("load", T.LongType()),
        T.StructField("feed", T.StringType()),
        T.StructField("feed_batch", T.StringType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("wrote", T.ArrayType(T.StringType())),
        T.StructField("last_keys", T.MapType(T.StringType(), T.LongType())),
    ]
)


class ConflictingLoad(RuntimeError):
    """Another writer has finished a load since this one began."""


@dataclass(frozen=True)
class Logged:
    """One finished load: who made it, the tables it wrote, and the highest key of each kind handed out so far."""

    load: int = 0
    feed: str | None = None
    feed_batch: str | None = None
    committed_at: datetime | None = None
    wrote: tuple[str, ...] = ()
    last_keys: dict[str, int] = field(default_factory=dict)


#: One writer at a time for all tables of this application; a step inside a longer one may take it again.
_writing = threading.RLock()


class Tables:
    """Read access to a lake, and the way to change it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        path = f"{self.root}/control/layout"
        if not exists(spark, path):
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("ignore").parquet(path)
        self.buckets = spark.read.schema("buckets int").parquet(path).first()[0]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def staging(self, load: int) -> str:
        return f"{self.root}/staging/load={load}"

    @property
    def log_path(self) -> str:
        return f"{self.root}/control/loads"

    def log(self) -> DataFrame:
        """The finished loads: one short row each."""
        return read_or_empty(self.spark, self.log_path, LOADS).select(*LOADS.fieldNames())

    def last(self) -> Logged:
        rows = self.log().orderBy(F.desc("load")).limit(1).collect()
        return Logged(**{**rows[0].asDict(), "wrote": tuple(rows[0]["wrote"])}) if rows else Logged()

    def one_writer(self) -> threading.RLock:
        """To be held from ``begin`` to ``commit``."""
        return _writing

    def stored(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """The table with its partition columns, or the given buckets of it: the folders of the others are not opened."""
        rows = read_or_empty(self.spark, self.path(table), LAYOUTS[table].stored)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        return self.stored(table, buckets).select(*LAYOUTS[table].schema.fieldNames())

    def dim_customer(self, buckets: list[int] | None = None) -> DataFrame:
        """All versions of all customers, or of those in the given buckets."""
        return self.read("gold/dim_customer_current", buckets).unionByName(self.read("gold/dim_customer_closed", buckets))

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets of ``table`` that the keys of ``rows`` fall into: as many numbers as there are buckets at most."""
        found = rows.select(LAYOUTS[table].bucket(self.buckets).alias("bucket")).distinct()
        return sorted(r[0] for r in found.collect())

    def begin(self, feed: str, feed_batch: str, in_place: bool = False) -> Load | None:
        """A load of one batch of a feed; None if that batch is already in the log.

        With ``in_place`` nothing is staged: a first load into empty tables writes them directly, and is run again if it breaks off.
        """
        last = self.last()
        if exists(self.spark, self.staging(last.load)):
            self.publish(last)
        if not self.log().filter((F.col("feed") == feed) & (F.col("feed_batch") == feed_batch)).isEmpty():
            return None
        remove(self.spark, self.staging(last.load + 1))  # of an attempt that failed
        return Load(self, last, feed, feed_batch, in_place)

    def publish(self, load: Logged) -> None:
        """Overwrite the partitions that a logged load has staged. May be repeated."""

        def overwrite(table: str) -> None:
            staged = f"{self.staging(load.load)}/{table}"
            if exists(self.spark, staged):
                write(self.spark.read.schema(LAYOUTS[table].stored).parquet(staged), table, self.path(table))

        together(*(partial(overwrite, table) for table in load.wrote))
        remove(self.spark, self.staging(load.load))


def write(df: DataFrame, table: str, path: str) -> None:
    """Overwrite those partitions of ``path`` that occur in ``df``."""
    _overwrite(df, table, path, KEPT)


def write_staged(df: DataFrame, table: str, path: str) -> None:
    """``write``, for rows that are written again when they are published."""
    _overwrite(df, table, path, WORKING)


def _overwrite(df: DataFrame, table: str, path: str, options: dict[str, str]) -> None:
    layout = LAYOUTS[table]
    if layout.order:
        df = df.sortWithinPartitions(*layout.partitions, *layout.order)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
    with shuffles_removed(df.sparkSession):
        writer.partitionBy(*layout.partitions).parquet(path)


class Load:
    """What one batch will change."""

    def __init__(self, tables: Tables, last: Logged, feed: str, feed_batch: str, in_place: bool):
        self.tables, self.last = tables, last
        self.number = last.load + 1
        self.feed, self.feed_batch, self.in_place = feed, feed_batch, in_place
        self.rows: dict[str, int] = {}  #: rows written, by table or working set
        self.measured: dict[str, dict] = {}  #: what else was measured on the way
        self._wrote: list[str] = []
        self._keys = dict(last.last_keys)

    def _target(self, table: str) -> str:
        return self.tables.path(table) if self.in_place else f"{self.tables.staging(self.number)}/{table}"

    def _counted(self, name: str, df: DataFrame, save: Callable[[DataFrame], None], *measures: Column) -> None:
        """Write and count in one job: the counters sit next to the writer, where a repeated task counts once."""
        observed = Observation()
        save(df.observe(observed, F.count(F.lit(1)).alias("rows"), *measures))
        self.measured[name] = observed.get or {}
        self.rows[name] = self.measured[name].get("rows") or 0

    def stage(self, name: str, df: DataFrame, *measures: Column) -> DataFrame:
        """Write a working set and read it back: computed once, counted, and not lost with an executor."""
        path = f"{self.tables.staging(self.number)}/working/{name}"
        with shuffles_removed(df.sparkSession):
            self._counted(name, df, lambda d: d.write.mode("overwrite").options(**WORKING).parquet(path), *measures)
        return self.tables.spark.read.schema(df.schema).parquet(path)

    def write(self, table: str, df: DataFrame, laid_out: bool = False) -> None:
        """The rows of a load, or, of a merged table, whole buckets as they shall be.

        Rows read from a table of as many buckets are ``laid_out``: they come with their bucket, one file holds one bucket, and they
        are written as they are read.
        """
        if table in self._wrote:
            raise ValueError(f"{table} is already written in load {self.number}")
        layout = LAYOUTS[table]
        df = df.select(*layout.schema.fieldNames(), *(["bucket"] if laid_out and layout.bucket else []))
        if layout.bucket and not laid_out:
            # gathers each bucket into few files, and splits one too large for a task
            df = df.withColumn("bucket", layout.bucket(self.tables.buckets)).hint("rebalance", "bucket")
        if not layout.merged:
            df = df.withColumn("load", F.lit(self.number).cast("long"))
        save = write if self.in_place else write_staged
        self._counted(table, df, lambda d: save(d, table, self._target(table)))
        self._wrote.append(table)

    def add(self, table: str, rows: DataFrame, staged: str | None = None) -> None:
        """New rows, of keys that are not there yet, or the working set ``staged`` of such rows. Of a merged table only the buckets they
        fall into are written anew."""
        if LAYOUTS[table].merged and not self.tables.read(table).isEmpty():
            if staged is None:
                staged = f"added/{table}"
                rows = self.stage(staged, rows)
            added = self.rows[staged]
            if added:
                before = self.tables.read(table, self.tables.touched(table, rows))
                self.write(table, before.unionByName(rows))
            self.rows[table] = added
        else:
            self.write(table, rows)

    def written(self, table: str) -> DataFrame:
        """What this load has written to ``table``."""
        layout = LAYOUTS[table]
        rows = read_or_empty(self.tables.spark, self._target(table), layout.stored)
        if not layout.merged:
            rows = rows.filter(F.col("load") == self.number)
        return rows.select(*layout.schema.fieldNames())

    def last_key(self, key: str) -> int:
        """Highest surrogate key handed out so far, without reading the table."""
        return self._keys.get(key, 0)

    def advance_key(self, key: str, by: int) -> None:
        """``by`` further keys, without gaps, have been handed out."""
        self._keys[key] = self.last_key(key) + by

    def commit(self, committed_at: datetime | None = None) -> Logged:
        made = self.decide(committed_at)
        self.tables.publish(made)
        return made

    def decide(self, committed_at: datetime | None = None) -> Logged:
        """Put the load into the log: from here on it is done, whether or not its publication breaks off."""
        at = committed_at or datetime.now(timezone.utc).replace(tzinfo=None)
        made = Logged(self.number, self.feed, self.feed_batch, at, tuple(self._wrote), self._keys)
        row = tuple(getattr(made, f) for f in LOADS.fieldNames() if f != "load")
        marker = self.tables.spark.createDataFrame([row], T.StructType(LOADS.fields[1:])).coalesce(1)
        try:
            marker.write.mode("errorifexists").parquet(f"{self.tables.log_path}/load={self.number}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise ConflictingLoad(f"load {self.number} was made by another writer; begin again") from error
        return made
