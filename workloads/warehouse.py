"""The driver's tables run through the whole life of the tables: initial load, then two batches through the feeds."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans.incremental import process_customers
from ledgerline.plans.initial_load import run_initial_load
from ledgerline.session import scratch_dir, shuffles_removed, size_of, together
from ledgerline.sources.raw import append_raw, complete_batch, read_raw
from ledgerline.streaming.feeds import run_available, start
from ledgerline.streaming.refresh import refresh_daily_summary
from ledgerline.streaming.tables import LAYOUTS, Tables
from workloads import retail

#: Bytes of tables from which their rows are written as they come: by then they lie in many row groups, and to deal all rows out once
#: more would cost as much disk as the CSV files of them.
LARGE = 64 << 20

_built: dict[tuple[str, ...], object] = {}
#: The batches that a load under way will go on to, by application and tables.
_wanted: dict[tuple[str, str], tuple[str, ...]] = {}


def landed(spark: SparkSession, sf_dir: str, entity: str, batch_id: str | None = None) -> DataFrame:
    """All raw rows of ``entity``, or one of its batches: derived once per application and written, as a landing is."""

    def write() -> str:
        path = scratch_dir(spark, f"landed-{entity}")
        rows = retail.raw(spark, sf_dir, entity)
        if sum(size_of(spark, f"{sf_dir}/{t}.parquet") for t in retail.tables_of(entity)) < LARGE:
            rows = rows.hint("rebalance")  # a small table may lie in one row group, and so would the rows from it
        with shuffles_removed(spark):
            rows.write.parquet(path)
        return path

    rows = spark.read.schema(schemas.RAW[entity]).parquet(_once(spark, write, sf_dir, entity))
    return rows if batch_id is None else rows.filter(rows["_batch_id"] == batch_id)


def _land(tables: Tables, sf_dir: str, batch_id: str, *entities: str) -> None:
    """Land one batch of several entities, and declare them complete together."""
    _arrive(tables, sf_dir, batch_id, *entities)
    complete_batch(tables.spark, tables.root, batch_id, *entities)


def _arrive(tables: Tables, sf_dir: str, batch_id: str, *entities: str) -> None:
    """Put the rows of one batch into raw. Nobody takes them up before they are declared complete."""

    def land(entity: str) -> None:
        append_raw(retail.raw(tables.spark, sf_dir, entity, batch_id), tables.root, entity, complete=False)

    together(*(partial(land, entity) for entity in entities))


def calendar(spark: SparkSession, sf_dir: str) -> tuple[date, int]:
    """First day and number of days that sales fall on."""
    shipped = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_shipdate").cast("date").alias("day"))
    first, last = shipped.agg(F.min("day"), F.max("day")).first()
    return first, (last - first).days + 1


_CHANGING = ("customers", "products", "sales")


def _process(tables: Tables, sf_dir: str, batch_id: str, work: Callable[[], object]) -> None:
    """Do the ``work`` of a batch. The rows of the next one arrive meanwhile, if a caller of ``load_up_to`` waits for it."""
    waited_for = _wanted.get((tables.spark.sparkContext.applicationId, sf_dir), retail.BATCHES[:1])
    if batch_id not in waited_for[:-1]:
        work()
        return
    following = waited_for[waited_for.index(batch_id) + 1]
    together(work, lambda: _arrive(tables, sf_dir, following, *_CHANGING))
    _arrived(tables).add(following)


def load_initial(spark: SparkSession, sf_dir: str) -> Tables:
    tables = Tables(spark, scratch_dir(spark, "warehouse"))
    _land(tables, sf_dir, "INITIAL", *retail.RAW_SQL)

    def load() -> None:
        first, days = calendar(spark, sf_dir)
        run_initial_load(tables, now=retail.LOADED_AT["INITIAL"], calendar_start=first, calendar_days=days)
        refresh_daily_summary(tables, retail.LOADED_AT["INITIAL"])

    _process(tables, sf_dir, "INITIAL", load)
    return tables


def load_batch(tables: Tables, sf_dir: str, batch_id: str) -> None:
    """Land one batch in raw, unless its rows have arrived, and let the feeds pick it up."""
    now: datetime = retail.LOADED_AT[batch_id]
    if batch_id not in _arrived(tables):
        _arrive(tables, sf_dir, batch_id, *_CHANGING)
    complete_batch(tables.spark, tables.root, batch_id, *_CHANGING)

    def load() -> None:
        run_available(tables, clock=lambda: now)
        refresh_daily_summary(tables, now)

    _process(tables, sf_dir, batch_id, load)


def fail_batch(tables: Tables, batch_id: str) -> None:
    """A customer run that breaks while it reads: it must leave a FAILED event and nothing else."""
    rows = read_raw(tables.spark, tables.root, "customers", batch_id).withColumn("email", F.raise_error(F.lit("broken file")))
    try:
        process_customers(tables, rows, "planted_failure", batch_id, lambda: retail.LOADED_AT[batch_id])
    except PySparkException:
        return
    raise AssertionError("the planted failure did not fail")


def load_up_to(spark: SparkSession, sf_dir: str, batch_id: str) -> Tables:
    """The tables with the batches up to ``batch_id``, each loaded once per application, and the states between them kept."""
    wanted = _wanted[spark.sparkContext.applicationId, sf_dir] = retail.BATCHES[: retail.BATCHES.index(batch_id) + 1]
    try:
        return _load_up_to(spark, sf_dir, wanted)
    finally:
        del _wanted[spark.sparkContext.applicationId, sf_dir]


def _load_up_to(spark: SparkSession, sf_dir: str, wanted: tuple[str, ...]) -> Tables:
    batch_id = wanted[-1]
    tables = _once(spark, lambda: load_initial(spark, sf_dir), sf_dir, "all")
    loaded = _loaded(tables)
    try:
        for following in wanted[len(loaded) :]:
            if loaded[-1] not in _states(tables):
                keep_state(tables)
            load_batch(tables, sf_dir, following)
            if following == retail.BATCHES[-1]:
                fail_batch(tables, following)
            loaded.append(following)
        if batch_id != retail.BATCHES[-1] and batch_id not in _states(tables):
            keep_state(tables)  # whoever reads a state does not see what is loaded later
    except BaseException:
        _built.pop((spark.sparkContext.applicationId, sf_dir, "all"))  # whoever asks next begins anew
        raise
    return tables


class AsOf(Tables):
    """Tables as they were after one of their loads: of the merged ones a copy, of the others the partitions of the loads until then."""

    def __init__(self, now: Tables, copy: Tables, load: int):
        super().__init__(copy.spark, copy.root, copy.buckets)
        self._now, self._load = now, load

    def stored(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        if LAYOUTS[table].merged:
            return super().stored(table, buckets)
        return self._now.stored(table, buckets).filter(F.col("load") <= self._load)


def keep_state(tables: Tables) -> None:
    """Keep the tables as they are between two batches: the lake's merged tables hold the present only, so they are copied."""
    batch_id = retail.BATCHES[len(_states(tables))]
    copy = Tables(tables.spark, f"{tables.root}/as_of/{batch_id}", tables.buckets)
    load = copy.begin("copy", batch_id, in_place=True)
    merged = (table for table, layout in LAYOUTS.items() if layout.merged)
    together(*(partial(load.write, table, tables.stored(table), laid_out=True) for table in merged))
    load.commit(retail.LOADED_AT[batch_id])
    _states(tables)[batch_id] = AsOf(tables, copy, tables.last().load)


def _states(tables: Tables) -> dict[str, Tables]:
    """Earlier states of a lake, by the batch they are from."""
    return _built.setdefault(("states", tables.root), {})


def _loaded(tables: Tables) -> list[str]:
    """The batches that a lake has loaded."""
    return _built.setdefault(("loaded", tables.root), list(retail.BATCHES[:1]))


def _arrived(tables: Tables) -> set[str]:
    """The batches whose rows have arrived in raw ahead of their load."""
    return _built.setdefault(("arrived", tables.root), set())


def load_in_pieces(spark: SparkSession, sf_dir: str) -> Tables:
    """The first batch of sales lands in three appends, and the feeds run after each; it is complete with the last."""
    tables, batch_id = load_initial(spark, sf_dir), retail.BATCHES[1]
    now = retail.LOADED_AT[batch_id]
    _land(tables, sf_dir, batch_id, "customers", "products")
    rows = retail.raw(spark, sf_dir, "sales", batch_id)
    for piece in range(3):
        append_raw(rows.filter(F.pmod("_row_number", F.lit(3)) == piece), tables.root, "sales", complete=False)
        run_available(tables, clock=lambda: now)
    complete_batch(spark, tables.root, batch_id, "sales")
    run_available(tables, clock=lambda: now)
    return tables


def load_on_a_trigger(spark: SparkSession, sf_dir: str) -> Tables:
    """The first batch lands while the feed runs on a trigger: sales first, and all three become complete together."""
    tables, batch_id = load_initial(spark, sf_dir), retail.BATCHES[1]
    query = start(tables, clock=lambda: retail.LOADED_AT[batch_id], processingTime="1 second")
    try:
        for entity in ("sales", "products", "customers"):
            append_raw(landed(spark, sf_dir, entity, batch_id), tables.root, entity, complete=False)
        complete_batch(spark, tables.root, batch_id, "sales", "products", "customers")
        query.processAllAvailable()
    finally:
        query.stop()
    return tables


def built(spark: SparkSession, sf_dir: str) -> Tables:
    """The loaded tables, built once per application: reports and checks read them as they would in production."""
    return load_up_to(spark, sf_dir, retail.BATCHES[-1])


def in_pieces(spark: SparkSession, sf_dir: str) -> Tables:
    return _once(spark, lambda: load_in_pieces(spark, sf_dir), sf_dir, "pieces")


def on_a_trigger(spark: SparkSession, sf_dir: str) -> Tables:
    return _once(spark, lambda: load_on_a_trigger(spark, sf_dir), sf_dir, "trigger")


def _once(spark: SparkSession, make: Callable[[], object], *name: str):
    key = (spark.sparkContext.applicationId, *name)
    if key not in _built:
        _built[key] = make()
    return _built[key]


def use(spark: SparkSession, sf_dir: str, tables: Tables) -> None:
    """Let reports read tables already loaded with all batches."""
    _built[(spark.sparkContext.applicationId, sf_dir, "all")] = tables
    _loaded(tables)[:] = retail.BATCHES


def state(spark: SparkSession, sf_dir: str, batch_id: str = "BATCH_02") -> Tables:
    """The tables as they were after ``batch_id``; batches after it are not loaded for that."""
    tables = load_up_to(spark, sf_dir, batch_id)
    return _states(tables).get(batch_id, tables)
