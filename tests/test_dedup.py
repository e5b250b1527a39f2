from functools import reduce

from pyspark.sql import DataFrame
from tests.conftest import changes_of, rows_of, silver_of
from pyspark.sql import functions as F

from ledgerline.operators import cleanse, dedup, quarantine, silver
from ledgerline.operators.keys import assign_keys
from workloads import retail


def test_initial_keeps_older_valid_row_and_batch_drops_the_key(raw):
    frame = raw(
        "customers",
        {"updated_at": "2026-02-01 00:00:00", "segment": "old"},
        {"updated_at": "2026-03-01 00:00:00", "email": "broken"},
    )
    assert rows_of(silver_of(frame, "customers"), "customer_id", "segment") == [("C1", "OLD")]
    assert changes_of(silver.customer_changes, frame).count() == 0


def test_latest_prefers_timestamp_then_row_number(raw):
    frame = raw(
        "customers",
        {"updated_at": "2026-09-09 11:30:00", "segment": "late stamp"},
        {"updated_at": "2026-09-01 00:00:00", "segment": "late row"},
        {"customer_id": "C2", "segment": "first"},
        {"customer_id": "C2", "segment": "second"},
        {"customer_id": " ", "segment": "no id"},
    )
    assert rows_of(changes_of(silver.customer_changes, frame), "customer_id", "segment") == [("C1", "LATE STAMP"), ("C2", "SECOND")]


def test_sales_batch_keeps_last_row_of_the_file(raw):
    frame = raw(
        "sales",
        {"sale_timestamp": "2026-03-09 00:00:00", "quantity": "1"},
        {"sale_timestamp": "2026-03-01 00:00:00", "quantity": "2"},
    )
    assert rows_of(changes_of(silver.valid_sales, frame), "sale_id", "quantity") == [("S1", 2)]
    # The initial load goes by time instead.
    assert rows_of(silver_of(frame, "sales"), "quantity") == [(1,)]
    losers = quarantine.duplicate_sales(cleanse.clean_sales(frame), F.lit(None).cast("timestamp_ntz"))
    assert rows_of(losers, "business_key", "rejection_reason") == [("S1", "DUPLICATE_SALE_IN_BATCH")]


def test_load_skips_keys_already_in_silver(raw):
    existing = silver_of(raw("stores", {}), "stores")
    again = silver_of(raw("stores", {"store_name": "Renamed"}, {"store_id": "ST2"}), "stores", existing)
    assert rows_of(again, "store_id") == [("ST2",)]


def test_superseded_is_the_exact_complement_for_a_hot_key(spark):
    """A third of all rows share one id; copies included, winners plus losers are the input."""
    ids = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 500).cast("string")))
    rows = spark.range(0, 6000, 1, 7).select(
        ids.alias("sale_id"), (F.col("id") % 1500).alias("_row_number"), F.lit("f").alias("_source_file"),
        (F.col("id") % 2).alias("quantity"),
    )
    order = [F.col("_row_number").desc(), F.col("quantity").desc()]
    winners = dedup.latest(rows, "sale_id", order)
    losers = dedup.superseded(rows, "sale_id", [F.col("_row_number"), F.col("quantity")])
    assert winners.count() == rows.select("sale_id").distinct().count()
    assert winners.unionByName(losers).exceptAll(rows).count() == 0
    assert rows.exceptAll(winners.unionByName(losers)).count() == 0
    best = {r[0]: r[1] for r in rows.groupBy("sale_id").agg(F.max("_row_number")).collect()}
    assert {r["sale_id"]: r["_row_number"] for r in winners.collect()} == best


def test_superseded_works_out_the_whole_rank_for_ties_only(spark, stored):
    """Row numbers decide but for T and N; to work out the rest of another row's rank would fail."""
    rows = stored(spark.createDataFrame(
        [("A", 1, "-"), ("A", 2, "-"), ("B", 1, "-"), ("T", 5, "x"), ("T", 5, "y"), ("T", 4, "-"), ("N", None, "v"),
         ("N", None, "w"), ("N", None, "w"), ("M", None, "-"), ("M", 3, "-"), (None, 1, "-")],
        "sale_id string, _row_number long, text string",
    ))
    costly = F.when(F.col("text") == "-", F.raise_error(F.lit("not needed")).cast("string")).otherwise(F.col("text"))
    losers = dedup.superseded(rows, "sale_id", [F.col("_row_number"), costly], lambda _, df: df)
    assert rows_of(losers) == sorted([("A", 1, "-"), ("T", 5, "x"), ("T", 4, "-"), ("N", None, "v"), ("N", None, "w"), ("M", None, "-")],
                                     key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_latest_is_limited_per_task_before_the_shuffle(raw, spark):
    frame = raw("customers", {}, {})
    plan = silver_of(frame, "customers")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keys_are_dense_and_continue(spark, stored):
    rows = spark.range(0, 5000, 1, 5).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("nk"))
    first = assign_keys(rows, "sk")
    keys = sorted(r["sk"] for r in first.collect())
    assert keys == list(range(1, 5001))
    # The same written rows get the same keys whenever they are read, and however the files are cut into tasks.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    again = {r["nk"]: r["sk"] for r in first.collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert {r["nk"]: r["sk"] for r in first.collect()} == again
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    more = assign_keys(spark.createDataFrame([("A",), ("B",)], "nk string"), "sk", after=first)
    assert sorted(r["sk"] for r in more.collect()) == [5001, 5002]
    assert rows_of(assign_keys(spark.createDataFrame([("A",)], "nk string"), "sk", after=7), "sk") == [(8,)]
    assert assign_keys(rows.limit(0), "sk", after=first).count() == 0


def test_numbering_reads_its_input_once(spark):
    """The rows are evaluated when they are staged; after that only files are read, and nothing but their counts is shuffled."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(0, 1000, 1, 4).mapInPandas(count, "id long")
    keyed = assign_keys(rows, "sk")
    assert keyed.count() == 1000 and keyed.agg(F.max("sk")).first()[0] == 1000 and seen.value == 1000
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "rangepartitioning" not in plan


def test_superseded_shuffles_whole_rows_once_and_ties_from_the_contested_only(spark, stored):
    rows = stored(spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z"), ("T", 5, "x"), ("T", 5, "y"), ("T", 5, "y"), ("T", 4, "w"), (None, 1, "v")],
        "sale_id string, _row_number long, text string",
    ))
    staged = {}

    def contest(name, df):
        staged[name] = stored(df)
        return staged[name]

    losers = dedup.superseded(rows, "sale_id", [F.col("_row_number"), F.col("text")], lambda _, df: df, contest)
    assert rows_of(staged["contested"], *rows.columns) == [("A", 1, "x"), ("T", 4, "w"), ("T", 5, "x"), ("T", 5, "y"), ("T", 5, "y")]
    assert rows_of(losers) == [("A", 1, "x"), ("T", 4, "w"), ("T", 5, "x"), ("T", 5, "y")]
    assert set(losers.inputFiles()) == set(staged["contested"].inputFiles())


def test_a_landed_batch_is_written_without_a_sort(spark, tmp_path):
    folder = str(tmp_path)
    spark.sql(
        "SELECT id AS l_orderkey, 1 AS l_linenumber, 1L AS l_partkey, 1L AS l_suppkey, 3D AS l_quantity, 5000D AS l_extendedprice, 0.1D AS l_discount, "
        "'A' AS l_returnflag, 'F' AS l_linestatus, timestamp '1997-06-01' + make_interval(id) AS l_shipdate FROM range(4)"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey FROM range(4)").write.parquet(f"{folder}/orders.parquet")
    whole = retail.raw(spark, folder, "sales")
    parts = {b: retail.raw(spark, folder, "sales", b) for b in retail.BATCHES}
    assert [part.count() for part in parts.values()] == [2, 4, 2]
    assert rows_of(whole) == rows_of(reduce(DataFrame.unionByName, parts.values())) and all(p.columns == whole.columns for p in parts.values())
    for part in parts.values():
        ordered = part.orderBy("_batch_id")  # what a write partitioned by the batch asks for
        assert "Sort" not in ordered._jdf.queryExecution().optimizedPlan().toString()
