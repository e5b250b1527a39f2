"""What working data leaves on the disk."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cleanse, quarantine
from ledgerline.operators.keys import as_read, in_scratch
from ledgerline.session import shuffles_removed, size_of
from tests.conftest import rows_of
from workloads import retail, warehouse
from workloads.queries import QUERIES

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture
def shop(spark, tmp_path):
    """Tables of eight sales, one of which is loaded twice."""
    folder = str(tmp_path / "shop")
    spark.sql(
        "SELECT id AS l_orderkey, 1 AS l_linenumber, id AS l_partkey, 1L AS l_suppkey, id + 1D AS l_quantity, 5000D AS l_extendedprice, 0.1D AS l_discount, "
        "'A' AS l_returnflag, 'F' AS l_linestatus, timestamp '1997-06-01' + make_interval(id) AS l_shipdate FROM range(8)"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey FROM range(8)").write.parquet(f"{folder}/orders.parquet")
    return folder


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {Path(f).name for f in found.splitlines() if "shuffle_" in f}


def scratch(spark, pattern):
    return set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).rglob(pattern))


def test_scratch_is_small_and_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = in_scratch("rows", spark.range(1000).withColumn("text", F.lit("some text")).repartition(3))
    assert not shuffle_files(spark) - before
    assert kept.count() == 1000
    group = pq.ParquetFile(kept.inputFiles()[0].removeprefix("file://")).metadata.row_group(0)
    assert {group.column(c).compression for c in range(group.num_columns)} == {"ZSTD"}


def test_the_setting_is_put_back_after_the_last_of_several_writes(spark):
    found = spark.conf.get(CLEANUP, None)
    with pytest.raises(ValueError):
        with shuffles_removed(spark):
            with shuffles_removed(spark):
                assert spark.conf.get(CLEANUP) == "true"
            assert spark.conf.get(CLEANUP) == "true"
            raise ValueError
    assert spark.conf.get(CLEANUP, None) == found


@pytest.mark.parametrize("large", [0, 1 << 40])
def test_rows_of_large_tables_are_written_as_they_come(spark, shop, monkeypatch, large):
    monkeypatch.setattr(warehouse, "LARGE", large)
    hints, real = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, name, *rest: hints.append(name) or real(df, name, *rest))
    landed = warehouse.landed(spark, shop, "sales")
    assert rows_of(landed) == rows_of(retail.raw(spark, shop, "sales")) and landed.count() == 9
    assert hints == (["rebalance"] if large else [])
    assert size_of(spark, f"{shop}/orders.parquet") > 0 and retail.tables_of("sales") == ["orders", "lineitem"]


def test_landing_files_go_once_they_are_loaded(spark, shop):
    before = scratch(spark, "*.csv*")
    loaded = QUERIES["ingest_csv_raw"](spark, shop)
    assert not {f for f in scratch(spark, "*.csv*") - before if f.is_file()}
    sales = rows_of(retail.raw(spark, shop, "sales"), "sale_id", "quantity", "unit_price")
    for source in ("plain", "gzip"):
        assert rows_of(loaded.filter(F.col("source") == source), "sale_id", "quantity", "unit_price") == sales


def test_numbered_rows_outlive_their_landing_files(spark, shop):
    before = scratch(spark, "*.csv*")
    assert rows_of(QUERIES["csv_row_numbers"](spark, shop)) == [(9, 9, True)]
    assert not {f for f in scratch(spark, "*.csv*") - before if f.is_file()}


def test_duplicates_move_only_their_text_and_stage_only_what_may_lose(spark, raw, stored):
    """Ties in the row number are decided by typed values, which are parsed from the text again."""
    same = {"_row_number": 7}
    frame = stored(raw(
        "sales", {"quantity": "9", **same}, {"quantity": "10", **same}, {"quantity": " 10 ", **same}, {"sale_id": "S2"},
        {"sale_id": " S3 ", "unit_price": "9.00", **same}, {"sale_id": "S3", "unit_price": "10", **same}, {"sale_id": "S3", "_row_number": 1}, {"sale_id": None},
    ))
    staged = {}

    def contest(name, df):
        staged[name] = stored(df)
        return staged[name]

    losers = quarantine.duplicate_sales(cleanse.clean_sales(frame), F.lit(None).cast("timestamp_ntz"), as_read, contest)
    found = losers.select("business_key", F.expr("variant_get(raw_record, '$.quantity', 'string')"), F.expr("variant_get(raw_record, '$.unit_price', 'string')"))
    assert rows_of(found) == [("S1", " 10 ", "10.00"), ("S1", "9", "10.00"), ("S3", "2", "10.00"), ("S3", "2", "9.00")]
    assert staged["contested"].columns == ["sale_id", *cleanse.META, cleanse.ORIGINAL, "_leads"]
    assert rows_of(staged["repeated_keys"], "_key", "_rows", "_tied") == [("S1", 3, 3), ("S3", 3, 2)]


def test_the_duplicates_of_what_landed_are_not_staged_whole(spark, shop):
    before = scratch(spark, "ranked-*")
    assert QUERIES["sales_batch_duplicates"](spark, shop).count() == 1
    assert scratch(spark, "ranked-*") == before
