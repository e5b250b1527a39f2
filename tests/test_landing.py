import gzip

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import landing, raw as raw_layer
from tests.conftest import LOADED, rows_of

HEADER = "store_id,store_name,city,state,region,store_type,opened_date\n"
AT = lambda: F.lit(LOADED).cast("timestamp_ntz")


def _write(folder, name, body, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    text = (header + body).encode()
    (folder / name).write_bytes(gzip.compress(text) if name.endswith(".gz") else text)


def _ingest(spark, path, entity="stores", **kw):
    return landing.ingest_csv(spark, str(path), entity, "INITIAL", AT(), **kw)


def test_fields_keep_their_text(spark, tmp_path):
    _write(tmp_path / "initial", "stores_initial.csv", 'ST1,"Main, ""old"" street", Pune ,,NULL,null,""\nST2,a,b,c,d,e,f\n')
    rows = _ingest(spark, tmp_path).orderBy("_row_number").collect()
    first = rows[0]
    assert (first["store_name"], first["city"], first["state"], first["region"], first["store_type"], first["opened_date"]) == (
        'Main, "old" street', " Pune ", "", None, None, "",
    )
    assert [r["_row_number"] for r in rows] == [1, 2]
    assert first["_batch_id"] == "INITIAL" and first["_loaded_at"] == LOADED
    assert first["_source_file"].endswith("initial/stores_initial.csv")


def test_plain_and_gzip_files_of_one_entity(spark, tmp_path):
    _write(tmp_path / "a", "stores_initial.csv", "ST1,a,b,c,d,e,f\n")
    _write(tmp_path / "b", "stores_initial.csv.gz", "ST2,a,b,c,d,e,f\nST3,a,b,c,d,e,f\n")
    _write(tmp_path / "b", "stores_batch_01.csv", "ST4,a,b,c,d,e,f\n")
    assert rows_of(_ingest(spark, tmp_path), "store_id", "_row_number") == [("ST1", 1), ("ST2", 1), ("ST3", 2)]
    assert landing.list_landing(spark, str(tmp_path), "*.gz").count() == 1
    assert landing.list_landing(spark, str(tmp_path)).count() == 3


@pytest.mark.parametrize("line", ["ST1,too,short\n", "ST1,a,b,c,d,e,f,too long\n"])
def test_malformed_row_stops_the_load(spark, tmp_path, line):
    _write(tmp_path / "in", "stores_initial.csv", line)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        raw_layer.append_raw(_ingest(spark, tmp_path / "in"), str(tmp_path / "out"), "stores")


def test_row_numbers_across_splits(spark, tmp_path):
    """A file read by many tasks is numbered as if read by one."""
    body = "".join(f"ST{i},name {i},c,s,r,t,2020-01-01\n" for i in range(1, 4001))
    _write(tmp_path / "x", "stores_initial.csv", body)
    _write(tmp_path / "y", "stores_initial.csv", body)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = _ingest(spark, tmp_path)
        assert rows.select(F.spark_partition_id()).distinct().count() > 3
        wrong = rows.filter(F.concat(F.lit("ST"), F.col("_row_number").cast("string")) != F.col("store_id"))
        assert (rows.count(), wrong.count()) == (8000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_raw_tables_append_and_report_loads(spark, tmp_path, raw):
    root = str(tmp_path / "lake")
    assert raw_layer.read_raw(spark, root, "stores").count() == 0
    raw_layer.append_raw(raw("stores", {}, {}), root, "stores")
    raw_layer.append_raw(raw("stores", {}, batch="BATCH_01", file="b.csv"), root, "stores")
    raw_layer.append_raw(raw("stores", {}, {}), root, "stores")  # a forced reload keeps both copies
    assert raw_layer.read_raw(spark, root, "stores").count() == 5
    one = raw_layer.read_raw(spark, root, "stores", "BATCH_01")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(_batch_id" in one._jdf.queryExecution().executedPlan().toString()
    history = raw_layer.load_history(raw_layer.read_raw(spark, root, "stores"), AT())
    assert rows_of(history, "_source_file", "_batch_id", "row_count") == [("a.csv", "INITIAL", 4), ("b.csv", "BATCH_01", 1)]
    assert raw_layer.load_history(raw_layer.read_raw(spark, root, "stores"), AT() + F.expr("INTERVAL 1 DAY")).count() == 0


def test_a_stream_loads_each_file_once(spark, tmp_path):
    """Files seen before are skipped, new ones are added, a forced load adds copies, and a repeated trigger adds nothing."""
    where, root = tmp_path / "in", str(tmp_path / "lake")

    def offer():
        landing.start_landing(spark, str(where), root, "stores", "BATCH_01", AT()).awaitTermination()
        return rows_of(raw_layer.read_raw(spark, root, "stores", "BATCH_01"), "store_id", "_row_number")

    _write(where / "a", "stores_batch_01.csv", "ST1,a,b,c,d,e,f\nST2,a,b,c,d,e,f\n")
    _write(where / "a", "stores_initial.csv", "ST9,a,b,c,d,e,f\n")  # another batch
    assert offer() == [("ST1", 1), ("ST2", 2)]
    assert offer() == [("ST1", 1), ("ST2", 2)]
    _write(where / "b", "stores_batch_01.csv.gz", "ST3,a,b,c,d,e,f\n")
    assert offer() == [("ST1", 1), ("ST2", 2), ("ST3", 1)]
    complete = spark.read.schema(raw_layer.COMPLETE).parquet(raw_layer.complete_path(root))
    assert rows_of(complete, "entity", "batch_id") == [("stores", "BATCH_01")] * 2
    forced = landing.ingest_csv(spark, str(where), "stores", "BATCH_01", AT())
    assert raw_layer.append_raw(forced, root, "stores") == 3
    assert raw_layer.read_raw(spark, root, "stores").count() == 6
    for _ in range(2):
        raw_layer.append_raw(forced, root, "stores", load="named")
    assert raw_layer.read_raw(spark, root, "stores").count() == 9


def test_seven_days_of_load_history(spark, raw):
    now = F.localtimestamp()
    rows = raw("stores", {}, {"store_id": "ST2"}, {"store_id": "ST3"})
    aged = rows.withColumn("_loaded_at", F.when(F.col("store_id") == "ST1", now - F.expr("INTERVAL 6 DAYS"))
                           .when(F.col("store_id") == "ST2", now - F.expr("INTERVAL 1 DAYS")).otherwise(now - F.expr("INTERVAL 8 DAYS")))
    history = raw_layer.load_history(aged.withColumn("_source_file", F.col("store_id"))).collect()
    assert [(r["_source_file"], r["row_count"]) for r in history] == [("ST2", 1), ("ST1", 1)]  # newest first
