from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerline.operators.keys import in_scratch
from ledgerline.streaming.tables import LAYOUTS, Tables
from tests.conftest import rows_of


def dictionaries(folder):
    """Whether any column of the files below ``folder`` has a dictionary."""
    files = [pq.ParquetFile(f).metadata for f in Path(folder).rglob("*.parquet")]
    assert files
    return any(
        m.row_group(g).column(c).has_dictionary_page for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)
    )


def sales(spark):
    values = {"sale_id": F.concat(F.lit("S"), F.col("id").cast("string")), "quantity": F.lit(2)}
    fields = LAYOUTS["silver/sales"].schema.fields
    return spark.range(200).select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def test_only_files_that_stay_have_dictionaries(spark, tmp_path):
    tables, rows = Tables(spark, str(tmp_path / "lake"), 2), sales(spark)
    load = tables.begin("feed", "1")
    read = load.stage("rows", rows)
    load.write("silver/sales", read)
    staged = tables.staging(load.number)
    assert not dictionaries(f"{staged}/working/rows") and not dictionaries(f"{staged}/silver/sales")
    assert rows_of(read) == rows_of(load.written("silver/sales")) == rows_of(rows)
    load.commit()
    assert dictionaries(tables.path("silver/sales")) and rows_of(tables.read("silver/sales")) == rows_of(rows)
    first = Tables(spark, str(tmp_path / "first"), 2)
    load = first.begin("initial", "0", in_place=True)
    load.write("silver/sales", rows)  # written where it stays
    assert dictionaries(first.path("silver/sales"))


def test_scratch_has_no_dictionaries(spark):
    kept = in_scratch("rows", sales(spark))
    assert not dictionaries(kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
    assert rows_of(kept) == rows_of(sales(spark))
