from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline import schemas
from ledgerline.operators import silver
from ledgerline.session import with_recommended_conf

LOADED = datetime(2026, 9, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = with_recommended_conf(SparkSession.builder.master("local[4]").appName("tests"))
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = builder.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "customers": ("C1", "Ann", "ann@example.com", "1", "north", "vip", "2026-01-05 10:00:00", "2026-02-05 10:00:00"),
    "products": ("P1", "Lamp", "home", "brand", "10.00", "2026-01-01 00:00:00", "2026-01-01 00:00:00", "TRUE"),
    "stores": ("ST1", "Main", "Pune", "mh", "west", "mall", "2020-01-01"),
    "sales": ("S1", "2026-03-01 12:00:00", "C1", "P1", "ST1", "2", "10.00", "1.00", "cash"),
}


@pytest.fixture(scope="session")
def raw(spark):
    """``raw(entity, {...}, {...})``: one raw row per dict of overrides over a valid default row."""

    def make(entity: str, *rows: dict, batch: str = "INITIAL", file: str = "a.csv"):
        names = schemas.BUSINESS_COLUMNS[entity]
        data = []
        for number, overrides in enumerate(rows, start=1):
            row = dict(zip(names, DEFAULTS[entity]))
            row |= {"_source_file": file, "_loaded_at": LOADED, "_batch_id": batch, "_row_number": number}
            data.append(tuple((row | overrides)[f] for f in schemas.RAW[entity].fieldNames()))
        return spark.createDataFrame(data, schemas.RAW[entity])

    return make


@pytest.fixture(scope="session")
def stored(tmp_path_factory):
    """Write a frame and read it back, as tables are between the steps of a load."""

    def store(df):
        path = str(tmp_path_factory.mktemp("stored") / "table")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return store


def silver_of(raw, entity, existing=None):
    """Silver rows of a first load."""
    return silver.load_silver(silver.assessed(raw, entity), entity, existing)


def changes_of(pick, raw):
    """Valid changes of a batch: ``pick`` is one of the functions of ``silver`` for its entity."""
    entity = {"customer_changes": "customers", "product_changes": "products", "valid_sales": "sales"}[pick.__name__]
    return pick(silver.assessed(raw, entity, "batch"))


def rows_of(df, *columns):
    """Sorted tuples of the given columns (default: all)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
