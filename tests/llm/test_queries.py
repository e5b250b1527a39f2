"""Registered queries against their SQL on the smallest tables, and the stages of the pipeline."""

import os
import re

import duckdb
import pytest

import corpus_pipeline
from ledgerline.llm.queries import ORACLE, QUERIES, tokenizer_file
from tests.llm.test_secrets import base

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"op7_sharding"}))
def test_query_matches_its_statement(spark, name):
    found = QUERIES[name](spark, SF)
    names = sorted(found.columns)
    with duckdb.connect() as db:
        for table in ("documents", "embeddings", "benchmark", "labels", "conversations"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        expected = db.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(*names).collect()))) == sorted(map(str, expected)) and expected


def test_stages_keep_columns_and_do_their_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.saved(stage(spark, before, SF), "test")
        assert after.select(columns).columns == columns
        if name != "sentencepiece":
            assert after.columns == columns
        kept, had = ({r.doc_id: r for r in d.collect()} for d in (after, before))
        assert set(kept) <= set(had) and len(kept) == after.count()
        if name in ("secrets", "sentencepiece"):
            assert set(kept) == set(had)
        if name == "sentencepiece":
            model = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
            assert all(list(r.ids) == model.encode(had[i].text or "") and r.text == (had[i].text or "") for i, r in kept.items())
        elif name == "secrets":
            assert all(r.n_chars == len(r.text) for r in kept.values())
            assert all(("[SECRET]" in kept[i].text) == bool(base(r.text)) for i, r in had.items())
        before = after


def test_stages_take_odd_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "some plain words of a text", "en", "s", 26), (-5, None, "en", "s", 0), (-6, "", None, None, None),
         (-7, "a repeated row with password=hunter22 in it", "en", "s", 43), (-7, "a repeated row with password=hunter22 in it", "en", "s", 43)],
        docs.schema,
    )
    for table in (docs.limit(0), odd, docs.limit(30).union(odd)):
        before = table
        for name, stage in corpus_pipeline.STAGES:
            before = corpus_pipeline.saved(stage(spark, before, SF), "odd")
            assert before.columns[: len(docs.columns)] == docs.columns
        assert before.count() <= table.count()
        assert not before.where("text LIKE '%hunter22%'").count()
