"""A corpus pipeline over ``documents``: each stage applies one operator of ``ledgerline.llm`` to all its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``, works on whole texts and all rows, and returns the columns of ``documents``; the last
one adds the token ids. Null texts count as empty; rows without an id pass where nothing is known of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import quality
from ledgerline.llm.common import read, row_key, saved
from ledgerline.llm.decontaminate import without_contaminated
from ledgerline.llm.minhash import groups
from ledgerline.llm.native import fresh
from ledgerline.llm.pieces import encode_texts
from ledgerline.llm.queries import tokenizer_file
from ledgerline.llm.secrets import redacted


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    score = fresh("_score", docs)
    return quality.scored(docs, model, score).where(quality.accepted(score)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    If an id comes with several texts, each is a document of its own, and of those in one group one stays. Rows that repeat an id
    and its text are one document. Rows without an id and texts without words stay.
    """
    key = fresh("_row_key", docs)
    rows = saved(groups(docs, k=5, percent=80).where("component IS NOT NULL").select("doc_id", "row_key", "component"), "groups")
    place = F.struct("doc_id", "row_key")
    several = rows.groupBy("component").agg(F.min(place).alias("one"), F.count("*").alias("n")).where("n > 1").drop("n")
    several = rows.join(saved(several, "several"), "component").groupBy("doc_id", "row_key").agg(
        F.bool_or(place == F.col("one")).alias("stays"), F.count("*").alias("n")
    )
    several = saved(several.where("n > 1 OR NOT stays").withColumnRenamed("row_key", key), "leaving")  # mostly rows that go
    keyed = docs.withColumn(key, row_key())
    again = keyed.join(several.where("stays"), ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    return keyed.join(several, ["doc_id", key], "left_anti").unionByName(again).select(docs.columns)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark; ``n_chars`` follows the text."""
    return redacted(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, and as text what the ids decode to."""
    decoded = fresh("_decoded", docs)
    coded = encode_texts(docs, tokenizer_file("piece_bpe_32k.model"), decoded=decoded)
    return coded.withColumn("text", F.col(decoded)).drop(decoded).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", good_quality),
    ("near_dedup", one_of_each_group),
    ("decontamination", no_benchmark),
    ("secrets", no_secrets),
    ("sentencepiece", tokens),
]

#: Trained weights, probabilistic buckets and tokenizer merges have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each stage's result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
