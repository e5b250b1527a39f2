"""Benchmark decontamination with DataFrame functions only.

A window is ``WINDOW`` consecutive words of a benchmark item, or a whole shorter item. A window of L words laid anywhere on a
document covers a gram of L - s + 1 words that begins at a multiple of the stride s = L / 2, so it is enough to look up the
document's grams at those places in the set of all grams inside benchmark windows. Documents with a hit are then scanned at
every word, and their windows are compared as text.

The gram and window sets grow with the benchmark, not with the corpus; they are broadcast if Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``, or measured sizes at run time) allows it, and joined by shuffle if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import row_key, saved
from ledgerline.llm.native import keyed, let, lower_ascii, on_row, unpacked

#: Between words of lower-cased text: every ASCII character that is neither a digit nor a letter.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def words_of(text: Column) -> Column:
    """The normalised words of a text; none if it is null."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def _stride(length: int) -> int:
    return max(1, length // 2)


def _steps(first: int, last: Column, step: int) -> Column:
    """``first, first + step ..`` up to ``last``; empty if there is none."""
    return F.when(last >= first, F.sequence(F.lit(first), last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def _grams(words: Column, length: int) -> Column:
    """Hashes of the document's grams at multiples of the stride, for windows of ``length`` words."""
    step = _stride(length)
    width = length - step + 1
    return F.transform(
        _steps(1, F.size(words) - width + 1, step), lambda i: F.xxhash64(F.lit(length), F.slice(words, i, width))
    )


def _phrases(words: Column, length: int) -> Column:
    """Every run of ``length`` words with the number of its first word."""
    return F.transform(
        _steps(1, F.size(words) - length + 1, 1),
        lambda i: F.struct((i - 1).alias("at"), F.lit(length).alias("length"), F.array_join(F.slice(words, i, length), " ").alias("phrase")),
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``length, phrase, words, items``: each distinct window and the ids of the items that hold it."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("item_id IS NOT NULL AND size(words) > 0")
    runs = items.select(
        "item_id", F.least(F.size("words"), F.lit(window)).alias("length"),
        F.explode(
            let(F.col("words"), lambda w: F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w) - window + 1, F.lit(1))), lambda i: F.slice(w, i, window)))
        ).alias("words"),
    )
    return runs.groupBy("length", F.array_join("words", " ").alias("phrase")).agg(
        F.first("words").alias("words"), F.collect_set("item_id").alias("items")
    )


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which a window occurs: ``doc_id, row_key, n_hit, spans, items``.

    ``spans`` are the occurrences (number of the first word, words), ``n_hit`` counts the words inside any of them, ``items`` are
    the ids of the items concerned, sorted as strings. Null texts and items have no words; an item without an id takes no part.
    Repeated rows are returned once.
    """
    docs = docs.select("doc_id", row_key().alias("row_key"), "text")
    windows = saved(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())  # at most ``window`` numbers
    empty = docs.limit(0).select(
        "doc_id", "row_key", F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<struct<at: int, length: int>>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    if not lengths:
        return empty
    inside = None
    for length in lengths:
        step = _stride(length)
        grams = windows.where(F.col("length") == length).select(
            F.explode(F.array(*[F.xxhash64(F.lit(length), F.slice("words", o + 1, length - step + 1)) for o in range(step)])).alias("gram")
        )
        inside = grams if inside is None else inside.union(grams)
    inside = saved(inside.distinct(), "grams")
    words = words_of(F.col("text"))
    met = docs.select(
        "doc_id", "row_key", F.explode(let(words, lambda w: F.concat(*[_grams(w, n) for n in lengths]))).alias("gram")
    ).join(inside, "gram", "left_semi")
    suspects = saved(met.select("doc_id", "row_key").distinct(), "suspects")
    phrases = on_row(docs, suspects, "left_semi").select(
        "doc_id", "row_key", F.explode(let(words, lambda w: F.concat(*[_phrases(w, n) for n in lengths]))).alias("run")
    )
    found = phrases.select("doc_id", "row_key", "run.*").join(windows.select("length", "phrase", "items"), ["length", "phrase"])
    return found.groupBy("doc_id", "row_key").agg(
        F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))).cast("array<string>")).alias("items"),
    ).select(
        "doc_id", "row_key",
        F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1))))).cast("long").alias("n_hit"),
        "spans", "items",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs; all columns stay."""
    hits = benchmark_hits(docs, benchmark, window).select("doc_id", "row_key")
    return on_row(keyed(docs), hits, "left_anti").select(unpacked(docs.columns))
