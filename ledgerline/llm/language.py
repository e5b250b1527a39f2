"""Language identification: words first, character n-grams for words that are not known.

A known word counts with its log frequency in each language. An unknown word counts with the mean log frequency of those of its
longest n-grams that are known, falling back from four characters (word ends marked) to one. All labelled texts are counted, and
every learned word and n-gram counts: they are written tables. Only the ``WORDS`` most frequent words, and the ``GRAMS`` most
frequent n-grams of each length, are broadcast; all other words of the texts are looked up by joins.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, prepare, saved, slices, texts
from ledgerline.llm.native import fresh

#: Words and n-grams of each length that are broadcast, longest n-gram, smoothing, words a task keeps at a time.
WORDS, GRAMS, LONGEST, SMOOTHING, KEPT = 100_000, 40_000, 4, 0.5, 100_000
UNKNOWN = "und"
#: Log frequencies are multiples of 1 / GRID: their sums are exact in doubles (up to 2^21), whatever order they are added in.
GRID = 2.0**32

_runs = re.compile(r"[^\W\d_]+").findall


def words_of(text: bytes) -> list[str]:
    """Runs of word characters other than digits, lower-cased."""
    return _runs(text.decode("utf-8", "replace").lower())


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def grams_of(word: str, n: int) -> list[str]:
    """All n-grams of a word with its ends marked; single characters without the marks."""
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]
    word_logs: np.ndarray  # by word and language
    grams: list[dict[str, int]]  # by length - 1
    gram_logs: list[np.ndarray]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    word_table: DataFrame | None = None  # word, logs: all that was learned
    gram_tables: list[DataFrame] | None = None  # by length - 1
    grams_whole: bool = False  # the broadcast n-grams are all there are

    def backed_off(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log frequencies of unknown words, and which of them have a letter; without one they count for nothing."""
        letters = np.fromiter(map(has_letter, words), bool, count=len(words))
        logs = np.zeros((len(words), len(self.languages)))
        open_ = np.flatnonzero(letters)
        for n in range(LONGEST, 0, -1):
            grams = [grams_of(words[i], n) for i in open_.tolist()]
            owner = np.repeat(np.arange(len(open_)), [len(g) for g in grams])
            place = np.fromiter(map(self.grams[n - 1].get, chain.from_iterable(grams), repeat(-1)), np.int64, count=len(owner))
            owner, place = owner[place >= 0], place[place >= 0]
            known = np.bincount(owner, minlength=len(open_))
            for column in range(len(self.languages)):
                sums = np.bincount(owner, self.gram_logs[n - 1][place, column], minlength=len(open_))
                logs[open_, column] += sums / np.maximum(known, 1)
            open_ = open_[known == 0]
        return logs, letters


def held_out(key="doc_id"):
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language, added up within the task as far as memory is bounded."""
    sums: defaultdict[str, Counter] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            words = [w for w in counts if has_letter(w)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())],
                ["lang", "word", "n"],
            )

    for batch in batches:
        for part in slices(batch, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), texts(part, "text")):
                sums[lang].update(words_of(text))
            if sum(map(len, sums.values())) > KEPT:
                yield from out()
                sums.clear()
    yield from out()


def _on_grid(x):
    return F.rint(x * GRID) / GRID


def _split(words: DataFrame, n: int) -> DataFrame:
    """``words`` once for each n-gram of ``word``, as ``grams_of`` cuts them."""
    marked = F.concat(F.lit("^"), "word", F.lit("$")) if n > 1 else F.col("word")
    places = F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1)))
    cut = words.withColumn("marked", marked).withColumn("i", F.explode(places))
    return cut.withColumn("gram", F.substring("marked", F.col("i"), F.lit(n))).where(F.length("gram") == n).drop("marked", "i")


def train(docs: DataFrame, words: int = WORDS, grams: int = GRAMS) -> LanguageModel:
    """A model of all rows with a ``lang`` and an id that is not held out; null texts have no words."""
    prepare(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("lang", "text")
    counts = saved(known.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())  # as many as there are languages

    def kept(table: DataFrame, limit: int, purpose: str) -> tuple[DataFrame, dict[str, int], np.ndarray, bool]:
        size = {r.lang: (r.total, r.kinds) for r in table.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).collect()}
        logs = []
        for lang in languages:
            total, kinds = size.get(lang, (0, 0))
            own = F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0))
            logs.append(_on_grid(F.log((own + SMOOTHING) / (total + SMOOTHING * (kinds + 1)))))
        every = saved(table.groupBy("word").agg(F.sum("n").alias("n"), F.array(*logs).cast("array<double>").alias("logs")), purpose)
        top = every.orderBy(F.desc("n"), "word").limit(limit).select("word")
        head = every.join(top, "word").select("word", "logs").toArrow()  # at most limit rows
        at = {w: i for i, w in enumerate(head.column("word").to_pylist())}
        values = np.array(head.column("logs").to_pylist(), np.float64).reshape(len(at), len(languages))
        return every.select("word", "logs"), at, values, every.count() <= limit

    word_table, by_word, word_logs, _ = kept(counts, words, "word-logs")
    gram_tables, by_gram, gram_logs, whole = [], [], [], True
    for n in range(1, LONGEST + 1):
        split = _split(counts, n).groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumnRenamed("gram", "word")
        table, at, logs, fits = kept(saved(split, "grams"), grams, "gram-logs")
        gram_tables.append(table)
        by_gram.append(at)
        gram_logs.append(logs)
        whole = whole and fits
    return LanguageModel(
        languages, by_word, word_logs, by_gram, gram_logs, word_table=word_table, gram_tables=gram_tables, grams_whole=whole
    )


def _looked_up(words: DataFrame, model: LanguageModel, shared) -> DataFrame:
    """``word, logs`` of distinct words with a letter; one without any known n-gram counts for nothing and is left out."""
    met = saved(words.join(model.word_table, "word", "left"), "met")
    found, open_ = met.where("logs IS NOT NULL"), met.where("logs IS NULL").select("word")
    if model.grams_whole:

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                logs, _ = shared.value.backed_off(batch.column("word").to_pylist())
                logs = list(np.rint(logs * GRID) / GRID)
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(logs, pa.list_(pa.float64()))], ["word", "logs"])

        return found.union(open_.mapInArrow(work, "word string, logs array<double>"))
    for n in range(LONGEST, 0, -1):
        table = model.gram_tables[n - 1].withColumnRenamed("word", "gram")
        means = [_on_grid(F.sum(F.col("logs")[i]) / F.count("*")) for i in range(len(model.languages))]
        backed = saved(_split(open_, n).join(table, "gram").groupBy("word").agg(F.array(*means).alias("logs")), "backed")
        found = found.union(backed)
        open_ = saved(open_.join(backed, "word", "left_anti"), "open")
    return found


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language given all words of the text.

    ``und`` with score 0 for null texts, texts without a letter, and if nothing was learned; of equal languages the first by
    name. Only ``text`` is looked at. Columns already called so are replaced; all others and repeated rows stay.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    unknown = F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
    if not model.languages:
        return docs.select("*", *unknown)
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, word_table=None, gram_tables=None))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        totals, letters, rest, times = [], [], [], []
        for text in texts(batch, "text"):
            words = words_of(text)
            at = np.fromiter(map(own.words.get, words, repeat(-1)), np.int64, count=len(words))
            tail = Counter(w for w in map(words.__getitem__, np.flatnonzero(at < 0).tolist()) if has_letter(w))
            at = at[at >= 0]
            totals.append(own.word_logs[at].sum(axis=0))
            letters.append(bool(len(at) or tail))
            rest.append(list(tail))
            times.append(list(tail.values()))
        return pa.RecordBatch.from_arrays(
            [batch.column("_key"), pa.array(totals, pa.list_(pa.float64())), pa.array(letters, pa.bool_()),
             pa.array(rest, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
            ["_key", "total", "letters", "rest", "times"],
        )

    # equal texts have equal answers: a digest of the text names them
    own_key = fresh("_key", docs)
    docs = docs.withColumn(own_key, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    schema = "_key binary, total array<double>, letters boolean, rest array<string>, times array<long>"
    drawn = docs.select(F.col(own_key).alias("_key"), "text").mapInArrow(by_slices(work, "text"), schema).where("letters")
    drawn = saved(drawn.dropDuplicates(["_key"]), "texts")
    entries = drawn.select("_key", F.explode(F.arrays_zip("rest", "times")).alias("e")).select("_key", "e.rest", "e.times")
    entries = entries.withColumnRenamed("rest", "word")
    logs = saved(_looked_up(entries.select("word").distinct(), model, shared), "looked-up")
    places = range(len(model.languages))
    more = entries.join(logs, "word").groupBy("_key").agg(*[F.sum(F.col("times") * F.col("logs")[i]).alias(f"more{i}") for i in places])
    whole = F.array(*[F.col("total")[i] + F.coalesce(F.col(f"more{i}"), F.lit(0.0)) for i in places])
    summed = drawn.join(more, "_key", "left").select("_key", whole.alias("total")).withColumn("best", F.array_max("total"))
    first = F.array(*map(F.lit, model.languages))[F.array_position("total", F.col("best")).cast("int") - 1]
    spread = F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    answers = saved(summed.select("_key", first.alias("lang_pred"), (1 / spread).alias("score")), "answers")
    answered = docs.join(answers.withColumnRenamed("_key", own_key), own_key, "left").drop(own_key)
    return answered.withColumn("lang_pred", F.coalesce("lang_pred", unknown[0])).withColumn("score", F.coalesce("score", unknown[1]))
