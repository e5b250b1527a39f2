"""Removal of passages that repeat across documents, found by difference-cover anchors.

Only positions whose number modulo a period lies in a difference cover are anchors. For any two places there is a shift below
the period that takes both to an anchor, so two documents that share a whole window share an aligned anchor inside it. An
anchor is the hash of the words that are certain to lie in the window. Anchors met in two documents are extended to all
windows that hold them, and a window counts as repeated if its 96-bit hash occurs in a document with a smaller id.

Both steps find what meets under a hash as ``meeting`` describes, so a passage that very many documents share stays small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, prepare, row_key, saved, texts
from ledgerline.llm.meeting import groups_for, places_by_document
from ledgerline.llm.native import keyed, on_row, unpacked
from ledgerline.llm.shingles import WordHashes, mix

#: Perfect difference sets, by period.
COVERS = {1: (0,), 7: (1, 2, 4), 13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27)}
_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_words = WordHashes()


class Windows:
    """Hashes of any windows of a word sequence, from running sums in the ring of 64-bit numbers."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.append(np.uint64(1), np.full(n, self.base, np.uint64)), dtype=np.uint64)
            self.down = np.cumprod(np.append(np.uint64(1), np.full(n, self.inverse, np.uint64)), dtype=np.uint64)

    def of(self, words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
        self._powers(len(words) + 1)
        sums = np.append(np.uint64(0), np.cumsum(words * self.down[: len(words)], dtype=np.uint64))
        return mix((sums[starts + width] - sums[starts]) * self.up[starts])


_ROLLING = tuple(Windows(b) for b in _BASES)


def cover_of(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor width for a window: the longest period that leaves an anchor of a third of the window."""
    period = max(p for p in COVERS if p == 1 or 3 * (window - p + 1) >= window)
    return period, COVERS[period], window - period + 1


def word_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, n_words, words_sha256, f1, f2`` of each row; words are split at ASCII white space, unchanged.

    ``words_sha256`` is the digest of all words joined by one space, ``f1, f2`` a fingerprint of the same.
    """
    prepare(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        split = [text.split() for text in texts(batch, "text")]
        plain = [b" ".join(words) for words in split]
        marks = [np.frombuffer(xxhash.xxh3_128_digest(p), np.int64) for p in plain]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array([len(w) for w in split], pa.int64()),
             pa.array([hashlib.sha256(p).hexdigest() for p in plain]), pa.array([m[0] for m in marks], pa.int64()),
             pa.array([m[1] for m in marks], pa.int64())],
            ["doc_id", "row_key", "n_words", "words_sha256", "f1", "f2"],
        )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), "text")
    return keyed.mapInArrow(
        by_slices(work, "text"), "doc_id long, row_key long, n_words long, words_sha256 string, f1 long, f2 long"
    )


def _anchors(window: int) -> Callable:
    period, cover, width = cover_of(window)
    cover = np.array(cover)

    def entries(part: pa.RecordBatch):
        for doc, text, shift in zip(part.column("doc_id").to_pylist(), texts(part, "text"), part.column("shift").to_pylist()):
            words = text.split()
            if len(words) >= window:
                starts = (np.arange(0, len(words), period)[:, None] + cover).ravel()
                starts = starts[starts + width <= len(words)]
                hashes = _ROLLING[0].of(_words.of(words), starts, width)
                yield hashes, np.empty(0, np.uint32), np.full(len(starts), doc, np.int64), (starts + shift).astype(np.int32)

    return entries


def _extended(window: int) -> Callable:
    reach = window - cover_of(window)[2]

    def entries(part: pa.RecordBatch):
        columns = part.column("doc_id").to_pylist(), texts(part, "text"), part.column("places"), part.column("shift").to_pylist()
        for doc, text, places, shift in zip(*columns):
            words = text.split()
            held = np.zeros(len(words) + 2, np.int32)
            places = places.values.to_numpy()
            np.add.at(held, np.maximum(places - reach, 0), 1)
            np.add.at(held, places + 1, -1)
            starts = np.flatnonzero(np.cumsum(held)[: max(0, len(words) - window + 1)] > 0)
            if len(starts):
                hashes = _words.of(words)
                second = (_ROLLING[1].of(mix(hashes), starts, window) >> np.uint64(32)).astype(np.uint32)
                yield _ROLLING[0].of(hashes, starts, window), second, np.full(len(starts), doc, np.int64), (starts + shift).astype(np.int32)

    return entries


def _cleaned(window: int) -> Callable:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, spans, kept_texts = [], [], []
        for text, places in zip(texts(batch, "text"), batch.column("places")):
            words = text.split()
            edges = np.zeros(len(words) + 1, np.int64)
            starts = places.values.to_numpy()
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + window, -1)
            gone = np.cumsum(edges)[:-1] > 0
            turns = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
            counts.append(int(gone.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
            kept_texts.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode("utf-8", "replace"))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(kept_texts)],
            ["doc_id", "row_key", "n_removed", "removed", "text"],
        )

    return work


def repeated_passages(docs: DataFrame, counts: DataFrame, window: int = 50) -> DataFrame:
    """The documents that lose words: ``doc_id, row_key, n_removed, removed, text``.

    A word goes if it is covered by a window of ``window`` consecutive words of its document that also starts in a document
    with a smaller ``doc_id``; windows are judged on the input. ``removed`` lists spans of word numbers (end exclusive), ``text``
    the kept words joined by one space. ``counts`` is ``word_counts(docs)``, written. Documents not returned keep all words.

    Null and blank texts have no words. Rows without an id take no part. All texts of an id take part, as texts of one document:
    their places are counted on, in the order of their keys (fewer than 2^31 words of one id); repeated rows are returned once.
    An empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), "text")
    long_enough = counts.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    # an exact copy of a whole document loses all its words; the first of the copies stands for them
    # (written, so that the join has shuffles of its own, whose hot keys Spark can split)
    firsts = saved(long_enough.groupBy("f1", "f2").agg(F.min("doc_id").alias("first")), "firsts")
    copies = saved(
        long_enough.join(firsts, ["f1", "f2"]).where("doc_id > first").select("doc_id", "row_key", "n_words").distinct(), "copies"
    )
    before = F.sum("n_words").over(W.partitionBy("doc_id").orderBy("row_key").rowsBetween(W.unboundedPreceding, -1))
    each = long_enough.groupBy("doc_id", "row_key").agg(F.max("n_words").alias("n_words"))
    each = saved(each.withColumn("shift", F.coalesce(before, F.lit(0))), "shifts")
    # only further texts of an id are shifted: mostly none, so the documents need not be shuffled for it
    shifted = saved(each.where("shift > 0").select("doc_id", "row_key", "shift"), "shifted")
    own = docs.where("doc_id IS NOT NULL").join(shifted, ["doc_id", "row_key"], "left").select(
        "doc_id", "row_key", "text", F.coalesce("shift", F.lit(0)).alias("shift")
    )

    def in_own_text(places: DataFrame, texts_: DataFrame) -> DataFrame:
        """Places of an id as places in each of its texts."""
        inside = F.filter("places", lambda p: (p >= F.col("shift")) & (p < F.col("shift") + F.col("n_words")))
        here = F.transform(inside, lambda p: (p - F.col("shift")).cast("int"))
        return places.join(texts_, "doc_id").withColumn("places", here).where(F.size("places") > 0)

    period, cover, _ = cover_of(window)
    words = long_enough.agg(F.sum("n_words")).first()[0] or 0
    candidates = in_own_text(
        places_by_document(
            own.select("doc_id", "text", "shift"), groups_for(docs, words * len(cover) // period),
            wide=False, earliest=False, text="text", entries=_anchors(window),
        ), each,
    ).join(copies, ["doc_id", "row_key"], "left_anti")
    involved = saved(docs.join(candidates, ["doc_id", "row_key"]).dropDuplicates(["doc_id", "row_key"]), "involved")
    windows = involved.agg(F.sum(F.size("places").cast("long"))).first()[0] or 0
    removed = in_own_text(
        places_by_document(
            involved.select("doc_id", "text", "places", "shift"), groups_for(docs, windows * 5), wide=True, earliest=True, text="text",
            entries=_extended(window),
        ), involved.select("doc_id", "row_key", "n_words", "shift"),
    ).select("doc_id", "row_key", "places")
    changed = (
        involved.select("doc_id", "row_key", "text").join(removed, ["doc_id", "row_key"])
        .mapInArrow(by_slices(_cleaned(window), "text"),
                    "doc_id long, row_key long, n_removed long, removed array<struct<start: int, end: int>>, text string")
    )
    whole = copies.select(
        "doc_id", "row_key", F.col("n_words").alias("n_removed"),
        F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).alias("removed"), F.lit("").alias("text"),
    )
    return changed.union(whole)


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with the kept words of changed documents as their ``text``; all other rows and columns stay as they are."""
    changed = repeated_passages(docs, saved(word_counts(docs), "words"), window).select("doc_id", "row_key", F.col("text").alias("kept"))
    return on_row(keyed(docs), changed).select(unpacked(docs.columns, text=F.coalesce(F.col("kept"), F.col("row.text"))))
