"""Fill-in-middle transformation, cut by SWAR words.

A text is cut at unit ends, a unit being a run of space with the word that follows it, or the space that ends the text. The
bytes of a slice of texts are viewed as 64-bit words. Additions on all eight bytes at once mark, in the high bit of each byte,
those that end a unit and those that begin a character. Population counts per word, summed up, say how many marks lie before any
byte; the k-th mark is found by searching these sums for its word, and then, inside the word, by comparing its eight prefix sums
with what is left of k. No text is walked through, split or matched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, flat_bytes, prepare
from ledgerline.llm.native import fresh

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKER = "<[PSM]>"
_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def as_words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, followed by at least one byte of padding."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def _at_least(low: np.ndarray, value: int) -> np.ndarray:
    """High bits of the bytes of ``low`` (each below 128) that are ``value`` or more; no byte carries into the next."""
    return low + _ONES * np.uint64(128 - value)


def spaces(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes 0x20 and 0x09 to 0x0D."""
    low = words & ~_HIGH
    control = _at_least(low, 0x09) & ~_at_least(low, 0x0E)
    blank = _at_least(low, 0x20) & ~_at_least(low, 0x21)
    return (control | blank) & ~words & _HIGH


def characters(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes that begin a character: all but 10xxxxxx."""
    return (~words | (words << np.uint64(1))) & _HIGH


def unit_ends(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marks of the last byte of every unit, for texts that lie between ``bounds``."""
    space = spaces(words)
    after = np.append(space[1:], np.uint64(0))
    ends = ~space & ((space >> np.uint64(8)) | (after << np.uint64(56))) & _HIGH
    last = bounds[1:][np.diff(bounds) > 0] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << (8 * (last & 7)).astype(np.uint64))
    return ends


class Marks:
    """Rank and select over marks in the high bits of bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marks lie before byte ``at``."""
        word, bits = at >> 3, (8 * (at & 7)).astype(np.uint64)
        inside = np.bitwise_count(self.marks[word] & ~(_FULL << bits)).astype(np.int64)
        return np.where(word > 0, self.upto[word - 1], 0) + inside

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte that holds the ``k``-th mark, counted from 1."""
        word = np.searchsorted(self.upto, k, side="left")
        left = (k - np.where(word > 0, self.upto[word - 1], 0)).astype(np.uint64)
        sums = (self.marks[word] >> np.uint64(7)) * _ONES
        reached = ((sums | _HIGH) - left * _ONES) & _HIGH
        return 8 * word + 8 - np.bitwise_count(reached)


def _cut(bounds: np.ndarray, ends: Marks, draws: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of units of each text, and the bytes at which its prefix and its middle end."""
    before = ends.rank(bounds)
    n = np.diff(before)
    points = np.sort(np.stack([draw % (n + 1) for draw in draws]), axis=0)
    cut = [np.where(k > 0, ends.select(np.maximum(before[:-1] + k, 1)) + 1, bounds[:-1]) if len(ends.marks) and before[-1] else bounds[:-1]
           for k in points]
    return n, cut[0], cut[1]


def _draw(key: Column, group: int) -> Column:
    return F.conv(F.substring(key, 8 * group + 1, 8), 16, 10).cast("long")


def infilled(
    docs: DataFrame, into: str = "infill", transformed: int = 50, suffix_first: int = 80, seed: int = 42, key: str = "doc_id"
) -> DataFrame:
    """``docs`` with a struct ``n, form, prefix_chars, middle_chars, output`` made from each whole ``text``.

    Of a hundred texts about ``transformed`` are cut in three at unit ends and reordered, and ``suffix_first`` of a hundred of those
    begin with the suffix (``spm``), the others with the prefix (``psm``). Everything follows from a digest of ``seed`` and the id, so
    a repeated task gives the same result, and repeated rows of an id with the same text are treated alike. ``plain`` texts, without
    a cut, are those not drawn, empty ones (a null text is empty) and those that hold a marker, which could not be read back; their
    lengths are null. A null id is drawn like an empty one. A column called ``into`` is replaced, all others stay. Rows keep their
    partitions: there is no shuffle, and an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    docs = docs.drop(into)
    text, digest = fresh("text_", docs), fresh("digest", docs)
    drawn = [fresh(f"draw{i}", docs) for i in range(4)]
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    rows = docs.withColumn(text, F.col("text").cast("string")).withColumn(digest, name)
    rows = rows.withColumns({d: _draw(F.col(digest), i) for i, d in enumerate(drawn)}).drop(digest)
    fields = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = pc.fill_null(batch.column(text), "")
        h1, h2, h3, h4 = (batch.column(d).to_numpy() for d in drawn)
        data, bounds = flat_bytes(column)
        words = as_words(data)
        n, first, second = _cut(bounds, Marks(unit_ends(words, bounds)), [h1, h2])
        begins = Marks(characters(words))
        chars = begins.rank(np.stack([bounds[:-1], first, second]))
        marked = pc.match_substring_regex(column, _MARKER).to_numpy(zero_copy_only=False)
        plain = (n == 0) | marked | (h3 % 100 >= transformed)
        form = np.where(plain, "plain", np.where(h4 % 100 < suffix_first, "spm", "psm"))
        whole = data.tobytes()
        output = []
        for kind, a, b, c, d in zip(form.tolist(), bounds[:-1].tolist(), first.tolist(), second.tolist(), bounds[1:].tolist()):
            start, middle, end = whole[a:b], whole[b:c], whole[c:d]
            if kind == "spm":
                output.append(b"<S>%b<P>%b<M>%b" % (end, start, middle))
            else:
                output.append(b"<P>%b<S>%b<M>%b" % (start, end, middle) if kind == "psm" else whole[a:d])
        made = pa.StructArray.from_arrays(
            [pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(chars[1] - chars[0], mask=plain),
             pa.array(chars[2] - chars[1], mask=plain), pa.array(output, pa.binary()).cast(pa.string())], fields=list(fields),
        )
        kept = [c for c in batch.schema.names if c not in (text, *drawn)]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], made], [*kept, into])

    schema = ", ".join(
        [f"`{c}` {t}" for c, t in docs.dtypes]
        + [f"`{into}` struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>"]
    )
    return rows.mapInArrow(by_slices(work, text), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that gave ``output``. Its three parts hold no marker, nor can one arise where a part meets a marker."""
    parts = F.split(output, _MARKER, -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
    )
