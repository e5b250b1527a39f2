"""Rows that meet under a hash, found with one shuffle of packed arrays.

A task gathers a bounded number of entries (hash, document, place). What meets among them is settled at once, and of each hash
only the entries of one document go on to the other tasks, so a hash that very many documents share weighs no more in the
shuffle than any other. Entries are dealt by hash into groups of about ``DEALT``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices

#: Entries that a task gathers before it deals them out, entries meant for one group of the shuffle, settled entries in a row.
GATHERED, DEALT, SETTLED = 1 << 20, 1 << 18, 1 << 13


def _packed(bucket, first, second, doc, place) -> dict:
    return {"bucket": bucket, "h1": first.tobytes(), "h2": second.tobytes(), "doc": doc.tobytes(), "place": place.tobytes()}


_PACKED = pa.schema([("bucket", pa.int32()), ("h1", pa.binary()), ("h2", pa.binary()), ("doc", pa.binary()), ("place", pa.binary())])
_PACKED_DDL = "bucket int, h1 binary, h2 binary, doc binary, place binary"


def _groups(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by hash, begin of each group in that order, group of each place in that order."""
    order = np.lexsort((second, first)) if len(second) else np.argsort(first, kind="stable")
    a = first[order]
    new = np.append(True, a[1:] != a[:-1])
    if len(second):
        b = second[order]
        new[1:] |= b[1:] != b[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _settle(first, second, doc, earliest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are settled as repeated here, and which must be seen by the other tasks.

    ``earliest``: repeated is what also occurs under a smaller id; else: what occurs under another id.
    """
    order, begins, group = _groups(first, second)
    ordered = doc[order]
    low = np.minimum.reduceat(ordered, begins)[group]
    settled, onward = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    onward[order] = ordered == low
    if earliest:
        settled[order] = ordered > low
    else:
        high = np.maximum.reduceat(ordered, begins)[group]
        settled[order] = low < high
    return settled, onward


def _deal(buckets: int, wide: bool, earliest: bool, entries: Callable, text: str | None, keyed: bool = False) -> Callable:
    """Gather entries of bounded number, settle what can be settled, deal out the rest by hash."""

    def flush(parts: list) -> Iterator[pa.RecordBatch]:
        first, second, doc, place = (np.concatenate(x) for x in zip(*parts))
        if not len(first):
            return
        settled, onward = _settle(first, second, doc, earliest)
        rows = []
        at = np.flatnonzero(settled)
        for some in np.array_split(at, len(at) // SETTLED + 1):
            if len(some):
                spread = buckets + int(first[some[0]] % np.uint64(buckets))  # any group will do
                rows.append(_packed(spread, first[some] if keyed else first[:0], second[:0], doc[some], place[some]))
        place = np.where(settled, ~place, place)  # known to meet: shown to the others, not returned again
        at = np.flatnonzero(onward)
        bucket = (first[at] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at, bucket = at[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rest = first // np.uint64(buckets)
        rest = rest if wide else (rest & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        for b in np.flatnonzero(np.diff(cuts)):
            own = at[cuts[b] : cuts[b + 1]]
            rows.append(_packed(int(b), rest[own], second[own] if len(second) else second, doc[own], place[own]))
        yield from pa.Table.from_pylist(rows, _PACKED).to_batches(max_chunksize=1024)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for part in slices(batch, text) if text else [batch]:
                for entry in entries(part):
                    parts.append(entry)
                    size += len(entry[0])
                    if size >= GATHERED:
                        yield from flush(parts)
                        parts, size = [], 0
        if parts:
            yield from flush(parts)

    return run


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(v, kind) for v in table.column(name).to_pylist()])


def _met(buckets: int, wide: bool, earliest: bool, bucket: int, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and place of the entries of one group that meet others."""
    first = _joined(table, "h1", np.uint64 if wide or bucket >= buckets else np.uint32)
    doc, place = _joined(table, "doc", np.int64), _joined(table, "place", np.int32)
    if bucket >= buckets:  # settled before
        return first, doc, place
    settled, _ = _settle(first, _joined(table, "h2", np.uint32), doc, earliest)
    settled &= place >= 0
    first = first.astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
    return first[settled], doc[settled], place[settled]


def _places(buckets: int, wide: bool, earliest: bool) -> Callable:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, doc, place = _met(buckets, wide, earliest, key[0].as_py(), table)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "place": pa.array(place, pa.int32())})

    return run


def _keys(buckets: int) -> Callable:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        first, doc, _ = _met(buckets, True, False, key[0].as_py(), table)
        return pa.table({"key": pa.array(first.view(np.int64)), "doc_id": pa.array(doc, pa.int64())})

    return run


def places_by_document(df: DataFrame, buckets: int, wide: bool, earliest: bool, text: str, entries: Callable) -> DataFrame:
    """``doc_id, places`` of all entries that meet another document's.

    ``entries`` maps an Arrow batch, cut by the size of ``text``, to arrays (first hash, second hash or empty, document, place).
    """
    dealt = df.mapInArrow(_deal(buckets, wide, earliest, entries, text), _PACKED_DDL)
    met = dealt.groupBy("bucket").applyInArrow(_places(buckets, wide, earliest), "doc_id long, place int")
    return met.groupBy("doc_id").agg(F.collect_list("place").alias("places"))


def meeting_keys(df: DataFrame, buckets: int, entries: Callable) -> DataFrame:
    """``key, doc_id`` wherever a 64-bit key belongs to several documents."""
    dealt = df.mapInArrow(_deal(buckets, True, False, entries, None, keyed=True), _PACKED_DDL)
    return dealt.groupBy("bucket").applyInArrow(_keys(buckets), "key long, doc_id long")


def groups_for(df: DataFrame, entries: int) -> int:
    return max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), entries // DEALT + 1)
