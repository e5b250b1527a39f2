"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard on full sets, components.

Two permutations make a whole signature. The first scatters a shingle over the 32-bit ring; the second is shifted around
the ring by one step per coordinate, and a coordinate is the smallest value it takes on the set. ``BANDS`` bands of ``ROWS``
coordinates meet in buckets; at the similarity of 0.8 a pair misses all of them with a probability of 5e-7.

A bucket is never expanded into its pairs. Its hub, the member that meets most others in all its buckets, is compared with
each member on full sets. What the hub does not settle is finished by symmetric differences: if Dx is what sets x and h do
not share, then |x ^ y| = |Dx ^ Dy|, so all members of one hub that are still in different components are compared exactly,
tile by tile, and only links leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, prepare, row_key, saved, texts
from ledgerline.llm.components import connected_components
from ledgerline.llm.meeting import groups_for, meeting_keys
from ledgerline.llm.shingles import WordHashes, mix, shingle_set
from ledgerline.operators.keys import assign_keys

ROWS, BANDS = 6, 48
#: Members of one hub that meet in one task.
TILE = 512

_SHIFTS = np.arange(ROWS * BANDS, dtype=np.uint32)[:, None]
_WEIGHTS = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_BAND = mix(np.arange(101, 101 + BANDS, dtype=np.uint64))
_U16, _U15, _U32 = np.uint32(16), np.uint32(15), np.uint64(32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of one set, in blocks of the set that stay in the processor's cache."""
    least = np.full(ROWS * BANDS, 0xFFFFFFFF, np.uint32)
    ring = (mix(shingles) >> _U32).astype(np.uint32)  # the first permutation
    for start in range(0, len(ring), 512):
        x = ring[None, start : start + 512] + _SHIFTS  # the circular shift, one step per coordinate
        x ^= x >> _U16  # the second permutation
        x *= np.uint32(0x7FEB352D)
        x ^= x >> _U15
        x *= np.uint32(0x846CA68B)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_hashes(coordinates: np.ndarray) -> np.ndarray:
    folded = (coordinates.astype(np.uint64).reshape(BANDS, ROWS) * _WEIGHTS).sum(axis=1, dtype=np.uint64)
    return mix(folded + _BAND)


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z only, and white space is \x20 and \x09-\x0D


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, row_key, n_shingles, f1, f2, bands``: set size, 128-bit fingerprint of the set, hash of each band (none if empty)."""
    hashes = WordHashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, marks, bands = [], [], []
        for text in texts(batch, "text"):
            shingles = shingle_set(hashes.of(_words(text)), k)
            sizes.append(len(shingles))
            marks.append(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64))
            bands.append(band_hashes(signature(shingles)) if len(shingles) else np.empty(0, np.uint64))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
             pa.array([m[1] for m in marks], pa.int64()), _lists(bands)],
            ["doc_id", "row_key", "n_shingles", "f1", "f2", "bands"],
        )

    schema = "doc_id long, row_key long, n_shingles long, f1 long, f2 long, bands array<long>"
    return docs.select("doc_id", "row_key", "text").mapInArrow(by_slices(work, "text"), schema)


def _full_sets(docs: DataFrame, k: int) -> DataFrame:
    hashes = WordHashes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(hashes.of(_words(text)), k) for text in texts(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(sets)], ["doc_id", "shingles"])

    return docs.mapInArrow(by_slices(work, "text"), "doc_id long, shingles array<long>")


def _views(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as unsigned arrays, without copies."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy().view(np.uint64)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What hub and member do not share, in full."""
    for batch in batches:
        found = [
            np.setxor1d(a, b, assume_unique=True)
            for a, b in zip(_views(batch.column("hub_set")), _views(batch.column("member_set")))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in ("hub", "member", "n_hub", "n_member")] + [_lists(found)],
            ["hub", "member", "n_hub", "n_member", "apart"],
        )


def _similar(n_a, n_b, apart, percent: int):
    """100 |a & b| >= percent |a | b|, from the sizes of both sets and of what they do not share."""
    return 100 * (n_a + n_b - apart) >= percent * (n_a + n_b + apart)


def _tile_links(percent: int):
    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        first, second = table.column("first").to_numpy(), table.column("second").to_numpy()
        member, group = table.column("member").to_numpy(), table.column("component").to_numpy()
        size = table.column("n_member").to_numpy()
        column = table.column("apart")
        lists = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        ends = lists.offsets.to_numpy().astype(np.int64)
        values, ids = np.unique(lists.values.to_numpy()[ends[0] : ends[-1]], return_inverse=True)
        ends = ends - ends[0]
        count = np.diff(ends)
        names, at, often = np.unique(group, return_inverse=True, return_counts=True)
        minor = at != often.argmax()  # two members of the largest component need no look
        marks = np.zeros(len(values) + 1, np.int64)
        us, vs = [], []
        for x in np.flatnonzero(minor):  # of both sides: the other side may be in the largest component
            other = (second & first[x]) | (first & second[x])
            other &= (group != group[x]) & ~(minor & (np.arange(len(member)) < x))  # those have met x already
            other &= _similar(size[x], size, np.abs(count - count[x]), percent)  # the least they can be apart
            ys = np.flatnonzero(other)
            if not len(ys):
                continue
            marks[ids[ends[x] : ends[x + 1]]] = 1
            spans = count[ys]
            starts = np.cumsum(spans) - spans
            flat = np.repeat(ends[ys] - starts, spans) + np.arange(int(spans.sum()))
            totals = np.concatenate(([0], np.cumsum(marks[ids[flat]])))
            shared = totals[starts + spans] - totals[starts]
            marks[ids[ends[x] : ends[x + 1]]] = 0
            hit = ys[_similar(size[x], size[ys], count[x] + count[ys] - 2 * shared, percent)]
            us.append(np.full(len(hit), member[x]))
            vs.append(member[hit])
        none = [np.empty(0, np.int64)]
        return pa.table({"u": np.concatenate(us or none), "v": np.concatenate(vs or none)})

    return work


def _open_links(known: DataFrame, percent: int) -> DataFrame:
    """Links between members of one hub that are in different components, from what hub and member do not share."""
    open_hubs = saved(
        known.groupBy("hub").agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
        .where("a <> b").select("hub", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")),
        "open",
    )
    spread = known.join(open_hubs, "hub").withColumn("tile", F.pmod(F.xxhash64("member"), F.col("tiles")).cast("int"))
    # a member of tile t meets tiles t..last as first side and tiles 0..t as second side
    each = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    each = each.select(
        "hub", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        (F.col("tile") <= F.col("other")).alias("first"), (F.col("tile") >= F.col("other")).alias("second"),
        "member", "component", "n_member", "apart",
    )
    return each.groupBy("hub", "low", "high").applyInArrow(_tile_links(percent), "u long, v long")


def _band_entries(batch: pa.RecordBatch):
    bands = batch.column("bands").values.to_numpy().view(np.uint64)  # every representative has all bands
    offsets = batch.column("bands").offsets.to_numpy()
    doc = np.repeat(batch.column("doc_id").to_numpy(), BANDS)
    yield bands[offsets[0] : offsets[-1]], np.empty(0, np.uint32), doc, np.zeros(len(doc), np.int32)


def _links(docs: DataFrame, nodes: DataFrame, reps: DataFrame, buckets: int, k: int, percent: int) -> DataFrame | None:
    """Links between classes that decide all components."""
    members = saved(meeting_keys(reps.select("doc_id", "bands"), buckets, _band_entries).withColumnRenamed("key", "band"), "buckets")
    sizes = members.groupBy("band").agg(F.count("*").alias("n"))
    members = members.join(sizes, "band")
    weight = members.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    hubs = members.join(weight, "doc_id").groupBy("band").agg(F.max(F.struct("weight", -F.col("doc_id"))).alias("top"))
    stars = saved(
        members.select("band", "doc_id").join(hubs.select("band", (-F.col("top.col2")).alias("hub")), "band")
        .where("doc_id <> hub").select("hub", F.col("doc_id").alias("member")).distinct(),
        "stars",
    )
    if stars.isEmpty():
        return None
    involved = stars.select(F.col("hub").alias("node")).union(stars.select("member")).distinct().join(nodes, "node")
    involved = involved.select("node", F.col("rep").alias("doc_id"), F.col("rep_key").alias("row_key"))
    found = _full_sets(docs.join(involved.hint("merge"), ["doc_id", "row_key"]).select(F.col("node").alias("doc_id"), "text"), k)
    sets = saved(found.groupBy("doc_id").agg(F.min("shingles").alias("shingles")), "sets")
    size = F.size("shingles").cast("long")
    compared = saved(
        stars.hint("merge")
        .join(sets.select(F.col("doc_id").alias("member"), F.col("shingles").alias("member_set"), size.alias("n_member")), "member")
        .hint("merge")
        .join(sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("hub_set"), size.alias("n_hub")), "hub")
        .select("hub", "member", "n_hub", "n_member", "hub_set", "member_set")
        .mapInArrow(_differences, "hub long, member long, n_hub long, n_member long, apart array<long>"),
        "compared",
    )
    near = _similar(F.col("n_hub"), F.col("n_member"), F.size("apart"), percent)
    links = compared.where(near).select(F.col("hub").alias("u"), F.col("member").alias("v"))
    first = saved(connected_components(links), "components")

    known = compared.join(first.withColumnRenamed("node", "member"), "member", "left").withColumn(
        "component", F.coalesce("component", "member")
    )
    more = _open_links(known, percent)
    return first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more)


def _classes(drawn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes of equal sets: ``f1, f2, rep, rep_key, node``; and ``rep, rep_key, node`` of those not named by an id.

    A class is represented by its row of smallest id, and by its smallest text if that id has several. Its node is that id. If
    an id represents several classes, all but one of them are numbered beyond all ids.
    """
    # written, so that the joins below have shuffles of their own, whose hot keys Spark can split
    first = saved(
        drawn.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "row_key")).alias("first"))
        .select("f1", "f2", F.col("first.doc_id").alias("rep"), F.col("first.row_key").alias("rep_key")),
        "first",
    )
    several = first.groupBy("rep").agg(F.min("rep_key").alias("named"), F.count("*").alias("n")).where("n > 1").drop("n")
    further = first.join(saved(several, "several"), "rep").where("rep_key <> named").select("rep", "rep_key")
    further = assign_keys(further, "node", drawn.select(F.max("doc_id").alias("node")), lambda purpose, rows: saved(rows, purpose))
    further = saved(further, "further")
    return first.join(further, ["rep", "rep_key"], "left").withColumn("node", F.coalesce("node", "rep")), further


def groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, row_key, n_shingles, component, component_id`` for every row of ``docs`` (``doc_id, text``, other columns unused).

    ``row_key`` tells the texts of an id apart. ``component`` is one number for all rows of a group and for no others;
    ``component_id`` is the smallest id of the group. Two groups have the same ``component_id`` if an id comes with texts of both.
    Rows without an id or with an empty set have no ``component``. Numbers beyond the largest id must be left for further texts of
    an id; if there are too few the job fails.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), "text")
    drawn = saved(sketches(docs, k), "sketches")
    alone = "doc_id IS NULL OR n_shingles = 0"
    taking_part = drawn.where(f"NOT ({alone})")
    nodes, further = _classes(taking_part)
    classes = saved(taking_part.drop("bands").join(nodes.drop("rep", "rep_key"), ["f1", "f2"]).drop("f1", "f2"), "classes")
    # one row for each class (repeated rows: one for each of them, which meet nothing new)
    reps = taking_part.join(nodes, ["f1", "f2"]).where("doc_id = rep AND row_key = rep_key").select(F.col("node").alias("doc_id"), "bands")
    links = _links(docs, nodes, reps, groups_for(docs, drawn.count() * BANDS), k, percent)
    if links is None:
        linked = docs.sparkSession.createDataFrame([], "node long, component long")
    else:
        linked = connected_components(links)
    component = F.coalesce("component", "node").alias("component")
    # a component is named by its smallest node: an id, unless a class numbered beyond the ids has a smaller one
    lower = further.join(linked, "node", "left").select(component, "rep").groupBy("component").agg(F.min("rep").alias("lower"))
    named = classes.join(linked, "node", "left").select("doc_id", "row_key", "n_shingles", component)
    named = named.join(saved(lower, "lower"), "component", "left")
    return named.select("doc_id", "row_key", "n_shingles", "component", F.least("component", "lower").alias("component_id")).union(
        drawn.where(alone).select("doc_id", "row_key", "n_shingles", F.lit(None).cast("long"), "doc_id")
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``, other columns unused).

    Words are split at ASCII white space with A-Z lower-cased; a set holds the distinct ``k``-word shingles, or the whole
    sequence if there are fewer words. Two documents are linked if the Jaccard similarity of their sets is at least
    ``percent`` / 100. ``component_id`` is the smallest id reachable over links; a row is kept if that is its own id.

    Null or blank texts have an empty set and are linked with nothing. A row without an id is linked with nothing, has no
    component and is kept. Repeated rows give repeated rows. If an id comes with several texts, each is a document of its own.
    """
    found = groups(docs, k, percent).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
