"""SentencePiece BPE, encoded and decoded in vectorised rounds.

A text is cut where no piece of the vocabulary can reach across: before runs of spaces, around control characters, and inside
long segments between any two characters that are neighbours in no piece. Segments a task has not met yet are laid out as one
flat symbol array; every round looks up the rank of each neighbouring pair, takes the smallest rank of each segment, merges its
leftmost non-overlapping pairs at once and compacts the array, until no pair is left. Merging at once equals merging one by one
unless a merge makes a pair of the same or a better rank; such segments are merged one by one instead.

The model file is read on the driver; the tables made from it are bounded by the vocabulary and travel with the tasks.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, prepare, texts

SPACE = "▁"
#: Distinct segments whose ids a task keeps at a time.
KEPT_SEGMENTS = 300_000
#: Longer segments are cut further.
LONG_SEGMENT = 64
_NONE = np.iinfo(np.int64).max
_SLOT_BITS = 19


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + counts[i]`` of all i, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


class Pieces:
    """Tables of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        with open(model_file, "rb") as file:
            spec = proto.ModelProto.FromString(file.read())
        rules, trained = spec.normalizer_spec, spec.trainer_spec
        if (rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
                or not rules.escape_whitespaces or trained.model_type != 2 or not trained.byte_fallback
                or trained.treat_whitespace_as_suffix):
            raise ValueError("needs a BPE model with byte fallback, identity normalisation and a dummy prefix")
        self.name = f"{model_file}:{zlib.crc32(spec.SerializeToString())}"
        size = model.get_piece_size()
        known = {}
        self.byte_ids = np.zeros(256, np.int64)
        raw: list[bytes] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                raw.append(bytes([value]))
            elif model.is_unknown(i):
                raw.append(spec.trainer_spec.unk_surface.encode())
            elif model.is_control(i):
                raw.append(b"")
            else:
                known[piece] = i
                raw.append(piece.replace(SPACE, " ").encode())
        self.size = size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_count = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_count) - self.raw_count
        self.spaced = np.zeros(size, bool)  # pieces that begin with a space sign
        self.spaced[[i for piece, i in known.items() if piece[0] == SPACE]] = True
        self.chars = {c: i for c, i in known.items() if len(c) == 1}
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in known.values()}, reverse=True))}
        pairs = {}
        neighbours = set()
        for piece, i in known.items():
            rank = order[model.get_score(i)]
            for cut in range(1, len(piece)):
                left, right = known.get(piece[:cut]), known.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank, i)
                neighbours.add(ord(piece[cut - 1]) << 32 | ord(piece[cut]))
        keys = sorted(pairs)
        self.pair_keys = np.array([*keys, _NONE], np.int64)
        self.pair_ranks = np.array([*(pairs[k][0] for k in keys), _NONE], np.int64)
        self.pair_ids = np.array([*(pairs[k][1] for k in keys), 0], np.int64)
        slot = self._slots(self.pair_keys[:-1])
        self.slot_of = np.full(1 << _SLOT_BITS, len(keys), np.int32)  # the last pair is none
        self.slot_of[slot[::-1]] = np.arange(len(keys))[::-1]
        self.crowded = np.bincount(slot, minlength=1 << _SLOT_BITS) > 1
        self.neighbours = np.array([*sorted(neighbours), _NONE], np.int64)
        inside = {c for piece in known if len(piece) > 1 for c in piece}
        alone = "".join(chr(c) for c in (*range(32), 127) if chr(c) not in inside)  # none of them is special in a class
        alone_class = f"|[{alone}]" if alone else ""
        self.pattern = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+{alone_class}"

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs; no rank where there is no such piece."""
        keys = left << 32 | right
        slot = self._slots(keys)
        at = self.slot_of[slot]
        search = np.flatnonzero(self.crowded[slot])
        at[search] = np.searchsorted(self.pair_keys, keys[search])
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], _NONE), self.pair_ids[at]

    def cut(self, segment: str) -> list[str]:
        """A long segment, cut between characters that are neighbours in no piece."""
        codes = np.frombuffer(segment.encode("utf-32-le"), np.uint32).astype(np.int64)
        keys = codes[:-1] << 32 | codes[1:]
        ends = np.flatnonzero(self.neighbours[np.searchsorted(self.neighbours, keys)] != keys) + 1
        return [segment[a:b] for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(segment)])]

    def merged(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the segments in order, and how many each has."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(s) for s in segments], np.int64)
        distinct, at = np.unique(codes, return_inverse=True)
        symbol = np.array([self.chars.get(chr(c), self.size) for c in distinct.tolist()], np.int64)[at]
        word = np.repeat(np.arange(len(segments)), lengths)
        origin = np.arange(len(codes))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, place, symbol
        one_by_one: list[int] = []
        rank, made = self.lookup(symbol, np.append(symbol[1:], 0))
        rank[np.append(word[1:] != word[:-1], True)] = _NONE
        while len(symbol):
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(word))))
            finished = best == _NONE
            if finished.any():
                done.append((word[finished], origin[finished], symbol[finished]))
                keep = ~finished
                symbol, word, origin, rank, made, best = (x[keep] for x in (symbol, word, origin, rank, made, best))
                if not len(symbol):
                    break
            fits = rank == best
            place = np.arange(len(fits))
            # in a run of overlapping pairs every second one merges, from the left
            run = np.maximum.accumulate(np.where(fits & ~np.append(False, fits[:-1]), place, 0))
            merge = fits & ((place - run) % 2 == 0)
            where = np.flatnonzero(merge)
            after = np.where(merge, made, symbol)
            stay = np.append(True, ~merge[:-1])
            several = np.flatnonzero(np.bincount(word[where], minlength=len(segments))[word[where]] > 1)
            if len(several):
                clash = self._clashes(word, symbol, after, merge, best, where[several])
                if len(clash):
                    one_by_one.extend(clash.tolist())
                    stay &= ~np.isin(word, clash)
            symbol, word, origin, rank, made, merge = (x[stay] for x in (after, word, origin, rank, made, merge))
            if not len(symbol):
                break
            ends = np.append(word[1:] != word[:-1], True)
            look = np.flatnonzero((merge | np.append(merge[1:], False)) & ~ends)  # pairs of which a side has changed
            rank[merge] = _NONE
            rank[look], made[look] = self.lookup(symbol[look], symbol[look + 1])
            rank[ends] = _NONE
        offsets = np.cumsum(lengths) - lengths
        for w in sorted(set(one_by_one)):
            places, symbols = self._one_by_one(segments[w])
            done.append((np.full(len(places), w), places + offsets[w], symbols))
        if not done:
            return np.empty(0, np.int32), np.zeros(len(segments), np.int64)
        word, origin, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(origin)
        word, origin, symbol = word[order], origin[order], symbol[order]
        return self._with_bytes(word, symbol, codes[origin], len(segments))

    def _clashes(self, word, symbol, after, merge, best, i) -> np.ndarray:
        """Words in which a merge at ``i`` would make a pair that comes before the merges still due there."""
        beyond, before = np.minimum(i + 2, len(word) - 1), np.maximum(i - 1, 0)
        before = np.where((i >= 2) & merge[np.maximum(i - 2, 0)], i - 2, before)
        right = np.where((i + 2 < len(word)) & (word[beyond] == word[i]), self.lookup(after[i], symbol[beyond])[0], _NONE)
        left = np.where((i >= 1) & (word[before] == word[i]), self.lookup(after[before], after[i])[0], _NONE)
        return np.unique(word[i[np.minimum(left, right) <= best[i]]])

    def _with_bytes(self, word, symbol, code, segments) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the ids of their UTF-8 bytes."""
        strange = np.flatnonzero(symbol == self.size)
        if len(strange):
            raw = [chr(c).encode() for c in code[strange].tolist()]
            count = np.ones(len(symbol), np.int64)
            count[strange] = [len(r) for r in raw]
            word, symbol = np.repeat(word, count), np.repeat(symbol, count)
            symbol[symbol == self.size] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return symbol.astype(np.int32), np.bincount(word, minlength=segments)

    def _one_by_one(self, segment: str) -> tuple[np.ndarray, np.ndarray]:
        """Best rank first, leftmost first: places and symbols that are left."""
        symbol = [self.chars.get(c, self.size) for c in segment]
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        waiting: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [i for i in lefts if i >= 0 and after[i] < len(symbol)]
            if lefts:
                left = np.array([symbol[i] for i in lefts])
                right = np.array([symbol[after[i]] for i in lefts])
                for i, rank, made in zip(lefts, *(x.tolist() for x in self.lookup(left, right))):
                    if rank != _NONE:
                        heapq.heappush(waiting, (rank, i, symbol[i], symbol[after[i]], made))

        offer(list(range(len(symbol))))
        while waiting:
            _, i, left, right, made = heapq.heappop(waiting)
            j = after[i]
            if symbol[i] != left or j >= len(symbol) or symbol[j] != right:
                continue
            symbol[i], symbol[j], after[i] = made, -1, after[j]
            if after[j] < len(symbol):
                before[after[j]] = i
            offer([before[i], i])
        left = [i for i, s in enumerate(symbol) if s >= 0]
        return np.array(left, np.int64), np.array([symbol[i] for i in left], np.int64)


class _Places(dict):
    """The place of each segment met; a new one gets the next place and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, segment: str) -> int:
        self.new.append(segment)
        place = self[segment] = len(self)
        return place


class Encoder:
    """Encodes many texts; keeps the ids of segments it has met."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.segments = re.compile(pieces.pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.known = _Places()
        self.ids, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, segments: list[str]) -> None:
        cut = [self.pieces.cut(s) if len(s) > LONG_SEGMENT else [s] for s in segments]
        ids, counts = self.pieces.merged(list(chain.from_iterable(cut)))
        ends = np.cumsum([len(parts) for parts in cut])
        totals = np.diff(np.concatenate(([0], np.cumsum(counts)))[np.append(0, ends)])
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(totals) - totals))
        self.counts = np.concatenate((self.counts, totals))
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, many: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and how many each has."""
        found = [self.segments((" " + text).replace(" ", SPACE)) if text else [] for text in many]
        ends = np.cumsum([0, *map(len, found)])
        if len(self.known) > KEPT_SEGMENTS:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, count=int(ends[-1]))
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        counts = self.counts[at]
        return self.ids[ragged(self.starts[at], counts)], np.diff(np.concatenate(([0], np.cumsum(counts)))[ends])


_encoders: dict[str, Encoder] = {}


def _encoder(pieces: Pieces) -> Encoder:
    """The encoder of this worker process, which outlives a task."""
    if pieces.name not in _encoders:
        _encoders[pieces.name] = Encoder(pieces)
    return _encoders[pieces.name]


def decode(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The texts of ``counts[i]`` ids each; the dummy prefix of the first piece goes, broken UTF-8 becomes U+FFFD."""
    start, count = pieces.raw_start[ids], pieces.raw_count[ids]
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    prefix = firsts[pieces.spaced[ids[firsts]]]
    start[prefix] += 1
    count[prefix] -= 1
    ends = np.concatenate(([0], np.cumsum(count)))[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
    raw = pieces.raw[ragged(start, count)]
    found = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
    try:
        return found.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([value.decode("utf-8", "replace") for value in found.to_pylist()], pa.string())


def _ids_array(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(ids))


def _schema(df: DataFrame, *added: str) -> str:
    return ", ".join([f"`{n}` {t}" for n, t in df.dtypes] + list(added))


def encode_texts(df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the ids of each whole text in ``ids`` and, if asked for, the ids decoded again in ``decoded``.

    A null or empty text has no ids and decodes to the empty text. Columns already called so are replaced; all other columns
    and repeated rows stay. No begin or end ids, no sampling.
    """
    prepare(df.sparkSession)
    pieces = Pieces(model_file)
    df = df.drop(ids, *([decoded] if decoded else []))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, counts = _encoder(pieces).encode([t.decode("utf-8", "replace") for t in texts(batch, text)])
        made = [_ids_array(flat, counts)] + ([decode(pieces, flat, counts)] if decoded else [])
        return pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, ids, *([decoded] if decoded else [])])

    added = [f"`{ids}` array<int>"] + ([f"`{decoded}` string"] if decoded else [])
    return df.mapInArrow(by_slices(work, text), _schema(df, *added))


def decode_ids(df: DataFrame, model_file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text of each row's ``ids`` in ``text``; null or no ids are the empty text."""
    prepare(df.sparkSession)
    pieces = Pieces(model_file)
    df = df.drop(text).withColumn(ids, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            ends = column.offsets.to_numpy().astype(np.int64)
            found = decode(pieces, column.values.to_numpy()[ends[0] : ends[-1]], np.diff(ends))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, text])

    return df.mapInArrow(run, _schema(df, f"`{text}` string"))
