"""Quality classifier: a factorisation machine over hashed words, structure statistics and the length on record.

A document is a sparse vector x. Its score is the logistic of w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, and the pairs
cost no more than the features: per factor half of (sum v_i x_i)^2 - sum (v_i x_i)^2.

Training takes at most ``SAMPLE_ROWS`` labelled texts, those whose id hashes lowest, with at most ``SAMPLE_VALUES`` features, and
runs on the driver over their feature vectors. Every row is scored where it lies, with the model as a broadcast of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, prepare, row_key, saved, texts
from ledgerline.llm.native import fresh
from ledgerline.llm.shingles import WordHashes

#: Labelled rows that a model is fitted on, buckets for words, factors of a pair.
SAMPLE_ROWS, WORD_BUCKETS, FACTORS = 12_000, 1 << 16, 8
#: Features of all rows that a model is fitted on, 12 bytes each on the driver.
SAMPLE_VALUES = 20_000_000
#: Each statistic falls into one of so many steps.
STEPS = 24

_words = WordHashes()
_CLASSES = np.zeros(256, np.int64)  # 0: other ASCII signs
for _kind, _codes in enumerate((range(65, 91), range(97, 123), range(48, 58), (9, 11, 12, 13, 32), (10,), b".,;:'\"?-()", range(128, 256)), 1):
    _CLASSES[list(_codes)] = _kind


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def statistics(text: bytes, words: list[bytes], distinct: int, recorded: int | None) -> np.ndarray:
    """Statistics between 0 and 1."""
    codes = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    other, upper, lower, digit, blank, breaks, marks, wide = np.bincount(_CLASSES, weights=codes, minlength=8).tolist()
    size, n = len(text), len(words)
    lines = text.split(b"\n")
    return np.array([
        min(1.0, np.log1p(size) / 16), min(1.0, np.log1p(n) / 14), min(1.0, np.log1p(max(0, recorded or 0)) / 16),
        _share(upper, upper + lower), _share(digit, size), _share(other, size) ** 0.5, _share(marks, size) ** 0.5, _share(wide, size) ** 0.5,
        _share(blank + breaks, size), _share(breaks, n + 1), min(1.0, _share(size - blank - breaks, n) / 20), _share(distinct, n),
        _share(len(set(lines)), len(lines)), min(1.0, np.log1p(_share(size, len(lines))) / 10),
        min(1.0, _share(codes[33] + codes[63], n)), min(1.0, _share(codes[124], n)),
    ])


N_STATISTICS = 16
SIZE = WORD_BUCKETS + N_STATISTICS * STEPS


def features(text: bytes, recorded: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: word frequencies of unit length, and one step of each statistic."""
    words = text.split()
    index, count = np.unique(_words.of(words) % np.uint64(WORD_BUCKETS), return_counts=True)
    value = np.sqrt(count)
    value = value / max(1e-9, np.sqrt((value * value).sum()))
    steps = np.minimum((statistics(text, words, len(index), recorded) * STEPS).astype(np.int64), STEPS - 1)
    return (
        np.concatenate((index.astype(np.int64), WORD_BUCKETS + np.arange(N_STATISTICS) * STEPS + steps)),
        np.concatenate((value, np.full(N_STATISTICS, 0.25))).astype(np.float32),
    )


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray  # of each feature
    factors: np.ndarray  # of each feature, FACTORS wide

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        scaled = self.factors[index] * value[:, None]
        pairs = scaled.sum(axis=0) ** 2 - (scaled * scaled).sum(axis=0)
        return float(self.bias + self.weights[index] @ value + 0.5 * pairs.sum())

    def score(self, text: bytes, recorded: int | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*features(text, recorded)), -35, 35))))


def fit(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, epochs: int = 8, batch: int = 64) -> FactorisationMachine:
    """Minimise the logistic loss with AdaGrad over small batches, in a fixed random order; both labels weigh the same in all."""
    draw = np.random.default_rng(7)
    weights, factors, bias = np.zeros(SIZE), draw.normal(0, 0.02, (SIZE, FACTORS)), 0.0
    seen_w, seen_v, seen_b = np.full(SIZE, 1e-6), np.full((SIZE, FACTORS), 1e-6), 1e-6
    rate = np.clip(label.mean(), 0.02, 0.98) if len(label) else 0.5
    share = np.where(label > 0, 0.5 / rate, 0.5 / (1 - rate))
    for _ in range(epochs):
        order = draw.permutation(len(label))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            sizes = np.array([len(index[r]) for r in rows])
            i, x = np.concatenate([index[r] for r in rows]), np.concatenate([value[r] for r in rows]).astype(np.float64)
            begins = np.cumsum(sizes) - sizes
            scaled = factors[i] * x[:, None]
            total = np.add.reduceat(scaled, begins)
            raw = bias + np.add.reduceat(weights[i] * x, begins) + 0.5 * (total**2 - np.add.reduceat(scaled**2, begins)).sum(axis=1)
            slope = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - label[rows]) * share[rows] / len(rows)
            per = np.repeat(slope, sizes)
            touched, at = np.unique(i, return_inverse=True)
            step_w = np.bincount(at, per * x) + 1e-6 * weights[touched]
            step_v = np.zeros((len(touched), FACTORS))
            np.add.at(step_v, at, (per * x)[:, None] * (np.repeat(total, sizes, axis=0) - scaled))
            step_v += 1e-5 * factors[touched]
            seen_w[touched] += step_w**2
            seen_v[touched] += step_v**2
            weights[touched] -= 0.1 * step_w / np.sqrt(seen_w[touched])
            factors[touched] -= 0.02 * step_v / np.sqrt(seen_v[touched])
            seen_b += slope.sum() ** 2
            bias -= 0.05 * slope.sum() / np.sqrt(seen_b)
    return FactorisationMachine(float(bias), weights.astype(np.float32), factors.astype(np.float32))


def _recorded(docs: DataFrame):
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def held_out(key="doc_id"):
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """A model of ``labels.quality``; held-out ids, null ids and null labels are not used. Without any label the score is 0.5.

    An id with several labels has their largest. Rows with the same id and text count once, and of all texts of labelled ids at most
    ``sample_rows`` are used, those whose id hashes lowest; of these, as many as hold ``SAMPLE_VALUES`` features together (12 bytes each).
    So the driver never holds more, whatever a label or an id occurs with.
    """
    prepare(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    # a random subset by hash: the ids that hash lowest, then of their texts those that do
    drawn = (
        known.where(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    place = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("key")]
    rows = docs.select("doc_id", row_key().alias("key"), "text", _recorded(docs).alias("recorded"))
    labelled = rows.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "key").agg(
        F.max("quality").alias("quality"), F.max("recorded").alias("recorded"))
    chosen = saved(labelled.orderBy(*place).limit(sample_rows), "sample")
    rows = rows.drop("recorded").join(F.broadcast(chosen), ["doc_id", "key"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t, n) for t, n in zip(texts(batch, "text"), batch.column("recorded").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), batch.column("quality"),
             pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary()),
             pa.array([v.tobytes() for _, v in found], pa.binary()), pa.array([len(v) for _, v in found], pa.int64())],
            ["doc_id", "key", "quality", "index", "value", "n"],
        )

    made = rows.select(F.col("doc_id").cast("long"), "key", F.col("quality").cast("int"), "text", "recorded").mapInArrow(
        by_slices(work, "text"), "doc_id long, key long, quality int, index binary, value binary, n long"
    )
    # at most sample_rows rows from here on (rows repeat with their id and text: one of each)
    made = saved(made.dropDuplicates(["doc_id", "key"]), "features")
    upto = made.select("doc_id", "key", F.sum("n").over(W.orderBy(*place)).alias("upto")).where(F.col("upto") <= SAMPLE_VALUES)
    table = made.join(upto, ["doc_id", "key"]).select("doc_id", "quality", "index", "value").toArrow().sort_by(
        [("doc_id", "ascending"), ("index", "ascending"), ("value", "ascending")])
    index = [np.frombuffer(b, np.int32).astype(np.int64) for b in table.column("index").to_pylist()]
    value = [np.frombuffer(b, np.float32) for b in table.column("value").to_pylist()]
    label = table.column("quality").to_numpy().astype(np.float64) > 0
    return fit(index, value, label.astype(np.float64))


def scored(docs: DataFrame, model: FactorisationMachine, score: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality of each whole ``text``; a null text is scored as empty.

    Uses ``text`` and, if there is one, ``n_chars``. Other columns and repeated rows stay; a column called ``score`` is replaced.
    """
    prepare(docs.sparkSession)
    docs = docs.drop(score)
    recorded = fresh("recorded", docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        found = [own.score(t, n) for t, n in zip(texts(batch, "text"), batch.column(recorded).to_pylist())]
        kept = [n for n in batch.schema.names if n != recorded]
        return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(found, pa.float64())], [*kept, score])

    schema = ", ".join([f"`{n}` {t}" for n, t in docs.dtypes] + [f"`{score}` double"])
    return docs.withColumn(recorded, _recorded(docs)).mapInArrow(by_slices(work, "text"), schema)


def accepted(score="score", least: float = 0.3):
    return F.col(score) >= least
