"""Exact search against brute force over Python integers."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import topk


def brute(rows, k):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in kept if i % 10 == 0}:
        scores = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for p, a in kept if p == q for i, b in kept if i != q and len(a) == len(b)
        )[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_matches_brute_force_with_ties_nulls_and_repeats(spark, monkeypatch):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, -0.25, 0.0, 0.3, 0.7]) for _ in range(37)]) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(300, 330)] + [rows[5], (5, [0.0] * 37), (400, None), (410, [None] * 37), (20, [0.7] * 37), rows[30], rows[30]]
    rows += [(420, [float("nan")] * 37), (430, [float("inf")] + [0.0] * 36), (440, [1.0, 2.0]), (441, [0.5, 0.5]), (450, []), (None, [0.1] * 37)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    single = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 10 == 0, k=7).collect())
    assert found == [r for r in brute(single, 7)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_small_tiles_and_panels_give_the_same(spark, monkeypatch):
    for name, size in (("CANDIDATE_BYTES", 60 * 160), ("QUERY_BYTES", 5 * 160), ("SEEDS", 40)):
        monkeypatch.setattr(topk, name, size)
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(20)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 10 == 0, k=10).collect()) == brute(rows, 10)


def test_large_components_stay_exact():
    draw = np.random.default_rng(0)
    for size in (2**20, 2**28, 2**33):
        c = draw.integers(-size, size, (9, 50))
        ids = np.arange(50)
        found = topk.search(c[:, :5], ids[:5], c, ids, 4)
        for q in range(5):
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(c[:, q], c[:, i])), i) for i in range(50) if i != q)[:4]
            assert [(i, s) for a, i, s in found if a == q] == [(i, -s) for s, i in scores if -(2**63) <= s < 2**63]


def test_bounds_spare_most_blocks(monkeypatch):
    # clustered vectors of several panels: exact results, with floors from a seed from a fifth of the products
    monkeypatch.setattr(topk, "PANEL", 500)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 64))
    vectors = centres[draw.integers(0, 40, 4000)] + 0.3 * draw.normal(size=(4000, 64))
    vectors = np.floor(1024 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64).T
    ids = draw.permutation(4000).astype(np.int64)
    exact = vectors[:, :100].T @ vectors
    expected = []
    for q in range(100):
        others = np.flatnonzero(ids != ids[q])
        order = others[np.lexsort((ids[others], -exact[q, others]))[:10]]
        expected += [(int(ids[q]), int(ids[c]), int(exact[q, c])) for c in order]
    seeded = np.array([-np.sort(-exact[q, 100:800])[9] for q in range(100)], np.float64)
    for floors, share in ((None, 0.7), (seeded, 0.2)):
        counts = [0]
        assert sorted(topk.search(vectors[:, :100], ids[:100], vectors, ids, 10, floors, counts)) == sorted(expected)
        assert counts[0] <= share * 100 * 4000 * 64 / topk.BLOCK
