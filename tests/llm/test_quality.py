"""The factorisation machine: its identity, its accuracy on held-out rows, and tables with nothing in them."""

import random
import zlib

import numpy as np

from ledgerline.llm import quality


def test_sum_of_squares_equals_all_pairs():
    draw = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.3, draw.normal(size=quality.SIZE), draw.normal(size=(quality.SIZE, quality.FACTORS)))
    index, value = quality.features("Some words | and MORE words!! 12 été".encode(), 30)
    pairs = sum(
        model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b] for a in range(len(index)) for b in range(a)
    )
    assert np.isclose(model.raw(index, value), 0.3 + model.weights[index] @ value + pairs, rtol=1e-5)


def rows(n=400):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice(["an", "ter", "on", "re", "the"]) for _ in range(draw.randint(1, 3)))
    good = lambda: " ".join(word() for _ in range(draw.randint(5, 80))) + "."
    bad = [lambda: " | ".join(word() for _ in range(40)), lambda: " ".join(word().upper() + "!!" for _ in range(30)), lambda: " ".join(word() + "$$$" for _ in range(30))]
    return [(i, draw.choice(bad)() if i % 5 == 0 else good(), int(i % 5 != 0)) for i in range(n)]


def test_held_out_rows_are_told_apart(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in data] + [(900, None, "x"), (901, "", "x"), (None, "words", "x"), data[0][:2] + ("x",)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data] + [(1, None), (None, 0), (2, data[2][2])], "doc_id long, quality int")
    found = quality.scored(docs, quality.train(docs, labels)).withColumn("held", quality.held_out()).collect()
    assert len(found) == len(data) + 4 and all(0 <= r.score <= 1 for r in found)
    truth = {i: q for i, _, q in data}
    held = [r for r in found if r.held and r.doc_id in truth]
    assert len(held) > 40 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in held]) >= 0.95


def test_the_sample_is_bounded_and_fixed(spark):
    data = rows(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")
    one, two = (quality.train(docs.repartition(n), labels.repartition(n), sample_rows=50) for n in (1, 5))
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights) and np.array_equal(one.factors, two.factors)


def test_an_id_with_very_many_texts_does_not_break_the_bound(spark, monkeypatch):
    fitted = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda index, value, label: fitted.append([len(v) for v in value]) or real(index, value, label))
    docs = spark.range(3000).selectExpr("2L AS doc_id", "concat('text ', id % 700) AS text").union(spark.createDataFrame([(1, "other")], "doc_id long, text string"))
    labels = spark.createDataFrame([(2, 1), (1, 0)], "doc_id long, quality int")
    quality.train(docs, labels, sample_rows=10)
    assert len(fitted[0]) == 10
    quality.train(docs, labels)
    assert len(fitted[1]) == 701  # each text once
    monkeypatch.setattr(quality, "SAMPLE_VALUES", 200)
    quality.train(docs, labels)
    assert 0 < sum(fitted[2]) <= 200


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert all(0.4 < r.score < 0.6 for r in quality.scored(docs, quality.train(docs, labels)).collect())
    assert quality.scored(docs.limit(0), quality.train(docs.limit(0), labels)).collect() == []
