"""Repeated passages against every window in plain Python."""

import hashlib
import random

import pytest

from ledgerline.llm import meeting, passages


def brute(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, rows, window):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS row_key", "3 AS places")
    counts = passages.saved(passages.word_counts(frame), "test")
    changed = {(r.doc_id, r.row_key): r for r in passages.repeated_passages(frame, counts, window).collect()}
    out = []
    for r in counts.collect():
        c = changed.get((r.doc_id, r.row_key))
        digest = r.words_sha256 if c is None else hashlib.sha256(c.text.encode()).hexdigest()
        out.append((r.doc_id, r.n_words, 0 if c is None else c.n_removed, digest))
        if c is not None:
            assert c.n_removed == sum(s.end - s.start for s in c.removed)
    return out


def corpus(draw, window):
    word = lambda: f"w{draw.randint(0, 3000)}"
    shared = [[word() for _ in range(draw.randint(window - 2, 4 * window))] for _ in range(12)]
    texts = []
    for _ in range(150):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += [word() for _ in range(draw.randint(0, 30))] + (draw.choice(shared) if draw.random() < 0.5 else [])
        texts.append(" ".join(words))
    return texts + texts[:10] + ["la " * 300, "la " * 120, " ".join(shared[0][: window - 1]), "", " \n"]


@pytest.mark.parametrize("window", [3, 12, 20, 50])
def test_every_repeated_window_goes(spark, window, monkeypatch):
    monkeypatch.setattr(meeting, "GATHERED", 2000)
    draw = random.Random(window)
    rows = [(i * 3 % 499, t) for i, t in enumerate(corpus(draw, window))] + [(600, None)]
    assert sorted(run(spark, rows, window)) == brute(rows, window)


def test_any_two_places_share_an_anchor():
    for period, cover in passages.COVERS.items():
        for i in range(period):
            for j in range(period):
                assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_repeated_rows_and_rows_without_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text), (2, text), (None, text), (2, "another text " + text)]
    found = run(spark, rows, 50)
    known = [(i, t) for i, t in rows if i is not None]
    assert sorted(f for f in found if f[0] is not None) == brute(known, 50) and [f[2] for f in found if f[0] is None] == [0]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert run(spark, [(1, "short")], 50)[0][2] == 0 and passages.word_counts(empty).collect() == []


def test_cleaned_tables_keep_their_columns(spark):
    text = " ".join(f"w{i}" for i in range(55))
    frame = spark.createDataFrame([(1, text, "a"), (2, "x " + text + "  y", "b"), (3, "left  as it is", "c")], "doc_id long, text string, source string")
    found = passages.without_repeats(frame)
    assert found.columns == frame.columns
    assert sorted(tuple(r) for r in found.collect()) == [(1, text, "a"), (2, "x y", "b"), (3, "left  as it is", "c")]


def test_every_text_of_an_id_takes_part(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, b), (2, b), (3, f"start here {b} end here"), (4, c), (4, f"{c} {a}"), (4, "short"), (5, f"x {c} y"), (5, f"{b} z {a}")]
    assert sorted(run(spark, rows, 50)) == brute(rows, 50)


def test_random_ids_with_several_texts(spark, monkeypatch):
    monkeypatch.setattr(meeting, "GATHERED", 2000)
    draw = random.Random(77)
    rows = [(draw.randint(0, 40), t) for t in corpus(draw, 20)]
    assert sorted(run(spark, rows, 20)) == brute(rows, 20)
