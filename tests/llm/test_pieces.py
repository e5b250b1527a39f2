"""Ids and texts equal the sentencepiece library's."""

import random

import numpy as np
import pytest

from ledgerline.llm import pieces

library = pytest.importorskip("sentencepiece")
MODEL = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return library.SentencePieceProcessor(model_file=MODEL), pieces.Pieces(MODEL)


def texts():
    draw = random.Random(5)
    signs = " ▁abcdeést\n\t.,!ABC日本語ß0123​\x00\x7f\U0001f600"
    fixed = ["", " ", " " * 100 + "x", "x" + " " * 57, "\n\n x", "a\r\n b", "a" * 500, "ab" * 200, "日本語" * 50, "." * 300, "ha" * 200]
    made = ["".join(draw.choice(signs) for _ in range(draw.randint(1, 80))) for _ in range(1500)]
    made += ["".join(draw.choice(["the", "he", "in", "ing", "ti", "on", "an", " "]) for _ in range(draw.randint(1, 30))) for _ in range(800)]
    return fixed + made + ["".join(draw.choice("ab ") for _ in range(400)) for _ in range(50)]


def test_ids_and_decoded_texts_equal_the_library(both):
    model, own = both
    encoder, many = pieces.Encoder(own), texts()
    ids, counts = encoder.encode(many)
    ends = np.cumsum(counts)
    wanted = [model.encode(t) for t in many]
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == wanted
    assert pieces.decode(own, ids, counts).to_pylist() == [model.decode(w) for w in wanted]


def test_forgetting_segments_changes_nothing(both, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 10)
    _, own = both
    encoder, fresh = pieces.Encoder(own), pieces.Encoder(own)
    for text in texts()[:200]:
        assert encoder.encode([text])[0].tolist() == pieces.Encoder.encode(fresh, [text])[0].tolist()


def test_frames_keep_rows_and_columns(spark, both):
    model, _ = both
    rows = [(1, "the text", 5), (1, "the text", 5), (2, None, 6), (3, "", 7), (None, "long " * 50_000, 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    coded = pieces.encode_texts(frame, MODEL, decoded="decoded")
    found = sorted(((r.doc_id or 0, list(r.ids), r.decoded) for r in coded.collect()))
    assert found == sorted((i or 0, model.encode(t or ""), t or "") for i, t, _ in rows)
    again = pieces.decode_ids(coded.drop("decoded"), MODEL, text="back")
    assert sorted(r.back for r in again.collect()) == sorted(t or "" for _, t, _ in rows)
    assert pieces.encode_texts(frame.limit(0), MODEL).collect() == []
