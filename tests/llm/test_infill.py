"""Cuts, forms and restored texts against a plain walk over the code points."""

import hashlib
import random
import re

import numpy as np
import pytest

from ledgerline.llm import infill

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ODD = ["", " ", "\n\t ", "word", " word", "word ", "é", " é x y ", "\U0001f600 \U0001f600\x0b", "a\x00b \x7f\x80\xff", "x" * 9, "ab cd" * 40,
       "holds <P> a marker", "<S>", "<M", "<<P", "P> <", "\x08\x09\x0d\x0e\x1f\x20\x21", "a <\nS> b"]


def plainly(doc_id, text, transformed=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    name = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(tokens[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= transformed:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS text_", "1 AS draw0", "2 AS infill", "3 AS digest")
    made = infill.infilled(frame, **settings)
    assert made.columns == ["doc_id", "text", "text_", "draw0", "digest", "infill"]
    back = infill.restored(made["infill.output"], made["infill.form"]).alias("back")
    found = [(r.doc_id, r.text, tuple(r.infill), r.back) for r in made.select("*", back).collect()]
    assert sorted(map(str, found)) == sorted(str((i, t, plainly(i, t, *settings.values()), t or "")) for i, t in rows)


def test_odd_texts_in_every_form(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 12)] + [(None, "no id here"), (3, None), (None, None), (5, "again a b"), (5, "again a b")]
    check(spark, rows)
    check(spark, rows, transformed=100, suffix_first=50)


def test_random_texts_and_a_very_long_one(spark):
    draw = random.Random(5)
    some = lambda n: "".join(draw.choice("ab é中\U0001f600 \n\t<>PSM") for _ in range(n))
    check(spark, [(i, some(draw.randint(0, 60))) for i in range(400)] + [(10**12, some(3_000_000))], transformed=100, suffix_first=50)


def test_no_rows(spark):
    assert infill.infilled(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("length", [1, 7, 8, 9, 64, 1000])
def test_rank_and_select_agree_with_counting(length):
    data = np.random.default_rng(length).integers(0, 256, length).astype(np.uint8)
    for mark, plain in ((infill.spaces, np.isin(data, [9, 10, 11, 12, 13, 32])), (infill.characters, (data & 0xC0) != 0x80)):
        marks = infill.Marks(mark(infill.as_words(data)))
        assert marks.rank(np.arange(length + 1)).tolist() == np.append(0, np.cumsum(plain)).tolist()
        places = np.flatnonzero(plain)
        assert marks.rank(places).tolist() == list(range(len(places)))
        assert marks.select(np.arange(1, len(places) + 1)).tolist() == places.tolist()
