"""Benchmark hits against every window in plain Python."""

import random
import re

from ledgerline.llm import decontaminate

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(UP))


def brute(docs, items):
    wins = {}
    for item, text in items:
        ws = words(text)
        if ws and item is not None:
            n = min(10, len(ws))
            for s in range(len(ws) - n + 1):
                wins.setdefault(tuple(ws[s : s + n]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        ws, hit, met = words(text), set(), set()
        for n in {len(w) for w in wins}:
            for s in range(len(ws) - n + 1):
                if (w := tuple(ws[s : s + n])) in wins:
                    hit.update(range(s, s + n))
                    met |= wins[w]
        if hit:
            out[doc] = (len(hit), sorted(met))
    return out


def case():
    draw = random.Random(8)
    word = lambda: draw.choice(["Éa", "b1", "C", "déf", "g", "hi", "J2", "ñ"]) + str(draw.randint(0, 30))
    items = [(i, " ".join(word() for _ in range(draw.choice([12, 25, 10, 40])))) for i in range(15)]
    items += [(20, "Just five words, or six"), (21, "nine words of a short item are one window"), (22, None), (23, "?!"), (24, items[0][1]), (None, items[1][1])]
    docs = []
    for d in range(120):
        ws = [word() for _ in range(draw.randint(0, 60))]
        if draw.random() < 0.4:
            t = (draw.choice(items)[1] or "").split()
            a = draw.randint(0, max(0, len(t) - 8))
            ws[len(ws) // 2 : len(ws) // 2] = t[a : a + draw.randint(5, 30)]
        docs.append((d, draw.choice([" ", "-", ", "]).join(ws)))
    return docs + [(500, None), (501, ""), (502, "x y " * 9000 + items[2][1].upper())], items


def test_hits_equal_every_window(spark):
    docs, items = case()
    frame = spark.createDataFrame(docs + docs[:5], "doc_id long, text string").selectExpr("*", "'x' AS items", "1 AS row_key")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontaminate.benchmark_hits(frame, bench).collect()}
    assert found == brute(docs, items) and found
    clean = decontaminate.without_contaminated(frame, bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs + docs[:5] if d not in found)
    assert clean.columns == frame.columns


def test_a_document_without_id_is_its_own(spark):
    text = "one two three four five six seven eight nine ten eleven"
    frame = spark.createDataFrame([(None, text), (None, "clean"), (3, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [r.text for r in decontaminate.without_contaminated(frame, bench).collect()] == ["clean"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.benchmark_hits(docs, bench).collect() == []
    assert decontaminate.without_contaminated(docs, bench).count() == 1
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.benchmark_hits(docs.limit(0), some).collect() == []


def test_only_dataframe_functions_run(spark):
    docs, items = case()
    plan = decontaminate.benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()
