"""Measurements against plain Python, masks against the rules' texts, ablations against dropping a rule."""

import random
import re

import pytest

from ledgerline.llm import ledger


def plainly(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_lines": len(lines),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)), "n_repeat_words": len(hit),
        "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z\x80-\U0010ffff]", text)),
        "n_marked_words": sum(w.endswith("!") for w in words),
    }


def failed(measures):
    return [r for r, rule in ledger.RULES.items() if eval(rule.replace("OR", "or").replace("AND", "and"), {}, measures)]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    some = lambda n, k: " ".join(draw.choice(["a", "Bé", "c!", "#|", "\n", "dd\n", "\t", "WORD!", "plain", "中文"][:k]) for _ in range(n))
    texts = [some(draw.randint(0, 90), draw.randint(1, 10)) for _ in range(150)]
    texts += ["", None, " \n ", "one", "x " * 7, "x " * 8, "x " * 9, "1 2 3 4 5 6 7 8 " * 2, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", "a\nb\r\na\nb\n\n\na",
              "a b c d e f g h", "b c d e f g h a b c d e f g h", "good words in a plain text that says little " * 3]
    return [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again")]


def test_measures_and_bits(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS text_", "2 AS measures")
    entries = ledger.ledger(frame)
    assert entries.columns == ["doc_id", "text", "n_words", "text_", "measures", "rule_bits"]
    found = entries.collect()
    assert len(found) == len(rows) and sorted(str(r.text) for r in found) == sorted(str(t) for _, t in rows)
    for r in found:
        assert r.measures.asDict() == plainly(r.text)
        assert r.rule_bits == ledger.mask(tuple(failed(r.measures.asDict())))


def test_a_very_long_text_is_measured_whole(spark):
    words = [f"w{i % 70_000}" for i in range(140_000)]
    (row,) = ledger.ledger(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).collect()
    assert (row.measures.n_words, row.measures.n_repeat_words) == (140_000, 140_000)


def test_policies_and_ablations(spark, rows):
    entries = ledger.ledger(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    masks = [r.rule_bits for r in entries.collect()]
    for policy, rules in ledger.POLICIES.items():
        kept = entries.where(ledger.kept(entries["rule_bits"], policy)).count()
        assert kept == sum(not m & ledger.mask(rules) for m in masks)
        for r in ledger.ablations(entries).where(f"policy = '{policy}'").collect():
            without = ledger.mask(tuple(x for x in rules if x != r.rule))
            bit = ledger.mask((r.rule,))
            assert (r.n_documents, r.n_kept, r.n_failed) == (len(masks), kept, sum(bool(m & bit) for m in masks))
            assert r.n_only == sum(not m & without for m in masks) - kept and r.n_only + r.n_never_alone == r.n_failed
            always = [x for x in rules if x != r.rule and r.n_failed and all(m & ledger.mask((x,)) for m in masks if m & bit)]
            assert r.others == ledger.mask(tuple(always))
    entries.unpersist()


def test_empty_and_odd_tables(spark):
    none = ledger.ledger(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == [] and ledger.ablations(none).collect() == []
