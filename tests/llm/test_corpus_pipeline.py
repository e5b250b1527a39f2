"""The whole pipeline on a small corpus, stage by stage against plain Python."""

import random
import re

import pytest

import corpus_pipeline
from ledgerline.llm import quality
from ledgerline.llm.queries import tokenizer_file
from tests.llm.test_quality import rows as labelled
from tests.llm.test_secrets import base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = [w.lower() for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def one_of_each(rows):
    """All pairs, reachability, and of each group the smallest."""
    nodes = sorted(dict.fromkeys(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets = [shingles(r[1]) for r in nodes]
    group = list(range(len(nodes)))
    for i in range(len(nodes)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return [r for i, r in enumerate(nodes) if group[i] == i]


def hit(text, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())
    own = words(text)
    for item in map(words, items):
        n = min(len(item), 10)
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        if any(tuple(own[i : i + n]) in windows for i in range(len(own) - n + 1)):
            return True
    return False


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    draw = random.Random(21)
    folder = str(tmp_path_factory.mktemp("sf"))
    data = labelled(300)
    word = lambda: "".join(draw.choice(["an", "ter", "on", "re", "the", "ing"]) for _ in range(draw.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    family = prose(120)
    bench = prose(40)
    docs = [(i, t) for i, t, _ in data]
    docs += [(400 + i, family.replace(family.split()[i], "changed", 1)) for i in range(8)]
    docs += [(420, family), (421, prose(60)), (422, prose(20) + " " + bench + " " + prose(20)), (423, f"{prose(30)} password=hunter22secret {prose(30)}")]
    x, y, z = prose(50), prose(50), prose(50)
    docs += [(500, x), (501, x), (501, y), (502, x), (502, x), (500, x)]  # ids with several texts, repeated rows
    docs += [(503, prose(50)), (503, z), (504, z + " more"), (504, x + " more")]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, bench), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, [bench], y


def test_every_stage_does_what_plain_python_does(spark, corpus):
    folder, items, only_copy = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text, r.n_chars) for r in docs.collect()]
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = [r[:2] for r in rows if model.score(r[1].encode(), r[2]) >= 0.3]
    assert 0 < len(kept) < len(rows)
    stages = dict(corpus_pipeline.STAGES)
    after = corpus_pipeline.saved(stages["quality"](spark, docs, folder), "test")
    assert sorted(tuple(r)[:2] for r in after.collect()) == sorted(kept)

    after = corpus_pipeline.saved(stages["near_dedup"](spark, after, folder), "test")
    kept = one_of_each(kept)
    found = sorted(tuple(r)[:2] for r in after.collect())
    assert len(found) == len(kept) and sorted(t for _, t in found) == sorted(t for _, t in kept)
    assert (501, only_copy) in found and not any(i == 504 for i, _ in found)

    after = corpus_pipeline.saved(stages["decontamination"](spark, after, folder), "test")
    kept = [r for r in found if not hit(r[1], items)]
    assert len(kept) < len(found) and sorted(tuple(r)[:2] for r in after.collect()) == kept

    after = corpus_pipeline.saved(stages["secrets"](spark, after, folder), "test")
    clean = [(r.doc_id, r.text) for r in after.collect()]
    found = dict(clean)[423]
    assert found.count("[SECRET]") == 1 and "hunter22" not in found and len(clean) == len(kept)
    assert all(r in clean for r in kept if not base(r[1]))

    model = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    final = [tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "text", "ids", "n_tokens").collect()]
    assert sorted(r[:2] for r in final) == sorted((r.doc_id, r.text) for r in after.collect())
    assert all(list(ids) == model.encode(text) and n == len(ids) for _, text, ids, n in final)
