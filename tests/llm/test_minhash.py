"""Near-duplicate groups against all pairs in plain Python."""

import random

from ledgerline.llm import components, minhash

KNOWN = "hub long, member long, n_hub long, n_member long, apart array<long>, component long"


def sets_of(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k, percent=80):
    sets = [(i, sets_of(t, k)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and None not in (sets[a][0], sets[b][0]) and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    names = {}
    for a, (i, _) in enumerate(sets):
        names.setdefault(root(a), []).append(i)
    return sorted(
        (-1 if i is None else i, len(s), min(names[root(a)]) if i is not None else -1, i is None or i == min(names[root(a)])) for a, (i, s) in enumerate(sets)
    )


def family(draw, size, words, edits):
    base = [f"w{draw.randint(0, 500)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(words)] = f"e{draw.randint(0, 99999)}"
        out.append(" ".join(copy))
    return out


def run(spark, rows, k):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kept", "1 AS component_id", "2 AS n_shingles")
    found = minhash.near_duplicates(frame, k=k)
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id, r.kept) for r in found.collect())


def test_groups_equal_all_pairs(spark):
    draw = random.Random(11)
    texts = [t for _ in range(6) for t in family(draw, 25, 120, 14)] + [f"only text number {i} of its kind here" for i in range(20)]
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "One"), (905, "x " * 20_000), (905, "x " * 20_000)]
    rows += [(906, texts[0]), (906, texts[0]), (None, texts[0]), (None, None)]
    for k in (2, 5):
        assert run(spark, rows, k) == brute(rows, k)


def test_every_text_of_an_id_takes_part(spark):
    draw = random.Random(13)
    a, b, c, d = (family(draw, 6, 80, 4) for _ in range(4))
    rows = [(1, a[0]), (1, b[0]), (1, c[0]), (2, b[1]), (2, c[1]), (3, c[2]), (4, a[1]), (5, d[0]), (5, d[1]), (5, a[2]), (6, d[2])]
    rows += [(9, a[0]), (9, a[0]), (9, d[3]), (-4, d[4]), (-4, None), (7, b[0].upper()), (1, b[0])]
    for k in (2, 5):
        assert run(spark, rows, k) == brute(rows, k)


def test_small_tiles_find_the_same(spark, monkeypatch):
    draw = random.Random(12)
    monkeypatch.setattr(minhash, "TILE", 7)
    rows = list(enumerate(family(draw, 80, 60, 9)))
    assert run(spark, rows, 2) == brute(rows, 2)


def test_tiles_lose_no_link(spark, monkeypatch):
    # 12 members in the largest component, 4 by themselves, each of these like one or two of the 12 only; tiles are dealt by hash
    monkeypatch.setattr(minhash, "TILE", 2)
    hub = set(range(100))
    sets = {i: hub ^ set(range(10 * (i % 3), 10 * (i % 3) + 10)) ^ {1000 + 100 * i + j for j in range(12)} for i in range(12)}
    sets |= {100 + i: sets[i] ^ {5000 + 100 * i + j for j in range(20)} for i in (0, 1, 5, 10)}
    component = {i: 0 if i < 100 else i for i in sets}
    rows = [(-1, i, len(hub), len(s), sorted(s ^ hub), component[i]) for i, s in sets.items()]
    known = spark.createDataFrame(rows, KNOWN)
    expected = {
        (a, b) for a in sets for b in sets
        if a < b and component[a] != component[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    found = [(min(r), max(r)) for r in minhash._open_links(known, 80).collect()]
    assert len(expected) == 4 and sorted(found) == sorted(expected)


def test_random_members_of_crowded_hubs(spark, monkeypatch):
    # from every set similar to the hub to none; each known component is one that links to the hub imply
    monkeypatch.setattr(minhash, "TILE", 3)
    for percent, seed in ((80, 1), (80, 2), (60, 3), (95, 4)):
        draw = random.Random(seed)
        rows, sets = [], {}
        for hub_id in (-1, -2):
            hub = set(range(draw.randint(30, 120)))
            for i in range(40):
                changed = draw.randint(1, 50)
                if sets.get((hub_id, i - 1)) and draw.random() < 0.5:
                    s = set(sets[hub_id, i - 1]) ^ set(draw.sample(range(200, 400), draw.randint(1, 12)))
                else:
                    s = hub ^ set(draw.sample(range(150), min(changed, 100)))
                sets[hub_id, i] = s
                near_hub = 100 * len(s & hub) >= percent * len(s | hub)
                rows.append((hub_id, i, len(hub), len(s), sorted(s ^ hub), -9 if near_hub else i))
        component = {(r[0], r[1]): r[5] for r in rows}
        expected = {
            (h, a, b) for h in (-1, -2) for a in range(40) for b in range(a + 1, 40)
            if component[h, a] != component[h, b] and 100 * len(sets[h, a] & sets[h, b]) >= percent * len(sets[h, a] | sets[h, b])
        }
        rows = [(h, 1000 * -h + m, *rest) for h, m, *rest in rows]
        links = minhash._open_links(spark.createDataFrame(rows, KNOWN), percent).collect()
        found = {(-(min(r) // 1000), min(r) % 1000, max(r) % 1000) for r in links}
        assert expected and found == expected


def test_tables_without_groups(spark):
    assert run(spark, [(1, "a b c"), (2, "d e f")], 2) == [(1, 2, 1, True), (2, 2, 2, True)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []


def test_long_chains_are_one_component(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (7, 7)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 400: 400, 450: 400, 500: 400}
