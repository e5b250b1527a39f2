"""The lookup table: turns, balance, few moves, and placement."""

import hashlib

import numpy as np
import pytest

from ledgerline.llm import sharding


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_shards_take_turns():
    names, slots = [f"s{i}" for i in range(5)], 101
    prefers = [[(number(f"{n}:offset") + j * (number(f"{n}:skip") % (slots - 1) + 1)) % slots for j in range(slots)] for n in names]
    owner = {}
    for turn in range(slots):
        mine = prefers[turn % 5]
        owner[next(s for s in mine if s not in owner)] = turn % 5
    assert sharding.lookup_table(names, slots).tolist() == [owner[s] for s in range(slots)]


def test_balance_and_few_moves():
    names = [f"s{i}" for i in range(32)]
    table = sharding.lookup_table(names)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    less = sharding.lookup_table(names[:-1])
    moved = (less != table) & (table != 31)
    assert moved.mean() < 0.15


def test_placement_and_its_limits(spark):
    names = [f"s{i}" for i in range(3)]
    frame = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (7, "c")], "doc_id long, slot string")
    table = sharding.lookup_table(names)
    found = sorted((r.doc_id or 0, r.slot, r.shard) for r in sharding.placed(frame, names).collect())
    wanted = [(i or 0, number("" if i is None else str(i)) % sharding.SLOTS) for i in (1, 1, None, 7)]
    assert found == sorted((i, s, names[table[s]]) for i, s in wanted)
    assert sharding.placed(frame.limit(0), names).collect() == []
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a"] * 9, 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)
