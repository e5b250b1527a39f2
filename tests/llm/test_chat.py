"""Formatted chats read back exactly, whatever the texts hold."""

import hashlib
import random

from ledgerline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "<|", "|", "<", "\\|", "", "é<|im_sep|>\n", "a" * 300, "<|<\\|<|", "\U0001f600|<|"]


def expected(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        conv: (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), sum(len(t) for r, t in turns if r == "assistant"),
               digest("".join(t for r, t in turns if r == "assistant")))
        for conv, turns in out.items()
    }


def test_texts_survive_the_round_trip(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "<|im_end|>", None]), draw.choice([*NASTY, None]))
            for c in (1, 2, 3, None) for t in range(draw.randint(1, 40))]
    rows += [(9, t, "assistant", "x" * 5000 + NASTY[t % len(NASTY)]) for t in range(60)]  # several parts
    rows += [(7, None, "user", "no turn"), (7, 0, "assistant", "later")]
    parts = chat.format_chat(spark.createDataFrame(rows, SCHEMA)).cache()
    assert parts.where("conv_id = 9").count() > 1
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(parts).collect()}
    assert found == expected(rows)
    lengths = {r.conv_id: r.formatted_chars for r in chat.read_back(parts).collect()}
    assert lengths[9] == sum(len(r.formatted) for r in parts.where("conv_id = 9").collect())
    parts.unpersist()


def test_the_mask_covers_assistant_texts_only(spark):
    rows = [(1, 0, "user", "ask"), (1, 1, "assistant", "té<|ll"), (1, 2, "Assistant", "no")]
    part = chat.format_chat(spark.createDataFrame(rows, SCHEMA)).first()
    assert part.formatted == (
        "<|im_start|>user<|im_sep|>ask<|im_end|><|im_start|>assistant<|im_sep|>té<\\|ll<|im_end|>"
        "<|im_start|>Assistant<|im_sep|>no<|im_end|>"
    )
    assert [part.formatted[s.start : s.end] for s in part.loss] == ["té<\\|ll"]


def test_repeated_turns_are_kept_and_no_turns_give_none(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS formatted", "1 AS loss", "2 AS seq")
    assert [r.n_turns for r in chat.read_back(chat.format_chat(frame)).collect()] == [2]
    assert chat.read_back(chat.format_chat(frame.limit(0))).collect() == []
