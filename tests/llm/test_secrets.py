"""Secret spans against regular expressions, linking, and redaction."""

import random
import re

from ledgerline.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
OPAQUE = "aB3" * 13


def base(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0]))))


def spans(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS hex", "1 AS linked", "2 AS row_key")
    from pyspark.sql import functions as F

    found = secrets.secret_spans(frame)
    only = {k: F.col(k) for k in secrets.BASE}
    return [(r.doc_id, r.b, r.a) for r in found.select("doc_id", secrets.span_list(only).alias("b"), secrets.span_list(secrets.all_spans()).alias("a")).collect()]


def test_base_spans_equal_the_expressions(spark):
    draw = random.Random(6)
    bits = ["password", "Token", "api_key", "APIKEY", "secret", " ", "=", ":", '"', "'", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "\U0001f600",
            "x.y-z", "/+", "\n", "token=ab", "password: hunter22", "deadbeef" * 4]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    texts += ["password=" * 3, "token=token=abcdef", "secret=token :abcdefgh", None, "", "password" + " " * 500 + "=abcdefg", "é token=abcdef, " * 1500]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    assert sorted((i, b) for i, b, _ in spans(spark, rows)) == sorted((i, base(t)) for i, t in rows)


def test_weak_parts_count_only_together(spark):
    far = " word" * 200
    rows = [
        (1, f"login: alice then {OPAQUE}"), (2, f"just {OPAQUE} here"), (3, "login: alice alone"), (4, f"login: alice{far}{OPAQUE}"),
        (5, f"https://db.example.com/x login: bob {OPAQUE}"), (6, "see https://example.com/x"), (7, f"AKIA{'A' * 16} and {OPAQUE}"),
        (8, f"username=carol password=hunter22"), (9, "x" * 40), (10, f"login: bob{far}{OPAQUE}{far}login: eve {OPAQUE}"),
    ]
    added = {i: [s.split(":")[0] for s in a.split(",") if s and s not in b.split(",")] for i, b, a in spans(spark, rows)}
    assert added[1] == ["login", "opaque"] and added[2] == added[3] == added[4] == added[6] == added[9] == []
    assert added[5] == ["endpoint", "login", "opaque"] and added[7] == ["opaque"] and added[8] == ["login"]
    assert added[10] == ["login", "opaque"]


def test_no_span_is_lost_where_there_are_very_many(spark):
    text = "login: alice " + " ".join(f"{OPAQUE}{i}" for i in range(700)) + " " + "0123456789abcdef01234567," * 600
    (_, b, a), = spans(spark, [(1, text)])
    assert b == base(text) and set(b.split(",")) <= set(a.split(","))


def test_redaction(spark):
    rows = [(1, f"é password=hunter22, login: alice {OPAQUE} end", "k"), (1, f"é password=hunter22, login: alice {OPAQUE} end", "k"), (2, "clean", "l"), (None, "token=abcdef", "m"),
            (3, None, "n"), (4, "secret=" + "deadbeef" * 4 + "!", "o")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secrets.redacted(frame)
    assert found.columns == ["doc_id", "text", "spans"]
    assert sorted((r.spans, r.text or "") for r in found.collect()) == [
        ("k", "é [SECRET], [SECRET] [SECRET] end"), ("k", "é [SECRET], [SECRET] [SECRET] end"), ("l", "clean"), ("m", "[SECRET]"), ("n", ""), ("o", "[SECRET]!")]
    assert secrets.redacted(frame.limit(0)).collect() == []


def test_only_dataframe_functions_run(spark):
    plan = secrets.redacted(spark.createDataFrame([(1, "token=abcdef")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
