"""Secret scans with DataFrame functions only: plain patterns, and weak parts that count only together.

Positions come from cutting a text at a pattern: the pieces and the matches between them alternate, so a match begins where all
lengths before it end. Weak parts (a user or client name, an opaque token, an address) are no secret alone. They are reported if
complementary parts lie in one scope, ``REACH`` code points: a token needs an identifier, an identifier a secret, an address
both. The scope is an interval join: parts meet on (document, tile) and are then compared by position. A tile holds few parts,
as the parts of a kind do not overlap, so no document makes a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import row_key, saved
from ledgerline.llm.native import keyed, let, on_row, unpacked

#: The base patterns. A match counts if the group has the length at least.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so shorter ones need not be looked at
}
#: Weak parts, by what they are part of.
WEAK = {
    "login": (r"""(?i)(user_?name|user_?id|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]+)""", 2, 3),
    "opaque": (r"[A-Za-z0-9+/_-]{32,}", 0, 32),
    "endpoint": (r"https?://[A-Za-z0-9.-]+[A-Za-z0-9/_.:?=&%-]*", 0, 12),
}
KINDS = [*BASE, *WEAK]
IDENTIFIERS, SECRETS = ["access", "login"], ["assign", "hex", "opaque"]
REACH, TILE = 200, 512
_BLOCK = 256
_SPANS = "array<struct<start: int, end: int>>"


def _starts(lengths: Column) -> Column:
    """Sum of all lengths before each place; block sums keep this cheap for very many places."""
    total = lambda values: F.aggregate(values, F.lit(0), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / _BLOCK).cast("int")), lambda b: total(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))
    return let(blocks, lambda sums: let(
        F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b))),
        lambda before: F.transform(
            F.sequence(F.lit(0), F.size(lengths) - 1),
            lambda i: before[F.floor(i / _BLOCK).cast("int")] + total(F.slice(lengths, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)),
        ),
    ))


def _spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """All matches that are long enough, leftmost first, as code point positions."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    laid = F.struct(
        F.transform(pieces, F.length).alias("gaps"), F.transform(matches, F.length).alias("long"), F.transform(checked, F.length).alias("size")
    )
    found = let(laid, lambda p: let(
        F.transform(p["long"], lambda n, i: p["gaps"][i] + n),
        lambda steps: let(_starts(steps), lambda before: F.filter(
            F.transform(p["long"], lambda n, i: F.struct(
                (before[i] + p["gaps"][i]).cast("int").alias("start"), (before[i] + p["gaps"][i] + n).cast("int").alias("end"),
                (p["size"][i] >= least).alias("counts"))),
            lambda s: s["counts"],
        )),
    ))
    plain = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), plain).otherwise(F.array().cast(_SPANS))


def _is_mixed(text: Column, spans: Column) -> Column:
    """Opaque tokens have digits, capital and small letters."""
    def mixed(s):
        value = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")

    return F.filter(spans, mixed)


def _parts(found: DataFrame, kinds: list[str]) -> DataFrame:
    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return found.select("doc_id", "row_key", F.explode(F.concat(*map(tagged, kinds))).alias("part")).select("doc_id", "row_key", "part.*")


def _tiled(parts: DataFrame, reach: int) -> DataFrame:
    first = F.floor(F.greatest(F.col("start") - reach, F.lit(0)) / TILE)
    return parts.withColumn("tile", F.explode(F.sequence(first, F.floor((F.col("end") + reach) / TILE))))


def _near(parts: DataFrame, others: DataFrame, how: str = "left_semi", reach: int = REACH) -> DataFrame:
    """The parts that have (or have not) one of the others within reach, in the same document."""
    a = _tiled(parts, reach).alias("a")
    b = _tiled(others, 0).select(
        F.col("doc_id").alias("o_id"), F.col("row_key").alias("o_key"), "tile", F.col("start").alias("o_start"), F.col("end").alias("o_end")
    ).alias("b")
    same = (
        F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("row_key") == F.col("o_key")) & (F.col("a.tile") == F.col("b.tile"))
        & (F.col("o_start") < F.col("end") + reach) & (F.col("o_end") > F.col("start") - reach)
    )
    met = a.join(b, same, "left_semi").drop("tile").distinct()
    return met if how == "left_semi" else on_part(parts, met, "left_anti")


def on_part(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.toDF(*[f"o_{n}" for n in right.columns])
    same = F.col("doc_id").eqNullSafe(F.col("o_doc_id"))
    for n in ("row_key", "kind", "start", "end"):
        same &= F.col(n) == F.col(f"o_{n}")
    return left.join(right, same, how)


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, assign, access, hex, linked`` for every row: base spans by kind, and the weak parts that are reported.

    Spans are code point positions, end exclusive, in order; ``linked`` also names the kind. A null text is empty. Repeated rows
    are returned each; rows without an id are scanned like any others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", row_key().alias("row_key"), text.alias("text"))
    weak = {k: _spans(F.col("text"), *v) for k, v in WEAK.items()}
    weak["opaque"] = _is_mixed(F.col("text"), weak["opaque"])
    hint = F.col("text").rlike(r"AKIA|" + WEAK["login"][0])  # without an identifier nothing weak can be linked
    nothing = F.array().cast(_SPANS)
    found = saved(
        rows.select("doc_id", "row_key", *[_spans(F.col("text"), *v).alias(k) for k, v in BASE.items()],
                    *[F.when(hint, v).otherwise(nothing).alias(k) for k, v in weak.items()]),
        "spans",
    )
    open_rows = found.where("size(login) + size(opaque) + size(endpoint) > 0").dropDuplicates(["doc_id", "row_key"])
    parts = saved(_parts(open_rows, KINDS), "parts")
    base = parts.where(F.col("kind").isin(*BASE))
    loose = saved(_near(parts.where(F.col("kind").isin(*WEAK)), base, "left_anti", reach=0), "loose")  # not inside a base span
    identifiers = base.where(F.col("kind").isin(*IDENTIFIERS)).union(loose.where(F.col("kind").isin(*IDENTIFIERS)))
    secrets = base.where(F.col("kind").isin(*SECRETS)).union(loose.where(F.col("kind").isin(*SECRETS)))
    linked = (
        _near(loose.where("kind = 'login'"), secrets)
        .union(_near(loose.where("kind = 'opaque'"), identifiers))
        .union(_near(_near(loose.where("kind = 'endpoint'"), secrets), identifiers))
    )
    per_row = linked.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("linked"))
    empty = F.array().cast("array<struct<start: int, end: int, kind: string>>")
    return on_row(found.select("doc_id", "row_key", *BASE), per_row).withColumn("linked", F.coalesce("linked", empty))


def span_list(kinds: dict[str, Column]) -> Column:
    """``kind:start:end`` of all spans by start, then kind in the order given, joined by commas."""

    def tagged(place: int, kind: str) -> Column:
        return F.transform(kinds[kind], lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.concat(*[tagged(i, k) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans() -> dict[str, Column]:
    def of_kind(kind: str) -> Column:
        return F.filter("linked", lambda s: s["kind"] == kind)

    return {k: F.col(k) for k in BASE} | {k: of_kind(k) for k in WEAK}


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``; rows without a span and all other columns stay."""
    spans = secret_spans(docs)
    plain = [F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for c in all_spans().values()]
    hit = spans.select("doc_id", "row_key", F.array_sort(F.concat(*plain)).alias("spans")).where("size(spans) > 0").dropDuplicates(["doc_id", "row_key"])

    def cleaned(s):
        reach = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.array_max(F.transform(F.slice(s, 1, i), lambda x: x["end"])))
        pieces = F.transform(F.sequence(F.lit(0), F.size(s)), lambda i: F.when(
            i == F.size(s), F.substring(F.col("row.text"), reach(i) + 1, F.length("row.text"))
        ).when(s[F.least(i, F.size(s) - 1)]["start"] >= reach(i), F.concat(
            F.substring(F.col("row.text"), reach(i) + 1, s[F.least(i, F.size(s) - 1)]["start"] - reach(i)), F.lit(mark))
        ).otherwise(F.lit("")))
        return F.array_join(pieces, "")

    new = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(let(F.col("spans"), cleaned))
    return on_row(keyed(docs), hit).select(unpacked(docs.columns, text=new))
