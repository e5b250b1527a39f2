"""Quality rules as a ledger of bit masks.

Every rule is evaluated once per document. What it measured and one bit for each rule that failed are stored; everything after
that is arithmetic on bits. A policy is a named mask of rules, so a new policy, or a verdict of an old one, needs no text. What a
rule costs under a policy, alone or with others, follows from the counts of distinct masks, which an aggregation gives.

The ids of a slice's words come from one dictionary. Windows of eight words get theirs by doubling: equal pairs of ids get equal
ids, then pairs of pairs, then pairs of those, so that equal ids are equal word sequences, not only equal hashes.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_slices, prepare, texts
from ledgerline.llm.native import fresh

#: Words of a window: three doublings.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_marked_words",
)

#: Each rule's bit is its place. It names what fails, on whole numbers, so that every engine decides alike.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "word_length": "word_chars > 20 * n_words OR 2 * word_chars < 3 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "capitals": "100 * n_upper > 50 * n_letters AND n_letters > 0",
    "few_letters": "100 * n_letters < 50 * word_chars",
    "exclamations": "100 * n_marked_words > 50 * n_words",
}
BASE = ("few_words", "repeated_windows")

#: Versions of what is kept: the rules that may not fail. A version, once used, is not changed.
POLICIES: dict[str, tuple[str, ...]] = {"base-1": BASE, "text-1": tuple(RULES)}
CURRENT = "text-1"

_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = np.isin(np.arange(256), list(range(ord("A"), ord("Z") + 1)))
_LETTER = _UPPER | np.isin(np.arange(256), list(range(ord("a"), ord("z") + 1))) | (np.arange(256) >= 0xC0)
_STARTS = (np.arange(256) & 0xC0) != 0x80


def mask(rules: tuple[str, ...]) -> int:
    places = list(RULES)
    return sum(1 << places.index(r) for r in rules)


def _paired(ids: np.ndarray, step: int) -> np.ndarray:
    """Ids of the runs of ``2 * step`` words at each place, from those of the runs of ``step`` words."""
    first, second = ids[: len(ids) - step], ids[step:]
    return np.unique(first * (int(ids.max(initial=0)) + 1) + second, return_inverse=True)[1]


def repeated_words(words: list[bytes], owners: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text, its words inside windows that occur at least twice in it. ``owners``: the text of each word, in order."""
    if len(words) < WINDOW:
        return np.zeros(n_texts, np.int64)
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    for step in (1, 2, 4):
        ids = _paired(ids, step)
    inside = np.flatnonzero(owners[: len(ids)] == owners[WINDOW - 1 :])
    window = owners[inside] * (int(ids.max()) + 1) + ids[inside]
    _, at, times = np.unique(window, return_inverse=True, return_counts=True)
    begins = inside[times[at] > 1]
    change = np.bincount(begins, minlength=len(words) + 1) - np.bincount(begins + WINDOW, minlength=len(words) + 1)
    covered = np.cumsum(change)[: len(words)] > 0
    return np.bincount(owners[covered], minlength=n_texts).astype(np.int64)


def measured(values: list[bytes]) -> dict[str, np.ndarray]:
    """The measurements of each text, in whole numbers."""
    split = [v.split() for v in values]
    words = [w for ws in split for w in ws]
    n_words = np.fromiter(map(len, split), np.int64, len(values))
    lines = [[line for line in v.split(b"\n") if line and not line.isspace()] for v in values]
    n_lines = np.fromiter(map(len, lines), np.int64, len(values))
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))))
    data = np.frombuffer(b"".join(values), np.uint8)

    def count(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(table[data])))[bounds])

    return {
        "n_words": n_words,
        "word_chars": count(_STARTS & ~_SPACE),
        "n_symbols": count(_SYMBOL),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - np.fromiter((len(set(some)) for some in lines), np.int64, len(values)),
        "n_repeat_words": repeated_words(words, np.repeat(np.arange(len(values)), n_words), len(values)),
        "n_upper": count(_UPPER),
        "n_letters": count(_LETTER),
        "n_marked_words": np.fromiter((sum(w.endswith(b"!") for w in ws) for ws in split), np.int64, len(values)),
    }


def ledger(docs: DataFrame, measures: str = "measures", bits: str = "rule_bits") -> DataFrame:
    """``docs`` with a struct of ``MEASURES`` of each whole ``text`` and a long with the bit of each rule that fails.

    A null or empty text has no words, so only ``few_words`` fails. Words are runs of bytes other than 0x20 and 0x09 to 0x0D;
    capitals are A to Z, letters those, a to z and every character beyond ASCII. Repeated rows and ids are measured each by
    itself, a very long text as a whole. Columns with the names of the two results are replaced, all others stay; rows keep their
    partitions (no shuffle), and an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    docs = docs.drop(measures, bits)
    text = fresh("text_", docs)
    fields = pa.struct([(m, pa.int64()) for m in MEASURES])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measured(texts(batch, text))
        made = pa.StructArray.from_arrays([pa.array(found[m], pa.int64()) for m in MEASURES], fields=list(fields))
        kept = [c for c in batch.schema.names if c != text]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], made], [*kept, measures])

    schema = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes] + [f"`{measures}` struct<{', '.join(f'{m}: long' for m in MEASURES)}>"])
    rows = docs.withColumn(text, F.col("text").cast("string")).mapInArrow(by_slices(work, text), schema)
    return rows.withColumn(bits, failure_bits(measures))


def failure_bits(measures: str = "measures") -> Column:
    """The mask of failed rules, from the measurements alone: an old ledger takes new thresholds without its texts."""
    own = [re.sub("[a-z_]+", lambda m: f"`{measures}`.{m[0]}", rule) for rule in RULES.values()]
    return F.expr(" | ".join(f"IF({rule}, {1 << i}L, 0L)" for i, rule in enumerate(own)))


def kept(bits: Column, policy: str | tuple[str, ...] = CURRENT) -> Column:
    """Whether none of the policy's rules failed; a null mask is not kept."""
    rules = POLICIES[policy] if isinstance(policy, str) else policy
    return F.coalesce(bits.bitwiseAND(F.lit(mask(rules)).cast("long")) == 0, F.lit(False))


def ablations(entries: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES, bits: str = "rule_bits") -> DataFrame:
    """What each rule does under each policy: ``policy, rule, n_documents, n_kept, n_failed, n_only, n_never_alone``.

    ``n_failed`` documents fail the rule; ``n_only`` fail it and no other of the policy, so they come back if it is dropped;
    ``n_never_alone`` fail it with others, and ``others`` is the mask of the policy's other rules that fail whenever it does (bitwise
    AND over its documents). Documents are counted per mask first, one row per mask and task before the shuffle; masks are no more than subsets of
    the rules, whatever the corpus holds. No rows give no counts.
    """
    plan = [(name, rule, mask(rules), mask((rule,))) for name, rules in policies.items() for rule in rules]
    asked = [F.struct(*[F.lit(v).alias(c) for c, v in zip(("policy", "rule", "mask", "bit"), row)]) for row in plan]
    counted = entries.groupBy(F.col(bits).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    table = counted.select("bits", "n", F.explode(F.array(*asked)).alias("ask")).select("bits", "n", "ask.*")
    hit, bit = F.col("bits").bitwiseAND(F.col("mask")), F.col("bit")
    failed, alone = hit.bitwiseAND(bit) != 0, hit == bit

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))

    return table.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_documents"), total(hit == 0).alias("n_kept"), total(failed).alias("n_failed"),
        total(failed & alone).alias("n_only"), total(failed & ~alone).alias("n_never_alone"),
        F.coalesce(F.bit_and(F.when(failed, hit.bitwiseXOR(bit))), F.lit(0).cast("long")).alias("others"),
    )
