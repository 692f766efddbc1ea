"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements and one failure bit per
rule. Policies are versioned sets of rules and are applied to the stored bits, so a new policy or an
ablation never reads texts again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsdesk.llm import textbatch as tb
from newsdesk.llm.common import map_batches, record_batch, shelter, text_of

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words")
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True  # letters beyond ASCII: every byte of a longer code point counts


@dataclass(frozen=True)
class Rule:
    """`fails` is SQL over the measurements; the position in RULES is the bit."""

    name: str
    fails: str


#: Append only: the position of a rule is its bit in every stored ledger.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("short_words", "n_words > 0 AND 2 * word_chars < 5 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("no_letters", "2 * n_letter_words < n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words", "no_letters"),
}
CURRENT = "v2"


def _measure(words: tb.Words) -> dict[str, np.ndarray]:
    data, offsets = words.data, words.offsets
    n_docs = len(offsets) - 1

    def per_doc(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])

    def per_doc_of(owner: np.ndarray, flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, n_docs).astype(np.int64)

    gap = tb.SPACE[data]
    letters = np.concatenate([[0], np.cumsum(LETTER[data], dtype=np.int64)])
    doc = words.doc
    salt = tb.mix(np.arange(1, n_docs + 1, dtype=np.uint64))

    # Lines end at \n or with the document.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_doc = np.repeat(np.arange(n_docs), 1 + np.diff(np.searchsorted(breaks, offsets)))
    line_ends = np.concatenate([line_starts[1:] - 1, offsets[-1:]])
    last = np.concatenate([line_doc[1:] != line_doc[:-1], [True]]) if len(line_doc) else np.zeros(0, bool)
    line_ends = np.where(last, offsets[line_doc + 1], line_ends)
    has_word = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, line_doc = line_starts[has_word], line_ends[has_word], line_doc[has_word]
    keys = tb.mix(tb.span_hashes(tb.prefix_sums(data), line_starts, line_ends) ^ salt[line_doc])
    _, first, back = np.unique(keys, return_index=True, return_inverse=True)
    dup_line = first[back] != np.arange(len(keys))

    # Words inside windows that occur twice or more in their document.
    covered = np.zeros(len(doc) + 1, np.int64)
    windows = tb.chained(words.hashes, WINDOW)
    inside = np.flatnonzero(doc[: len(windows)] == doc[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    if len(inside):
        _, back, times = np.unique(tb.mix(windows[inside] ^ salt[doc[inside]]), return_inverse=True, return_counts=True)
        again = inside[times[back] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    return {
        "n_words": words.counts,
        "word_chars": per_doc(~gap & ((data & 0xC0) != 0x80)),
        "n_symbols": per_doc(SYMBOLS[data]),
        "n_dup_lines": per_doc_of(line_doc, dup_line),
        "n_repeat_words": per_doc_of(doc, np.cumsum(covered[:-1]) > 0),
        "n_lines": np.bincount(line_doc, minlength=n_docs),
        "n_letter_words": per_doc_of(doc, letters[words.ends] > letters[words.starts]),
    }


def ledger(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns `keep` (default doc_id) of every row, the measurements, and `fail_mask`.

    A NULL text counts as empty and fails `few_words`; repeated rows are measured each. Columns of
    `docs` that are named like a measurement are not read.
    """
    keep = ["doc_id"] if keep is None else keep
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], text_of(docs, text).alias("_text"))
    names = [f"_k{i}" for i in range(len(keep))]

    def step(batch: pa.RecordBatch):
        parts = [_measure(words) for _, words in tb.pieces(batch.column("_text"))]
        yield record_batch(**{n: batch.column(n) for n in names}, **{m: np.concatenate([p[m] for p in parts]).astype(np.int64) for m in MEASURES})

    schema = ", ".join([f"{n} {kinds[c]}" for n, c in zip(names, keep)] + [f"{m} bigint" for m in MEASURES])
    measured = map_batches(source, step, schema)
    bits = " + ".join(f"IF({rule.fails}, {1 << i}L, 0L)" for i, rule in enumerate(RULES))
    return measured.withColumn("fail_mask", F.expr(bits)).withColumnsRenamed(dict(zip(names, keep)))


def policy_mask(policy: str = CURRENT) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def passes(policy: str = CURRENT, mask: str = "fail_mask") -> Column:
    return F.col(mask).bitwiseAND(F.lit(policy_mask(policy))) == 0


def ablations(ledger_rows: DataFrame) -> DataFrame:
    """Per policy and rule: documents that fail the rule, and those only this rule rejects.

    Reads the failure bits alone; the groups are the masks that occur, 2 ** len(RULES) at most.
    """
    masks = ledger_rows.groupBy("fail_mask").agg(F.count("*").alias("docs"))
    rows = [(p, r, BIT[r], policy_mask(p)) for p, names in POLICIES.items() for r in names]
    listed = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(b).cast("bigint").alias("bit"), F.lit(m).cast("bigint").alias("mask")) for p, r, b, m in rows])).alias("r")
    each = masks.select("fail_mask", "docs", listed).select("fail_mask", "docs", "r.*")
    hit = F.col("fail_mask").bitwiseAND(F.col("mask"))
    return each.groupBy("policy", "rule").agg(
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("docs")).otherwise(0)).alias("failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("docs")).otherwise(0)).alias("only_this"),
        F.sum(F.when(hit == 0, F.col("docs")).otherwise(0)).alias("kept"),
        F.bit_or(hit).alias("bits_seen"),
    )


def select(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of `docs` that the policy accepts, with all their columns."""
    inner, restore = shelter(docs, "text")
    kept = ledger(inner, inner.columns).filter(passes(policy))
    return kept.select(*restore(kept))
