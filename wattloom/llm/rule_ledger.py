"""Quality rules as a ledger: every rule is evaluated once, its verdict is one bit.

One pass over a text takes the measurements; each rule is a column expression over them and
sets its bit in `failures`. A policy is a named, versioned mask of the rules that count, so
applying one, or asking how many documents a rule alone removes, is bit arithmetic over the
ledger and reads no text again. `ablation` aggregates partially: one row per task and mask.

Defined results: null or empty text has no word and fails `few_words`; a text of one very
long word or line is measured whole; rows that repeat each get a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import BLANK, map_rows, raw, window_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_alpha_words", "n_upper_words")
_BLANK = BLANK.encode()
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER = bytes(range(65, 91))


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    text = text or b""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) - len(joined.translate(None, bytes(set(range(256)) - set(range(128, 192)))))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    seen, dup, lines = set(), 0, text.split(b"\n")
    filled = 0
    for line in lines:
        if line.strip(_BLANK):
            filled += 1
            if line in seen:
                dup += 1
            seen.add(line)
    repeated = 0
    if len(words) > WINDOW:
        h = window_hashes(word_hashes(text), WINDOW)
        _, back, n = np.unique(h, return_inverse=True, return_counts=True)
        step = np.zeros(len(words) + 1, np.int64)
        twice = np.flatnonzero(n[back] > 1)
        np.add.at(step, twice, 1)
        np.add.at(step, twice + WINDOW, -1)
        repeated = int((np.cumsum(step[:-1]) > 0).sum())
    alpha = sum(1 for w in words if len(w.translate(None, _LETTERS)) < len(w))
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    return len(words), chars, symbols, dup, repeated, filled, alpha, upper


#: Rules in bit order: name -> failed, as SQL over the measurements.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
    "duplicate_lines": "n_lines > 0 and 100 * n_dup_lines > 30 * n_lines",
    "few_alphabetic": "100 * n_alpha_words < 60 * n_words",
    "shouting": "100 * n_upper_words > 50 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: Policies by version: the rules that count.
POLICIES = {
    "v1": ("few_words", "repeated_windows"),
    "v2": tuple(RULES),
}


def mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and `failures`: the bits of the rules that failed."""
    def run(batches):
        for batch in batches:
            names = batch.schema.names
            keys = batch.column(names.index("doc_id")).to_pylist()
            yield [(k, *measure(t)) for k, t in
                   zip(keys, raw(batch.column(names.index("text"))), strict=True)]
    measured = map_rows(docs.select("doc_id", "text"),
                        ", ".join(["doc_id long", *(f"{m} long" for m in MEASURES)]), run)
    bits = [F.when(F.expr(RULES[name]), F.lit(bit)).otherwise(F.lit(0))
            for name, bit in BITS.items()]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("failures", total.cast("long"))


def failed(policy: str) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(policy))) != 0


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents it fails, and those that only it fails."""
    counts = entries.groupBy((F.col("failures").bitwiseAND(F.lit(mask(policy)))).alias("bits")) \
        .agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    return (counts.select("bits", "n", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.expr("bits & r.bit") != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0))
                 .alias("failed_alone")))
