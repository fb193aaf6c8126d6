"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding writes homoglyphs and digit substitutions as plain letters, one character for one.
A match counts if it stands at word bounds and no exception phrase covers it. The sum of the
weights, as it is and normalised by length, goes on a log scale through a logistic curve.

Fitting uses at most `max_rows` labelled training rows, the ones smallest by a hash of their
id. Each word is judged by its own counts, whatever those of other words: it must be `precise`
and held by `least` toxic rows, and its weight is the lower confidence bound, `deviations`
standard errors below, of the log odds of its document frequencies in toxic and other rows;
it must be above zero. Exception phrases are word pairs with a lexicon word that clean rows
hold and toxic rows do not. The lexicon is bounded by the words of the sample alone.

Defined results: null and empty text scores the curve at zero; without labels, or with labels
of one kind only, the lexicon is empty and every score is the share of toxic rows (0.0
without rows). Labels of a document that repeats are used once for each row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import map_rows, plain

#: Look-alikes of Latin letters and digits or signs used for letters.
LOOKS = {
    "a": "аα@4", "b": "ь8", "c": "сϲ", "e": "еε3", "g": "9", "h": "һ", "i": "іι1ı", "j": "ј",
    "k": "κ", "l": "ӏ", "o": "оο0", "p": "рρ", "s": "ѕ5$", "t": "τ7", "u": "υ", "v": "ν",
    "x": "хχ", "y": "у",
}
FOLD = {ord(look): letter for letter, looks in LOOKS.items() for look in looks}
FOLD |= {c: chr(c + 32) for c in range(65, 91)}
FOLD |= {ord(look.upper()): letter for letter, looks in LOOKS.items() for look in looks
         if len(look.upper()) == 1 and look.upper() != look}
_WORD = regex.compile(r"[\p{L}]+")


def fold(text: str) -> str:
    return text.translate(FOLD)


@lru_cache(maxsize=4)
def matcher(words: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
    """The automaton over words (with weights) and exception phrases (with None)."""
    auto = ahocorasick.Automaton()
    for word, weight in words:
        auto.add_word(word, (len(word), weight))
    for phrase in exceptions:
        auto.add_word(phrase, (len(phrase), None))
    if len(auto):
        auto.make_automaton()
    return auto


def evidence(text: str, auto) -> tuple[float, float]:
    """Sum of the weights, and the same for each 100 words' worth of characters."""
    if not len(auto) or not text:
        return 0.0, 0.0
    folded, n, spared, hits = fold(text), len(text), [], []
    for end, (size, weight) in auto.iter(folded):
        start = end - size + 1
        if (start and text[start - 1].isalnum()) or (end + 1 < n and text[end + 1].isalnum()):
            continue
        if weight is None:
            spared.append((start, end))
        else:
            hits.append((start, end, weight))
    total = sum(w for s, e, w in hits
                if not any(a <= s and e <= b for a, b in spared)) if spared else \
        sum(h[2] for h in hits)
    return total, total / (1.0 + n / 600.0)


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def sample(docs: DataFrame, labels: DataFrame, target: str, training: Column,
           max_rows: int) -> DataFrame:
    """text and label `y` of at most `max_rows` training rows, smallest by hash of the id."""
    chosen = (labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
              .select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col(target).cast("int").alias("y"))
              .where(training).groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # At most max_rows pairs of numbers, whatever the size of the tables.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").select("text", "y")


def _grams(rows: DataFrame) -> DataFrame:
    """y and the distinct folded words of each row."""
    def run(batches):
        for batch in batches:
            out = []
            for text, y in zip(plain(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words = _WORD.findall(fold(text))
                out += [(y, w) for w in set(words) if 3 <= len(w) <= 40]
            yield out
    return map_rows(rows, "y int, word string", run)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, least: int = 4,
        precise: float = 0.6, deviations: float = 1.645) -> dict:
    """Lexicon, exception phrases and curve, from the sample's rows."""
    rows = sample(docs, labels, "toxic", in_training(F.col("doc_id")), max_rows).persist()
    sizes = dict(rows.groupBy("y").count().collect())
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    base = pos / (pos + neg) if pos + neg else 0.0
    model = {"words": (), "exceptions": (), "curve": None, "base": base}
    if pos and neg:
        held = _grams(rows).groupBy("word").agg(
            F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("p"),
            F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("q"))
        p, q = F.col("p") + 0.5, F.col("q") + 0.5
        odds = F.log(p / (pos + 1.0)) - F.log(q / (neg + 1.0))
        error = F.sqrt(1 / p + 1 / q - 1 / (pos + 1.0) - 1 / (neg + 1.0))
        kept = (held.where((F.col("p") >= least) & (F.col("p") >= precise * (F.col("p") + F.col("q"))))
                .withColumn("weight", odds - deviations * error).where("weight > 0")
                .orderBy(F.desc("weight"), "word").select("word", "weight").collect())
        words = tuple((r.word, float(r.weight)) for r in kept)
        model["words"] = words
        model["exceptions"] = _exceptions(rows, words)
        model["curve"] = _curve(rows, model)
    rows.unpersist()
    return model


def _exceptions(rows: DataFrame, words: tuple, least: int = 3) -> tuple[str, ...]:
    lexicon = {w for w, _ in words}

    def run(batches):
        for batch in batches:
            out = []
            for text, y in zip(plain(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                parts = fold(text).split(" ")
                near = {f"{a} {b}" for a, b in zip(parts, parts[1:])
                        if a.strip(".,") in lexicon or b.strip(".,") in lexicon}
                out += [(y, p) for p in near if len(p) <= 80]
            yield out
    found = (map_rows(rows, "y int, pair string", run).groupBy("pair").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("q"))
        .where((F.col("q") >= least) & (F.col("p") == 0)).orderBy(F.desc("q"), "pair").limit(300))
    return tuple(r.pair for r in found.collect())


def _features(rows: DataFrame, model: dict) -> DataFrame:
    words, exceptions = model["words"], model["exceptions"]

    def run(batches):
        auto = matcher(words, exceptions)
        for batch in batches:
            yield [(y, *evidence(t, auto)) for t, y in
                   zip(plain(batch.column(0)), batch.column(1).to_pylist(), strict=True)]
    return map_rows(rows, "y int, total double, dense double", run)


def _curve(rows: DataFrame, model: dict) -> list[float]:
    """Logistic weights on (1, log(1 + total), log(1 + dense)), by Newton steps with a small
    ridge. On the log scale, a text with very many matches doesn't flatten the curve."""
    data = np.array(_features(rows, model).orderBy("y", "total", "dense").collect(), float)
    x, y = np.column_stack([np.ones(len(data)), np.log1p(data[:, 1:])]), data[:, 0]
    b = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        b += np.linalg.solve(h, x.T @ (y - p) - 1e-2 * b)
    return b.tolist()


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1) of each document."""
    words, exceptions = model["words"], model["exceptions"]
    curve, base = model["curve"], model["base"]

    def run(batches: Iterator[pa.RecordBatch]):
        auto = matcher(words, exceptions)
        for batch in batches:
            names, out = batch.schema.names, []
            for key, text in zip(batch.column(names.index("doc_id")).to_pylist(),
                                 plain(batch.column(names.index("text"))), strict=True):
                if curve is None:
                    out.append((key, base))
                    continue
                total, dense = evidence(text, auto)
                z = curve[0] + curve[1] * np.log1p(total) + curve[2] * np.log1p(dense)
                out.append((key, float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))))
            yield out
    return map_rows(docs.select("doc_id", "text"), "doc_id long, score double", run)
