"""Phrases of words that occur together, counted through FM-indexes of shards.

Texts are cut into pieces at punctuation and line ends and into words at blanks. A task
gathers the word ids of the texts of one language, up to `shard_words`, into a shard and
indexes it in both directions: the Burrows-Wheeler transform of the ids in the order of their
contexts, and the same of the reversed ids. Contexts are compared as deep as a pattern gets
before its last extension, which is all that intervals of short patterns need. A pattern is
a pair of intervals of one size; extending it to the left reads the symbols of its forward
interval, to the right those of its backward interval, and moves the other interval by the
number of smaller symbols. All patterns of a length are extended at once in NumPy. Intervals
give exact counts, and sums over shards are exact however the texts are dealt to shards, so
a round may index anew what a lost executor held.

A phrase is frequent only if all its parts are. So the lengths are counted one after the
other, and a round extends only into phrases whose parts may be frequent. That is read from
a bitmap of hashes of `1 << bits` bits, whatever the corpus; equal hashes only let more
phrases through. What is summed are the phrases themselves.

Defined results: null text has no words, null lang is `und`; empty tables give no phrases;
rows that repeat, also with one doc_id, each count. Other columns are not read. Words are
bytes without blanks, so broken UTF-8 passes through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import map_arrow, mix, raw, stored, word_hashes

LONGEST = 4
DEPTH = LONGEST - 1
SENT = 1 << 16  # phrases that a task hands over at a time
_FOLD = bytearray(range(256))
_FOLD[65:91] = range(97, 123)
for _end in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_end] = 10
_FOLD[9] = 32
_FOLD = bytes(_FOLD)


class Shard:
    """Word ids of texts of one language; id 0 ends a piece."""

    def __init__(self):
        self.ids_of = defaultdict()
        self.ids_of.default_factory = self.ids_of.__len__
        self.ids_of[b"\n"], self.ids_of[b""] = 0, 1
        self.parts, self.held = [], 0

    def add(self, text: bytes) -> int:
        tokens = text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        ids = np.fromiter(map(self.ids_of.__getitem__, tokens), np.int32, len(tokens))
        ids = ids[ids != 1]
        self.parts.append(np.maximum(ids - 1, 0))
        self.held += len(ids)
        return len(ids)

    def words(self) -> list[bytes]:
        return list(self.ids_of)[2:]

    def ids(self) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.int32), *self.parts])


@dataclass
class Patterns:
    """Patterns of one length: their words (one row each), intervals and counts."""

    words: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    count: np.ndarray

    def where(self, keep: np.ndarray) -> Patterns:
        return Patterns(self.words[keep], self.forward[keep], self.backward[keep],
                        self.count[keep])


def _transform(ids: np.ndarray, n_symbols: int, step: int) -> np.ndarray:
    """The symbol before each position, in the order of the DEPTH symbols from there on; `step`
    -1 reads the ids backwards. Ids start and end with 0, so that the ends may be joined."""
    key = ids.astype(np.int64)
    for k in range(1, DEPTH):
        key *= n_symbols
        key += np.roll(ids, -step * k)
    return np.roll(ids, step)[np.argsort(key)]  # rows of one context may be in any order


class FmIndex:
    """Both transforms of a shard. Symbols are 0 and the words 1 .. n_symbols - 1."""

    def __init__(self, ids: np.ndarray, n_symbols: int):
        if n_symbols ** DEPTH >= 1 << 63:
            raise ValueError("too many different words in a shard")
        self.forward = _transform(ids, n_symbols, 1)
        self.backward = _transform(ids, n_symbols, -1)
        self.counts = np.bincount(ids, minlength=n_symbols)
        self.first = np.cumsum(self.counts) - self.counts

    def single(self) -> Patterns:
        words = np.arange(1, len(self.counts))
        return Patterns(words[:, None], self.first[1:], self.first[1:], self.counts[1:])

    def extend(self, p: Patterns, left: bool, further: bool) -> Patterns:
        """Every extension of the patterns by a word, with its number of occurrences. The side
        that grows has intervals only if it grows `further`."""
        symbols = self.forward if left else self.backward
        lows = p.forward if left else p.backward
        starts = np.cumsum(p.count) - p.count
        rows = np.repeat((lows - starts).astype(np.int32), p.count)
        rows += np.arange(len(rows), dtype=np.int32)
        key = np.repeat(np.arange(len(lows)) * len(self.counts), p.count)
        key += symbols[rows]
        if further:
            order = np.argsort(key)
            rows, key = rows[order], key[order]
            del order
        else:
            key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        count = np.diff(new, append=len(key))
        owner, symbol = np.divmod(key[new], len(self.counts))
        del key
        grown = np.zeros_like(new)
        if further and len(new):
            grown = self._follow(symbols)[np.minimum.reduceat(rows, new)]
        del rows
        word = symbol > 0
        new, count, owner, symbol, grown = (
            x[word] for x in (new, count, owner, symbol, grown))
        # Within the other interval, extensions by smaller symbols come first.
        beside = (p.backward if left else p.forward)[owner] + new - starts[owner]
        parts = (symbol[:, None], p.words[owner]) if left else (p.words[owner], symbol[:, None])
        return Patterns(np.hstack(parts), *((grown, beside) if left else (beside, grown)), count)

    @staticmethod
    def _follow(symbols: np.ndarray) -> np.ndarray:
        """Row in the same order of the context that starts with a row's symbol."""
        n = len(symbols)
        key = symbols * np.int64(n)
        key += np.arange(n)
        to = np.empty(n, np.int32)
        to[np.argsort(key)] = np.arange(n, dtype=np.int32)
        return to


def phrase_hashes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A hash of each row of word ids, from the hashes of the words."""
    out = np.full(len(words), words.shape[1], np.uint64)
    for column in words.T:
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[column - 1]
    return mix(out)


def _lang(column: str = "lang") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("und"))


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[bytes, Shard]]:
    """Shards of at most `most` ids and one text. All open shards of a task hold at most twice
    as many, and one text."""
    open_, held = {}, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, text in zip(raw(part.column(0)), raw(part.column(1)), strict=True):
                shard = open_.setdefault(lang, Shard())
                held += shard.add(text or b"")
                full = [lang] if shard.held >= most else []
                for key in full or (list(open_) if held >= 2 * most else []):
                    held -= open_[key].held
                    yield key, open_.pop(key)
    while open_:
        yield open_.popitem()


def _each_shard(docs: DataFrame, schema: str, most: int,
                rows: Callable[[bytes, Shard], Iterator[dict]]) -> DataFrame:
    def run(batches):
        for lang, shard in _shards(batches, most):
            for columns in rows(lang, shard):
                yield pa.RecordBatch.from_pydict(columns)
    return map_arrow(docs.select(_lang().alias("lang"), F.col("text").cast("string")), run, schema)


def _strings(values: pa.Array) -> pa.Array:
    return pc.cast(values, pa.string(), safe=False)  # broken UTF-8 stays as it is


def _repeated(lang: bytes, n: int) -> pa.Array:
    return _strings(pa.array([lang], pa.binary()).take(pa.array(np.zeros(n, np.int32))))


def word_counts(docs: DataFrame, shard_words: int) -> DataFrame:
    """lang, phrase (one word) and n."""
    def rows(lang, shard):
        words = shard.words()
        if words:
            counts = np.bincount(shard.ids(), minlength=len(words) + 1)[1:]
            yield {"lang": _repeated(lang, len(words)),
                   "phrase": _strings(pa.array(words, pa.binary())), "n": counts}
    return (_each_shard(docs, "lang string, phrase string, n long", shard_words, rows)
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))


def _lang_hash(lang: bytes) -> np.uint64:
    return word_hashes(b"x" + lang.translate(None, b" \t\n\x0b\x0c\r"))[0]


def _hashes(lang: bytes, words: list[bytes]) -> np.ndarray:
    return mix(word_hashes(b" ".join(words)) ^ _lang_hash(lang))


class Bitmap:
    """Which hashes may be among those given: their first bits index a bitmap."""

    def __init__(self, hashes: DataFrame, bits: int):
        self.bits = bits
        top = F.shiftrightunsigned("hash", 64 - bits)
        cells = (hashes.select(F.shiftright(top, 6).alias("cell"),
                               top.bitwiseAND(F.lit(63)).cast("int").alias("at"))
                 .groupBy("cell").agg(F.expr("bit_or(shiftleft(1L, at))").alias("held")))
        got = cells.toArrow()  # at most 1 << (bits - 6) rows of two numbers
        held = np.zeros(1 << (bits - 6), np.int64)
        held[got["cell"].to_numpy()] = got["held"].to_numpy()
        self.shared = hashes.sparkSession.sparkContext.broadcast(held)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        top = hashes >> np.uint64(64 - self.bits)
        cells = self.shared.value[(top >> np.uint64(6)).astype(np.int64)].view(np.uint64)
        return (cells >> (top & np.uint64(63)) & np.uint64(1)).astype(bool)


class Search:
    """Phrases of a shard whose parts may be frequent, by length, with the bitmaps so far."""

    def __init__(self, lang: bytes, shard: Shard, maps: list[Bitmap]):
        vocabulary = shard.words()
        self.hashes = _hashes(lang, vocabulary)
        self.spelled = pa.array(vocabulary, pa.binary())
        self.maps, ids = maps, shard.ids()
        shard.parts.clear()
        shard.ids_of.clear()
        self.index = FmIndex(ids, len(vocabulary) + 1)

    def _may(self, words: np.ndarray) -> np.ndarray:
        """Whether phrases of a length that has a bitmap may be frequent."""
        width = words.shape[1]
        if width > len(self.maps):
            return np.ones(len(words), bool)
        hashes = self.hashes[words[:, 0] - 1] if width == 1 else phrase_hashes(words, self.hashes)
        return self.maps[width - 1].has(hashes)

    def lengths(self, longest: int) -> Iterator[Patterns]:
        """Patterns of 2 to `longest` words, grown to the left and to the right in turn."""
        found = self.index.single()
        found = found.where(self._may(found.words))
        for width in range(2, longest + 1):
            left = width % 2 == 0
            found = self.index.extend(found, left, further=longest >= width + 2)
            other = found.words[:, :-1] if left else found.words[:, 1:]
            found = found.where(self._may(other))
            found = found.where(self._may(found.words))
            yield found

    def phrases(self, found: Patterns) -> pa.Array:
        columns = [self.spelled.take(pa.array(c - 1)) for c in found.words.T]
        return _strings(pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())))


def _names(phrases: DataFrame, width: int) -> DataFrame:
    """The hashes of phrases of one length."""
    def run(batches):
        for batch in batches:
            by_lang = defaultdict(list)
            for lang, phrase in zip(raw(batch.column(0)), raw(batch.column(1)), strict=True):
                by_lang[lang].append(phrase)
            found = [np.empty(0, np.uint64)]
            for lang, each in by_lang.items():
                hashes = _hashes(lang, each)
                found.append(hashes if width == 1 else phrase_hashes(
                    np.arange(1, len(hashes) + 1).reshape(-1, width), hashes))
            yield pa.RecordBatch.from_pydict({"hash": np.concatenate(found).view(np.int64)})
    return map_arrow(phrases.select("lang", "phrase"), run, "hash long")


def phrase_counts(docs: DataFrame, least: int = 30, shard_words: int = 1_000_000,
                  bits: int = 26) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, width, n) of all phrases of 1 to LONGEST words that occur `least` times
    or more in their language, and (lang, n) with the number of all words."""
    words = stored(word_counts(docs, shard_words), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    maps, parts = [], [frequent.select("lang", "phrase", F.lit(1).alias("width"), "n")]
    for width in range(2, LONGEST + 1):
        maps.append(Bitmap(_names(frequent, width - 1), bits))

        def counts(lang, shard, width=width, maps=tuple(maps)):
            search = Search(lang, shard, maps)
            for found in search.lengths(width):
                pass
            for at in range(0, len(found.count), SENT):
                part = found.where(slice(at, at + SENT))
                yield {"lang": _repeated(lang, len(part.count)),
                       "phrase": search.phrases(part), "n": part.count}
        counted = _each_shard(docs, "lang string, phrase string, n long", shard_words, counts)
        frequent = stored(counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                          .where(F.col("n") >= least), "phrases")
        parts.append(frequent.select("lang", "phrase", F.lit(width).alias("width"), "n"))
    for bitmap in maps:
        bitmap.shared.unpersist()
    return reduce(DataFrame.unionByName, parts), totals


def collocations(docs: DataFrame, top: int = 2000, least: int = 30, cover: int = 80,
                 shard_words: int = 1_000_000) -> DataFrame:
    """Each language's first `top` phrases of 2 to LONGEST words by cohesion.

    A cut after k words compares the phrase with its two parts, floor(2000000 a / (l + r)); the
    weakest cut counts. A phrase inside a longer one that has at least `cover` percent of its
    occurrences is left out. `left_words` and `right_words` count the words that extend the
    phrase to a frequent one."""
    phrases, totals = phrase_counts(docs, least, shard_words)
    words = F.split("phrase", " ")
    longer = phrases.where("width >= 2")

    def part(start: str, size: str) -> str:
        return f"array_join(slice(w, {start}, {size}), ' ')"
    cuts = longer.withColumn("w", words).select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.expr(
            f"transform(sequence(1, width - 1), k -> struct(k, {part('1', 'k')} AS head, "
            f"{part('k + 1', 'width - k')} AS tail))")).alias("cut")).select(
        "lang", "phrase", "a", "cut.*")
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    weakest = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
               .withColumn("score", F.expr("(cast(a AS decimal(20,0)) * 2000000)"
                                           " div (cast(l AS decimal(20,0)) + r)"))
               .groupBy("lang", "phrase", "a")
               .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inside = (longer.where("width >= 3").withColumn("w", words).select("lang", "n", "width", F.explode(
        F.expr(f"flatten(transform(sequence(2, width - 1), m -> transform(sequence(1, width - m + 1),"
               f" i -> struct(i, m, {part('i', 'm')} AS phrase))))")).alias("s"))
        .groupBy("lang", "s.phrase").agg(
            F.max("n").alias("most"),
            F.count_if(F.expr("s.m = width - 1 AND s.i = 2")).alias("left_words"),
            F.count_if(F.expr("s.m = width - 1 AND s.i = 1")).alias("right_words")))
    kept = (weakest.join(inside, ["lang", "phrase"], "left")
            .where(F.expr("most IS NULL OR cast(most AS decimal(20,0)) * 100"
                          f" < cast(a AS decimal(20,0)) * {cover}"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("left_words", "right_words")]))
    best = "ORDER BY score DESC, a DESC, phrase"
    # First within shares of a language, so that no task sorts all of its phrases.
    shares = kept.withColumn("_nth", F.expr(
        f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), 64) {best})")
    ).where(F.col("_nth") <= top).drop("_nth")
    ranked = shares.withColumn("rank", F.expr(
        f"cast(row_number() OVER (PARTITION BY lang {best}) AS long)")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", "left_words", "right_words")
