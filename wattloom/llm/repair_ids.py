"""Token ids in files compressed by a Re-Pair grammar per block, with random access.

Documents are range-partitioned by doc_id and encoded in order. Runs of about `block_tokens`
ids form a block with its own grammar: rounds replace the most frequent pairs of neighbours
by new symbols. The pairs of one round share no symbol as both left and right part, so their
occurrences cannot overlap, and no pair crosses the end of a document. A block is one row of
a Parquet data set: rules, their expansion lengths, the compressed sequence, and for each
document its place in the sequence and in the ids. One document is decoded from its own part
of the sequence alone. Spark's writer commits the files, so a lost executor leaves no trace.

The tokenizers library encodes runs between spaces and line feeds, and each run once as long as
a table of bounded size remembers it; the tokenizer must drop white space between words. New
runs are normalized and cut together, and its model reads each piece of them once.

Defined results: null and empty text is the end id alone; a null doc_id comes first; rows
that repeat a doc_id stand next to each other, ordered by a hash of the text.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache
from itertools import chain, islice, repeat
from zlib import crc32

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm.texts import map_rows, plain, slices

BLOCK = ("part int, block int, before long, n_tokens long, doc_ids array<long>, "
         "doc_tokens array<long>, doc_symbols array<long>, base long, rules binary, "
         "rule_tokens binary, sequence binary")


def expanded(at: np.ndarray, ids: np.ndarray, ends: np.ndarray):
    """The ids of the entries `at`, one after the other, and where each one ends."""
    first = np.concatenate([[0], ends[:-1]])[at]
    n = ends[at] - first
    until = np.cumsum(n)
    return ids[np.repeat(first - until + n, n) + np.arange(until[-1])], until


class RunIds(dict):
    """Numbers of runs without white space, up to `limit` of them, and the ids of each run."""

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self[""] = 0
        self.pieces = {}
        self.ids, self.ends = array("i"), array("q", [0])  # of each run, one after the other
        self.piece_ids, self.piece_ends = array("i"), array("q")

    def _full(self) -> bool:
        return max(len(self), len(self.pieces), len(self.ids) // 8) >= self.limit

    def _bound(self) -> None:
        """Drop the later half of full tables; what is common was met early."""
        if self._full():
            kept = dict(islice(self.items(), self.limit // 2))
            self.clear()
            self.update(kept)
            del self.ends[max(kept.values(), default=0) + 1:]
            del self.ids[self.ends[-1]:]
            self.pieces = dict(islice(self.pieces.items(), self.limit // 2))
            del self.piece_ends[len(self.pieces):]
            del self.piece_ids[self.piece_ends[-1] if self.piece_ends else 0:]
        if self._full():
            self._forget()

    def _learn(self, runs: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.update(zip(runs, range(len(self.ends), len(self.ends) + len(runs)), strict=True))
        self.ends.frombytes((len(self.ids) + np.cumsum(sizes)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())

    def learn(self, runs: list[str]) -> None:
        """Encode runs that are not in the table. They pass the normalizer and the
        pre-tokenizer of the library in one text, and its model once for each piece."""
        tokenizer, pieces = self.tokenizer, None
        text = "\n".join(runs)
        together = runs if len(text.split()) == len(runs) and not any(
            t in text for t in self.added) else [
                r for r in runs if r.split() == [r] and not any(t in r for t in self.added)]
        if tokenizer.pre_tokenizer is not None and together:
            text = " ".join(together)
            if tokenizer.normalizer is not None:
                text = tokenizer.normalizer.normalize_str(text)
            blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32)
            if len(blanks) == len(together) - 1:
                pieces = tokenizer.pre_tokenizer.pre_tokenize_str(text)
        if pieces:
            names, spans = zip(*pieces, strict=True)
            starts = np.fromiter(chain.from_iterable(spans), np.int64, 2 * len(spans))[::2]
            model, known = tokenizer.model, self.pieces
            for name in set(names).difference(known):
                known[name] = len(self.piece_ends)
                self.piece_ids.extend([t.id for t in model.tokenize(name)])
                self.piece_ends.append(len(self.piece_ids))
            ids, until = expanded(
                np.fromiter(map(known.__getitem__, names), np.int64, len(names)),
                np.array(self.piece_ids, np.int32), np.array(self.piece_ends, np.int64))
            cuts = np.searchsorted(starts, np.append(blanks, len(text)))
            ends = np.concatenate([[0], until])[cuts]
            self._learn(together, ids, np.diff(ends, prepend=0))
            runs = [r for r in runs if r not in self]
        found = [e.ids for e in tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        self._learn(runs, np.array(list(chain.from_iterable(found)), np.int32),
                    np.array(list(map(len, found)), np.int64))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; runs that are new among the texts are encoded together."""
        self._bound()
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        sizes = list(map(len, cut))
        runs = list(chain.from_iterable(cut))
        del cut
        at = np.fromiter(map(self.get, runs, repeat(-1)), np.int64, len(runs))
        missing = np.flatnonzero(at < 0).tolist()
        new = list({runs[k] for k in missing})
        for k in range(0, len(new), 20_000):
            self.learn(new[k:k + 20_000])
        at[missing] = [self[runs[k]] for k in missing]
        ids, until = expanded(at, np.array(self.ids, np.int32), np.array(self.ends, np.int64))
        for run in new:
            if len(run) > 64:
                del self[run]
        return np.split(ids, until[np.cumsum(sizes) - 1])[:-1]


@lru_cache(maxsize=2)
def load(path: str) -> RunIds:
    return RunIds(path)


def compress(ids: np.ndarray, last: np.ndarray, base: int, rounds: int = 6,
             per_round: int = 2048, least: int = 8):
    """Sequence, rules (pairs), expansion lengths, and the ends of documents in the sequence.
    `last` marks the last id of each document."""
    seq, last = ids.astype(np.int64), last.copy()
    rules, lengths, symbol = [], np.ones(base, np.int64), base
    for _ in range(rounds):
        pair = (seq[:-1] << 32) | seq[1:]
        usable = ~last[:-1] & (seq[:-1] != seq[1:])
        keys, counts = np.unique(pair[usable], return_counts=True)
        often = np.flatnonzero(counts >= least)
        often = often[np.argsort(-counts[often], kind="stable")][:4 * per_round]
        lefts, rights, chosen = set(), set(), []
        for key in keys[often].tolist():
            a, b = key >> 32, key & 0xFFFFFFFF
            if a not in rights and b not in lefts:
                lefts.add(a)
                rights.add(b)
                chosen.append(key)
                if len(chosen) == per_round:
                    break
        if not chosen:
            break
        picked = np.sort(np.array(chosen, np.int64))
        starts, ends = np.zeros(symbol, bool), np.zeros(symbol, bool)
        starts[picked >> 32] = ends[picked & 0xFFFFFFFF] = True
        at = np.flatnonzero(starts[seq[:-1]] & ends[seq[1:]] & usable)
        place = np.minimum(np.searchsorted(picked, pair[at]), len(picked) - 1)
        same = picked[place] == pair[at]
        at = at[same]
        seq[at] = symbol + place[same]
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        a, b = picked >> 32, picked & 0xFFFFFFFF
        rules.append(np.stack([a, b], 1))
        lengths = np.concatenate([lengths, lengths[a] + lengths[b]])
        symbol += len(picked)
    made = np.concatenate(rules) if rules else np.empty((0, 2), np.int64)
    return seq, made, lengths[base:], np.flatnonzero(last) + 1


def expander(base: int, rules: np.ndarray, lengths: np.ndarray):
    """A function from a part of the sequence to its ids."""
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = np.empty(starts[-1], np.int64)

    def part(symbol: int) -> np.ndarray:
        k = symbol - base
        return np.array([symbol]) if k < 0 else flat[starts[k]:starts[k + 1]]
    for k, (a, b) in enumerate(rules.tolist()):
        flat[starts[k]:starts[k + 1]] = np.concatenate([part(a), part(b)])

    def expand(seq: np.ndarray) -> np.ndarray:
        ruled = seq >= base
        k = np.where(ruled, seq - base, 0)
        size = np.where(ruled, lengths[k] if len(lengths) else 1, 1)
        out = np.repeat(seq, size)
        first = np.repeat(np.where(ruled, starts[k], 0), size)
        inside = np.arange(len(out)) - np.repeat(np.cumsum(size) - size, size)
        deep = np.repeat(ruled, size)
        out[deep] = flat[(first + inside)[deep]]
        return out
    return expand


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
              block_tokens: int = 500_000) -> None:
    """Encode `docs` and write the blocks in ascending doc_id order."""
    def run(batches):
        ids_of, part = load(tokenizer), TaskContext.get().partitionId()
        block, before, held, keys, parts = 0, 0, 0, [], []

        def packed():
            ids = np.concatenate(parts)
            tokens = [len(p) for p in parts]
            last = np.zeros(len(ids), bool)
            last[np.cumsum(tokens) - 1] = True
            seq, rules, lengths, ends = compress(ids, last, ids_of.base)
            return (part, block, before, len(ids), list(keys), tokens,
                    np.diff(ends, prepend=0).tolist(), ids_of.base,
                    rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(),
                    seq.astype("<u4").tobytes())
        for batch in batches:
            names = batch.schema.names
            doc_ids = batch.column(names.index("doc_id")).to_pylist()
            texts = plain(batch.column(names.index("text")))
            for a, b in slices(texts):
                for key, ids in zip(doc_ids[a:b], ids_of.encode_all(texts[a:b]), strict=True):
                    keys.append(key)
                    parts.append(np.append(ids, np.int32(end_id)))
                    held += len(parts[-1])
                    if held >= block_tokens:
                        yield [packed()]
                        before, block, held, keys, parts = before + held, block + 1, 0, [], []
        if parts:
            yield [packed()]
    ties = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange("doc_id", ties).sortWithinPartitions("doc_id", ties))
    map_rows(ordered, BLOCK, run).write.mode("overwrite").parquet(path)


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and `ids` (or their `ids_crc32`), from the files alone.

    Only one total per written partition comes to the driver."""
    blocks = spark.read.parquet(path)
    totals = sorted(blocks.groupBy("part").agg(F.sum("n_tokens")).collect())
    first = dict(zip([t[0] for t in totals],
                     np.cumsum([0, *[t[1] for t in totals]])[:-1].tolist(), strict=True))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
                lengths = np.frombuffer(row["rule_tokens"], "<u4").astype(np.int64)
                expand = expander(row["base"], rules, lengths)
                seq = np.frombuffer(row["sequence"], "<u4").astype(np.int64)
                start, at, out = first[row["part"]] + row["before"], 0, []
                for key, n, symbols in zip(row["doc_ids"], row["doc_tokens"],
                                           row["doc_symbols"], strict=True):
                    ids = expand(seq[at:at + symbols])
                    if len(ids) != n:
                        raise ValueError(f"document {key}: {len(ids)} ids, {n} were written")
                    out.append((key, start, n, crc32(ids.astype("<u4").tobytes())
                                if digest else ids.tolist()))
                    start, at = start + n, at + symbols
                yield out
    kind = "ids_crc32 long" if digest else "ids array<int>"
    return map_rows(blocks, f"doc_id long, start long, n_tokens long, {kind}", run)
