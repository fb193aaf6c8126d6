"""Byte-level BPE by rank, with segment trees over byte positions, and its decoding.

Each match of the split pattern is merged separately. A leaf of the tree holds the rank of
the pair that starts at that byte, with the position as tie-break, so that the root names
the leftmost pair of the smallest rank. A merge unlinks one live part and updates the leaves
of its two neighbours, each in O(log n); a match of any length takes O(n log n). Matches of a
batch of texts that are new to a task merge in step: the trees of matches of similar length
are the rows of one array, and each step does one merge in every row.

Ranks come from a rank file that every task reads from the installed tokenizers package, or
from the path given. Tasks remember the ids of short matches, and of runs between white
space, in tables of bounded size.

Defined results: null and empty text has no ids; broken UTF-8 is read with replacement
characters; rows that repeat and null ids are encoded like any other row.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import map_arrow, map_rows, plain, slices

_NONE = np.int64(1 << 60)
_SHIFT = 28
_NO_ID = (1 << 20) - 1
#: Cells of the arrays that merge in step.
_CELLS = 1 << 17
#: Characters of the longest entry that is remembered.
_SHORT = 64
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs without white space, each with one space before it, and the white space between. No
#: match of a pattern crosses them if it takes white space other than that space only alone,
#: leaving the last character of a run before other text.
RUNS = rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


class ByteBpe:
    """Encoder and decoder for one rank table. `runs` may cut texts into parts that no match
    of `pattern` crosses; ids of a part are then found in one step."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, runs: str | None = None,
                 remembered: int = 500_000):
        self.split = regex.compile(pattern)
        self.runs = re.compile(runs) if runs else self.split
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.same = {rank: rank for rank in self.pieces}
        self.names = {rank: str(rank) for rank in self.pieces}
        self.remembered, self.memory, self.run_memory = remembered, {}, {}
        self.byte = np.array([ranks.get(bytes([b]), _NO_ID) for b in range(256)], np.int64)
        pairs = sorted(
            (ranks[piece[:k]] << 20 | ranks[piece[k:]], rank) for piece, rank in ranks.items()
            for k in range(1, len(piece)) if piece[:k] in ranks and piece[k:] in ranks)
        self.pair_keys = np.array([p[0] for p in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([p[1] for p in pairs] or [0], np.int64)
        self.whole = ranks

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tree values of the pairs of these ids that start at `at`."""
        key = left << 20 | right
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == key,
                        self.pair_ranks[place] << _SHIFT | at, _NONE)

    def _in_step(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """The ids of pieces of at most `width` bytes, a power of two."""
        m = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, m)
        ids = np.full((m, width + 1), _NO_ID, np.int64)
        held = np.arange(width) < sizes[:, None]
        ids[:, :width][held] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        place = np.arange(width + 1)
        after = np.tile(place + 1, (m, 1))
        before = np.tile(place - 1, (m, 1))
        tree = np.full((m, 2 * width), _NONE, np.int64)
        first = np.tile(place[:width], (m, 1))[held]
        tree[:, width:][held] = self._leaves(ids[:, :-1][held], ids[:, 1:][held], first)
        k = width
        while k > 1:
            tree[:, k // 2:k] = np.minimum(tree[:, k:2 * k:2], tree[:, k + 1:2 * k:2])
            k //= 2
        ids_, after_, before_, tree_ = (x.reshape(-1) for x in (ids, after, before, tree))
        rows = np.arange(m)
        while True:
            root = tree_[rows * (2 * width) + 1]
            going = root < _NONE
            if not going.any():
                break
            rows, root = rows[going], root[going]
            i, base, top = root & ((1 << _SHIFT) - 1), rows * (width + 1), rows * (2 * width)
            gone = after_[base + i]
            right = after_[base + gone]
            ids_[base + i] = root >> _SHIFT
            ids_[base + gone] = -1
            after_[base + i], before_[base + right] = right, i
            left = before_[base + i]
            near = np.where(left >= 0, left, i)
            tree_[top + width + gone] = _NONE
            tree_[top + width + i] = self._leaves(root >> _SHIFT, ids_[base + right], i)
            tree_[top + width + near] = self._leaves(
                ids_[base + near], ids_[base + after_[base + near]], near)
            for k in (gone, i, near):
                k = (width + k) >> 1
                while k[0]:
                    both = top + 2 * k
                    tree_[top + k] = np.minimum(tree_[both], tree_[both + 1])
                    k >>= 1
        live = (ids[:, :width] >= 0) & held
        # One object per id, however many entries hold it, stays in the processor's cache.
        flat = list(map(self.same.__getitem__, ids[:, :width][live].tolist()))
        ends = np.cumsum(live.sum(1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each match."""
        out, widths = [()] * len(pieces), {}
        for at, piece in enumerate(pieces):
            rank = self.whole.get(piece)
            if rank is not None:
                out[at] = (self.same[rank],)
            elif piece:
                widths.setdefault(1 << (len(piece) - 1).bit_length(), []).append(at)
        for width, places in widths.items():
            rows = max(1, _CELLS // width)
            for k in range(0, len(places), rows):
                some = places[k:k + rows]
                for at, ids in zip(some, self._in_step([pieces[p] for p in some], width),
                                   strict=True):
                    out[at] = ids
        return out

    def _forget(self, memory: dict) -> None:
        if len(memory) >= self.remembered:
            memory.clear()

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        self._forget(self.memory)
        self._forget(self.run_memory)
        cut = [self.runs.findall(text) for text in texts]
        new = set(chain.from_iterable(cut)).difference(self.run_memory)
        matches = {run: self.split.findall(run) for run in new}
        pieces = list(set(chain.from_iterable(matches.values())).difference(self.memory))
        ids_of = self.memory
        ids_of.update(zip(pieces, self.merge([p.encode("utf-8") for p in pieces]), strict=True))
        known = self.run_memory
        for run, found in matches.items():
            known[run] = (ids_of[found[0]] if len(found) == 1 else
                          tuple(chain.from_iterable(map(ids_of.__getitem__, found))))
        for runs in cut:
            yield list(chain.from_iterable(map(known.__getitem__, runs)))
        for memory, added in ((ids_of, pieces), (known, new)):
            for entry in added:
                if len(entry) > _SHORT:
                    del memory[entry]

    def encode(self, text: str) -> list[int]:
        return list(self.encode_all([text]))[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str, pattern: str, runs: str | None = None) -> ByteBpe:
    with open(path, "rb") as lines:
        rows = [line.split() for line in lines if line.strip()]
    return ByteBpe({base64.b64decode(a): int(b) for a, b in rows}, pattern, runs)


def encode_documents(docs: DataFrame, path: str, pattern: str,
                     runs: str | None = None) -> DataFrame:
    """The rows and columns of `docs` with `token_ids` (array of int)."""
    docs = docs.drop("token_ids")
    schema = docs.withColumn("token_ids", F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern, runs)
        for batch in batches:
            texts = plain(batch.column(batch.schema.get_field_index("text")))
            for a, b in slices(texts):
                ids = pa.array(list(bpe.encode_all(texts[a:b])), pa.list_(pa.int32()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids], names=[*part.schema.names, "token_ids"])
    return map_arrow(docs, run, schema)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of `encoded` (doc_id, token_ids) as doc_id and `decoded` bytes."""
    def run(batches):
        bpe = load(path, pattern)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("token_ids")).to_pylist()
            keys = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            yield [(k, bpe.decode(x or [])) for k, x in zip(keys, ids, strict=True)]
    return map_rows(encoded.select("doc_id", "token_ids"), "doc_id long, decoded binary", run)


def digests(docs: DataFrame, path: str, pattern: str, runs: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the bytes decoded from them."""
    def run(batches):
        bpe = load(path, pattern, runs)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            texts = plain(batch.column(batch.schema.get_field_index("text")))
            for a, b in slices(texts):
                yield [(key, len(ids),
                        sha256(" ".join(map(bpe.names.__getitem__, ids)).encode()).hexdigest(),
                        sha256(bpe.decode(ids)).hexdigest())
                       for key, ids in zip(keys[a:b], bpe.encode_all(texts[a:b]), strict=True)]
    return map_rows(docs.select("doc_id", "text"), "doc_id long, n_tokens long, "
                    "ids_sha256 string, decoded_sha256 string", run)
