"""Token counts under a unigram model, by dynamic programming over a shared trie.

The distinct pre-tokens (runs without white space, led by the word mark) that are new in a slice
of texts are sorted, so that words that share a prefix stand together, and their trie grows in
NumPy one character of all of them at a time. A node has the best forward score of its prefix
and the number of pieces on that path, both found once for all words below it. It also has the
places where a piece begun before it may still go on, each with its node in a second trie, of
the pieces; so a node costs as many steps as there are such places. The count at a word's last
node is its token count. Counts are remembered for up to `limit` words, of which the first half
outlives the rest; words of more than 64 characters are counted alone and not remembered.

Piece scores are -log(rank + 2) over the pieces in file order. A character without a piece
costs one token per UTF-8 byte. Equal scores are settled by fewer pieces.

Defined results: null and empty text has no words and no tokens; each row gets a row.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain, islice
from math import log

import numpy as np
from pyspark.sql import DataFrame

from wattloom.llm.texts import map_rows, plain, slices

MARK = "▁"
#: Characters of the longest word, with its mark, that is counted with others.
_SHORT = 64


def _bytes(codes: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)


class ForwardTrie:
    def __init__(self, scores: dict[str, float], limit: int = 400_000):
        self.limit = limit
        self.unknown = min(scores.values(), default=0.0) - 10.0
        symbols = {c: k for k, c in enumerate(sorted(set(chain.from_iterable(scores))), 1)}
        self.symbol = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.symbol[list(map(ord, symbols))] = list(symbols.values())
        # Nodes of the trie of pieces: 0 is its root; a step is named by node and symbol.
        self.n_symbols, self.steps, ends = len(symbols) + 1, {}, {}
        for piece, score in scores.items():
            node = 0
            for char in piece:
                step = node * self.n_symbols + symbols[char]
                node = self.steps.setdefault(step, len(self.steps) + 1)
            ends[node] = score
        self.score = np.full(len(self.steps) + 1, -np.inf)
        self.score[list(ends)] = list(ends.values())
        keys = np.array(sorted(self.steps) or [-1], np.int64)
        self.keys, self.to = keys, np.array([self.steps.get(k, 0) for k in keys.tolist()])
        self.inner = np.zeros(len(self.score), bool)  # nodes with nodes below
        self.inner[keys // self.n_symbols] = True
        self.first = np.zeros(self.n_symbols, np.int64)
        top = (keys >= 0) & (keys < self.n_symbols)
        self.first[keys[top]] = self.to[top]
        self.ends: dict[str, int] = {}

    def _alone(self, text: str) -> int:
        """Pieces on the best path of one text."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        best, fewest, open_ = 0.0, 0, []
        for symbol, size in zip(self.symbol[codes].tolist(), _bytes(codes).tolist(), strict=True):
            open_.append((0, best, fewest))
            best, fewest, further = best + self.unknown * size, fewest + size, []
            for node, score, count in open_:
                node = self.steps.get(node * self.n_symbols + symbol)
                if node is not None:
                    further.append((node, score, count))
                    score += self.score[node]
                    if score > best or score == best and count + 1 < fewest:
                        best, fewest = score, count + 1
            open_ = further
        return fewest

    def _together(self, texts: list[str]) -> np.ndarray:
        """The same of each of the sorted texts."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        starts, counts = np.cumsum(sizes) - sizes, np.zeros(len(texts), np.int64)
        live = np.flatnonzero(sizes)
        node = np.zeros(len(live), np.int64)  # of each live text
        score, fewest = np.zeros(1), np.zeros(1, np.int64)  # of each node
        # Open places, by the node that has them: node of pieces, score and count before it.
        has, at, since, before = (np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0),
                                  np.empty(0, np.int64))
        for place in range(int(sizes.max(initial=0))):
            code = codes[starts[live] + place].astype(np.int64)
            new = np.ones(len(live), bool)
            new[1:] = (node[1:] != node[:-1]) | (code[1:] != code[:-1])
            above, code = node[new], code[new]
            node = np.cumsum(new) - 1
            symbol, size, n = self.symbol[code], _bytes(code), len(above)
            # Each place of the node above, once for each node below it.
            many = has[above]
            owner = np.repeat(np.arange(n), many)
            old = np.repeat((np.cumsum(has) - has)[above] - (np.cumsum(many) - many), many)
            old += np.arange(len(old))
            key = at[old] * self.n_symbols + symbol[owner]
            step = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[step] == key
            old, owner, step = old[goes], owner[goes], self.to[step[goes]]
            # And the piece that begins with this character.
            begun = self.first[symbol]
            begins = np.flatnonzero(begun)
            owner = np.concatenate([owner, begins])
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            at = np.concatenate([step, begun[begins]])[order]
            since = np.concatenate([since[old], score[above[begins]]])[order]
            before = np.concatenate([before[old], fewest[above[begins]]])[order]
            score, fewest = score[above] + self.unknown * size, fewest[above] + size
            whole = np.flatnonzero(self.score[at] > -np.inf)
            if len(whole):
                of = owner[whole]
                first = np.flatnonzero(np.diff(of, prepend=-1))
                reached, pieces = since[whole] + self.score[at[whole]], before[whole] + 1
                best = np.maximum.reduceat(reached, first)
                least = np.minimum.reduceat(np.where(
                    reached == np.repeat(best, np.diff(first, append=len(of))), pieces,
                    np.iinfo(np.int64).max), first)
                of = of[first]
                fewest[of] = np.where(best > score[of], least, np.where(
                    best == score[of], np.minimum(least, fewest[of]), fewest[of]))
                score[of] = np.maximum(best, score[of])
            further = self.inner[at]
            owner, at, since, before = (x[further] for x in (owner, at, since, before))
            has = np.bincount(owner, minlength=n)
            done = sizes[live] == place + 1
            counts[live[done]] = fewest[node[done]]
            live, node = live[~done], node[~done]
        return counts

    def count_all(self, texts: list[list[str]]) -> list[int]:
        """Pieces on the best paths of the pre-tokens of each text."""
        if len(self.ends) >= self.limit:
            self.ends = dict(islice(self.ends.items(), self.limit // 2))
        known = self.ends
        new = set(chain.from_iterable(texts)).difference(known)
        long = [w for w in new if len(w) >= _SHORT]
        short = sorted(new.difference(long))
        known.update(zip(short, self._together([MARK + w for w in short]).tolist(), strict=True))
        known.update((w, self._alone(MARK + w)) for w in long)
        counts = [sum(map(known.__getitem__, words)) for words in texts]
        for word in long:
            del known[word]
        return counts

    def count(self, word: str) -> int:
        """Pieces on the best path of one pre-token."""
        return self.count_all([[word]])[0]


@lru_cache(maxsize=2)
def load(model: str) -> ForwardTrie:
    from sentencepiece import SentencePieceProcessor
    pieces = SentencePieceProcessor(model_file=model)
    return ForwardTrie({pieces.id_to_piece(i): -log(i + 2) for i in range(len(pieces))
                        if not (pieces.is_control(i) or pieces.is_unknown(i)
                                or pieces.is_byte(i))})


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_words and n_tokens of each document."""
    def run(batches):
        trie = load(model)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            texts = plain(batch.column(batch.schema.get_field_index("text")))
            for a, b in slices(texts, most=1000):
                cut = [text.split() for text in texts[a:b]]
                yield [(key, len(words), n) for key, words, n in
                       zip(keys[a:b], cut, trie.count_all(cut), strict=True)]
    return map_rows(docs.select("doc_id", "text"), "doc_id long, n_words long, n_tokens long",
                    run)
