"""Find and remove passages of benchmark items in documents.

The items' windows (runs of `size` words; a shorter item is one window) are hashed, sorted
and broadcast. Each task hashes the word windows of a document, looks them up, and compares
the words of every match with those of the item. Only `slice_windows` windows are broadcast
at a time: a larger benchmark is cut by item into slices, and the documents pass through one
map step per slice, still without a shuffle.

Defined results: null and empty text have no words; null item text gives no window; items
that repeat count once for each item_id; a null item_id gives no window. Every hit word is
marked once, however many windows cover it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import map_arrow, raw, window_hashes, word_hashes

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Bytes of words as they are, A-Z in lower case, all other ASCII as a space.
FOLD = bytes(c if c >= 128 or c in _ALNUM else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def item_words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def _slices(items: DataFrame, size: int, slice_windows: int) -> Iterator[dict]:
    """Windows by length: hash -> {words: item ids}, at most `slice_windows` or one item."""
    rows = (items.where("item_id is not null and text is not null")
            .select(F.col("item_id").cast("string"), F.col("text").cast("string"))
            .distinct().toLocalIterator())
    found, held = defaultdict(lambda: defaultdict(lambda: defaultdict(set))), 0
    for item, text in rows:
        words = item_words(text.encode("utf-8", "replace"))
        if not words:
            continue
        long = min(size, len(words))
        hashes = window_hashes(word_hashes(b" ".join(words)), long).tolist()
        for i, h in enumerate(hashes):
            found[long][h][b" ".join(words[i:i + long])].add(item)
        held += len(hashes)
        if held >= slice_windows:
            yield {n: {h: dict(w) for h, w in at.items()} for n, at in found.items()}
            found, held = defaultdict(lambda: defaultdict(lambda: defaultdict(set))), 0
    # The last slice, or an empty one for a benchmark without windows.
    yield {n: {h: dict(w) for h, w in at.items()} for n, at in found.items()}


def mark(docs: DataFrame, items: DataFrame, size: int = 10,
         slice_windows: int = 2_000_000) -> DataFrame:
    """`docs` with `_words` (count), `_hits` (positions of hit words) and `_items` (ids)."""
    out = docs.withColumns({"_words": F.lit(0).cast("long"),
                            "_hits": F.array().cast("array<int>"),
                            "_items": F.array().cast("array<string>")})
    schema = out.schema
    for windows in _slices(items, size, slice_windows):
        shared = docs.sparkSession.sparkContext.broadcast(windows)

        def scan(batches, shared=shared):
            table = [(n, np.array(sorted(at), np.uint64), at) for n, at in shared.value.items()]
            for batch in batches:
                names = batch.schema.names
                texts = raw(batch.column(names.index("text")))
                hits = batch.column(names.index("_hits")).to_pylist()
                ids = batch.column(names.index("_items")).to_pylist()
                counts = []
                for row, text in enumerate(texts):
                    folded = text.translate(FOLD) if text else b""
                    h, words = word_hashes(folded), None
                    counts.append(len(h))
                    at_words, at_items = set(hits[row]), set(ids[row])
                    for n, keys, at in table:
                        w = window_hashes(h, n)
                        if not len(w):
                            continue
                        place = np.minimum(np.searchsorted(keys, w), len(keys) - 1)
                        for i in np.flatnonzero(keys[place] == w).tolist():
                            words = words or folded.split()
                            owners = at[int(w[i])].get(b" ".join(words[i:i + n]))
                            if owners:
                                at_words.update(range(i, i + n))
                                at_items.update(owners)
                    hits[row], ids[row] = sorted(at_words), sorted(at_items)
                columns = dict(zip(names, batch.columns, strict=True))
                columns["_words"] = pa.array(counts, pa.int64())
                columns["_hits"] = pa.array(hits, pa.list_(pa.int32()))
                columns["_items"] = pa.array(ids, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
        out = map_arrow(out, scan, schema)
    return out


def _cut(text: bytes, hits: list[int]) -> bytes:
    """The text without the bytes from the first to the last word of each run of hits."""
    folded, spans, at = text.translate(FOLD), [], 0
    for word in folded.split():
        at = folded.index(word, at)
        spans.append((at, at + len(word)))
        at += len(word)
    out, done, i = [], 0, 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
            j += 1
        out.append(text[done:spans[hits[i]][0]])
        done = spans[hits[j]][1]
        i = j + 1
    return b"".join(out) + text[done:]


def remove_spans(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """`docs` with the hit spans cut out of `text`; a document left without a word goes."""
    marked = mark(docs, items, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = raw(batch.column(names.index("text")))
            for i, hits in enumerate(batch.column(names.index("_hits")).to_pylist()):
                if hits:
                    texts[i] = _cut(texts[i], hits)
            columns = list(batch.columns)
            at = names.index("text")
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    whole = F.size("_hits") >= F.greatest(F.col("_words"), F.lit(1))
    return map_arrow(marked.where(~whole), run, marked.schema).select(*docs.columns)
