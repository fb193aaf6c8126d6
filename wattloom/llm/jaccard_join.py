"""Documents whose word-shingle sets have a high Jaccard similarity, and their components.

The join is a sparse product of the document-by-shingle incidence matrix with its transpose,
in blocks of shingles (the partitions of the join). Bounds from the set sizes keep it small:
of a set of n shingles only the first n - ceil(t n) + 1 in a common order enter, the products
are summed per pair, and a pair stays only if that sum plus all that can lie beyond the two
prefixes reaches the overlap the threshold needs. Pairs that stay are compared in full.

The order puts shingles that very many sets hold last. Any order gives the same links, so
the list of these may be bounded (`demoted`). Rows with equal sets are one node. In shingles
that many nodes share, each node is first compared with one pivot, whose group it then
joins; only pairs between different groups are multiplied, so a group of n near copies costs
n comparisons. Links within a group cannot change its component.

Defined results: null, empty and blank text have no shingles and are linked with nothing; a
text shorter than the shingle is one shingle; rows with a null doc_id are left out; rows
that repeat a doc_id each get a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import freed, map_arrow, map_rows, mix, raw, stored, window_hashes, word_hashes

_KEY_BITS = 48


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Distinct shingle keys in ascending order."""
    words = word_hashes(text.lower()) if text else ()
    if not len(words):
        return np.empty(0, np.uint64)
    h = window_hashes(words, min(size, len(words)))
    return np.unique(h >> np.uint64(64 - _KEY_BITS))


def signature(keys: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    mixed = mix(keys + np.uint64(0x1234567))
    both = mixed.sum() + mix(np.bitwise_xor.reduce(mixed, keepdims=True) + np.uint64(len(keys)))
    return int(mix(both).view(np.int64)[0])


def _needed(x: Column, y: Column, percent: int) -> Column:
    """The smallest overlap that links sets of these sizes."""
    return F.ceil((x + y) * percent / F.lit(100 + percent))


def _prefix(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _arrow(df: DataFrame, schema: str, rows) -> DataFrame:
    """`rows` maps the texts of a batch to equally long NumPy columns."""
    def run(batches):
        for batch in batches:
            texts = raw(batch.column(batch.schema.get_field_index("text")))
            for i in range(0, len(texts), 1000):
                yield pa.RecordBatch.from_pydict(rows(texts[i:i + 1000]))
    return map_arrow(df.select("text"), run, schema)


def _common(docs: DataFrame, size: int, many: int, demoted: int) -> np.ndarray:
    """The most frequent of the lower three tenths of all keys, at most `demoted` of them."""
    bound = np.uint64(3 * (1 << _KEY_BITS) // 10)

    def low(texts):
        found = [k[k < bound] for k in (shingles(t, size) for t in texts)]
        return {"key": np.concatenate(found).astype(np.int64)}
    top = (_arrow(docs, "key long", low).groupBy("key").count().where(F.col("count") > many)
           .orderBy(F.desc("count"), "key").limit(demoted).select("key"))
    return np.array(sorted(r[0] for r in top.collect()), np.uint64)


def _index(docs: DataFrame, size: int, percent: int, common: np.ndarray) -> DataFrame:
    """key, node, n: the prefix of each set."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def prefixes(texts):
        last, keys, nodes, sizes = shared.value, [], [], []
        for text in texts:
            found = shingles(text, size)
            n = len(found)
            if not n:
                continue
            if len(last):
                late = last[np.minimum(np.searchsorted(last, found), len(last) - 1)] == found
                ordered = np.concatenate([found[~late], found[late]])
            else:
                ordered = found
            head = ordered[:_prefix(n, percent)]
            keys.append(head)
            nodes.append(np.full(len(head), signature(found), np.int64))
            sizes.append(np.full(len(head), n, np.int32))
        if not keys:
            return {"key": np.empty(0, np.int64), "node": np.empty(0, np.int64),
                    "n": np.empty(0, np.int32)}
        return {"key": np.concatenate(keys).astype(np.int64), "node": np.concatenate(nodes),
                "n": np.concatenate(sizes)}
    return _arrow(docs, "key long, node long, n int", prefixes)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """node and its keys, six bytes each."""
    def pack(texts):
        found = [k for k in (shingles(t, size) for t in texts) if len(k)]
        return {"node": np.array([signature(k) for k in found], np.int64),
                "keys": pa.array([k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                                  for k in found], pa.binary())}
    return _arrow(docs, "node long, keys binary", pack)


def _unpack(keys: bytes) -> np.ndarray:
    wide = np.zeros((len(keys) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(keys, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole sets reach the threshold."""
    both = (pairs.select("x", "y").join(sets.select(F.col("node").alias("x"),
                                                    F.col("keys").alias("kx")), "x")
            .join(sets.select(F.col("node").alias("y"), F.col("keys").alias("ky")), "y"))

    def run(batches):
        for batch in batches:
            xs, ys, kx, ky = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                              for c in ("x", "y", "kx", "ky"))
            out = []
            for x, y, a, b in zip(xs, ys, kx, ky, strict=True):
                u, v = _unpack(a), _unpack(b)
                both_n = len(np.intersect1d(u, v, assume_unique=True))
                if 100 * both_n >= percent * (len(u) + len(v) - both_n):
                    out.append((x, y))
            yield out
    return map_rows(both, "x long, y long", run)


def components(edges: DataFrame, steps: int | None = None) -> DataFrame:
    """node and label (the smallest node it reaches), for the nodes of `edges` (x, y). After
    a given number of steps a label may still be that of some other node it reaches."""
    both = stored(edges.select("x", "y").union(edges.select("y", "x")).distinct()
                  .toDF("x", "y"), "edges")
    labels = stored(both.groupBy("x").agg(F.min("y").alias("m"))
                     .select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    taken = 0
    while steps is None or taken < steps:
        taken += 1
        near = (both.join(labels, both.y == labels.node).groupBy("x")
                .agg(F.min("label").alias("near")))
        step = (labels.join(near, labels.node == near.x)
                .select("node", F.col("label").alias("old"),
                        F.least("label", "near").alias("via")))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        step = stored(step.join(jump, "via", "left").select(
            "node", "old", F.least("via", "far").alias("label")), "labels")
        done = step.where("label <> old").isEmpty()
        labels = step.select("node", "label")
        if done:
            break
    return labels


def _pairs_between(entries: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of nodes in different groups, by summed products and the size bound."""
    a = entries.select("key", F.col("node").alias("x"), F.col("n").alias("nx"),
                       F.col("label").alias("lx"))
    b = entries.select("key", F.col("node").alias("y"), F.col("n").alias("ny"),
                       F.col("label").alias("ly"))
    similar = ((F.col("nx") * 100 >= F.col("ny") * percent)
               & (F.col("ny") * 100 >= F.col("nx") * percent))
    rest = F.ceil(F.greatest("nx", "ny") * percent / F.lit(100)) - 1
    return (a.join(b, "key").where((F.col("x") < F.col("y")) & (F.col("lx") != F.col("ly"))
                                   & similar)
            .groupBy("x", "y", "nx", "ny").agg(F.count("*").alias("shared"))
            .where(F.col("shared") + rest >= _needed(F.col("nx"), F.col("ny"), percent))
            .select("x", "y"))


def link(docs: DataFrame, size: int = 5, percent: int = 80, many: int = 32,
         demoted: int = 250_000, pivot_rounds: int = 3) -> DataFrame:
    """doc_id, n_shingles, and component_id: the smallest doc_id reachable by links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).where("doc_id is not null")

    def measured(batches):
        for batch in batches:
            sets = [shingles(t, size) for t in raw(batch.column(1))]
            yield [(d, len(k), signature(k) if len(k) else None)
                   for d, k in zip(batch.column(0).to_pylist(), sets, strict=True)]
    sizes = stored(map_rows(docs, "doc_id long, n int, node long", measured), "sizes")
    common = _common(docs, size, many, demoted)
    freed(docs.sparkSession)
    index = stored(_index(docs, size, percent, common), "index")
    shared = (index.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"))
              .where("a < b").select("key"))
    entries = stored(index.join(shared, "key").distinct(), "entries")
    freed(docs.sparkSession)
    first = sizes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    live = entries.select("node").distinct().join(first, "node").select(
        F.col("first").alias("doc_id"))
    sets = stored(_sets(docs.join(live, "doc_id", "left_semi"), size).dropDuplicates(["node"]),
                  "sets")
    freed(docs.sparkSession)

    edges = None
    labelled = entries.withColumn("label", F.col("node"))
    for turn in range(pivot_rounds):
        groups = labelled.groupBy("key").agg(
            F.count("*").alias("held"), F.min("label").alias("a"), F.max("label").alias("b"),
            F.min_by(F.struct("node", "n", "label"), F.xxhash64("label", F.lit(turn))).alias("p"))
        wide = groups.where((F.col("held") > many) & (F.col("a") < F.col("b")))
        similar = ((F.col("n") * 100 >= F.col("p.n") * percent)
                   & (F.col("p.n") * 100 >= F.col("n") * percent))
        pairs = stored(labelled.join(wide, "key").where((F.col("label") != F.col("p.label")) & similar)
                       .select(F.least("node", "p.node").alias("x"),
                                F.greatest("node", "p.node").alias("y")).distinct(), "pairs")
        if pairs.isEmpty():
            break
        found = stored(_verified(pairs, sets, percent), "found")
        if found.isEmpty():
            break
        freed(docs.sparkSession)
        edges = found if edges is None else edges.union(found)
        labels = components(edges, steps=1)
        labelled = stored(entries.join(labels, "node", "left").select(
            "key", "node", "n", F.coalesce("label", "node").alias("label")), "groups")
        freed(docs.sparkSession)
    last = stored(_verified(_pairs_between(labelled, percent), sets, percent), "last")
    freed(docs.sparkSession)
    labels = components(last if edges is None else edges.union(last))
    named = first.join(labels, "node", "left").select(
        "node", "first", F.coalesce("label", "node").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first").alias("component"))
    named = named.join(smallest, "label").select("node", "component")
    return sizes.join(named, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose doc_id leads its component; rows without a doc_id stay."""
    leads = link(docs, size, percent).where("component_id = doc_id").select(
        F.col("doc_id").alias("_lead")).distinct()
    kept = docs.join(leads, docs.doc_id.cast("long") == F.col("_lead"), "left_semi")
    return kept.unionByName(docs.where("doc_id is null"))
