"""Drop lines that several documents share; the smallest doc_id that holds a line keeps it.

Lines are exploded and keyed by two hashes of the normalised line. A key is shared if the
smallest and the largest doc_id that hold it differ, so the count of distinct documents is
an aggregate of two numbers with partial aggregation: a line in a third of all documents
costs one row per task. Only the positions of lines to drop travel back to the documents.

Defined results: null or empty text is one empty line. A row with a null doc_id holds no
line and keeps all its own. Rows that repeat a doc_id are one holder, and each keeps its
own positions. Lines shorter than `min_chars` after trimming are always kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import BLANK, map_arrow, raw, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, row, position and the two key hashes of every line long enough."""
    exploded = docs.where("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")))
    key = line_key(F.col("col"))
    return exploded.where(F.char_length(key) >= min_chars).select(
        "doc_id", "row", "pos", F.xxhash64(key).alias("a"),
        F.xxhash64(F.lit("line"), key).alias("b"))


def shared_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Keys (a, b) held by at least two documents, and the smallest of these."""
    return (_lines(docs, min_chars).groupBy("a", "b")
            .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
            .where("first < last").select("a", "b", "first"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the lines that stay, by position."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        gone = batch.column(batch.schema.get_field_index("_drop")).to_pylist()
        texts = raw(batch.column(at))
        for i, drop in enumerate(gone):
            if drop:
                out = set(drop)
                texts[i] = b"\n".join(
                    line for k, line in enumerate(texts[i].split(b"\n")) if k not in out)
        columns = batch.columns
        columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """The rows and columns of `docs` with `text` deduplicated, and `_lines` and `_drop`: the
    number of lines before and the positions dropped."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(
        "text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    ids = docs.select("doc_id", "text")
    # A table of its own: both sides of the next join are then plain exchanges, and a line
    # that very many documents hold can be split.
    shared = stored(shared_lines(ids, min_chars), "shared_lines")
    drops = (_lines(ids, min_chars).join(shared, ["a", "b"]).where("doc_id > first")
             .groupBy("doc_id", "row").agg(F.collect_set("pos").alias("_drop"))
             .select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "_drop"))
    found = docs.join(drops, (F.col("doc_id") == F.col("_id"))
                      & (F.xxhash64("text") == F.col("_row")), "left").drop("_id", "_row")
    found = found.withColumn("_lines", F.char_length("text").cast("long") + 1
                             - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))))
    return map_arrow(found, _kept, found.schema)
