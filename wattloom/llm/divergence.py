"""How far the vocabulary of each source is from that of the others of its language.

Terms carry their language, so that one CountVectorizer is one vocabulary per language. It is
fitted on the terms that are in enough documents, which one scan counts; fitted on the texts it
would count them once more. Texts of one source that a task reads together give
one exact sparse vector, the sum of theirs. Sums of the vectors per language and source are
taken over their non-zero entries alone, combined in each task first; a dense sum would cost a
vocabulary per source and task. Two sources are compared on the entries that either holds: a
term that neither holds adds a constant, and a term that one holds depends only on its count
there, so these are summed over the distinct counts of a source, and only terms that both hold
are joined.

The vocabulary is read to the driver and sent to every task, if it has at most `most_terms`
terms; beyond that the same sums come from a shuffle of (language, source, term) counts that
keeps them in Spark. Both ways give the same rows.

Defined results: null text, language and source are empty strings; rows that repeat each
count; a source whose texts have no terms is compared like any other; a language without kept
terms has 0 for each pair and no terms; an empty table gives no rows. Columns other than
lang, source and text are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import map_arrow, raw, stored

#: A-Z in lower case, all other ASCII but a-z as a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
#: Ends the language in a term of the common vocabulary; terms hold no such character.
_END = b"\0"
_SCALE = 1_000_000_000
#: Terms that a task counts before it passes them on.
_HELD = 300_000


def terms(text: bytes | None) -> list[bytes]:
    """Runs of letters and characters beyond ASCII; A-Z alone in lower case."""
    return text.translate(_FOLD).split() if text else []


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256):
    """lang, source and terms of the texts of a slice of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, raw(part.column(0)), [terms(t) for t in raw(part.column(2))]


def _strings(values: list[bytes]) -> pa.Array:
    return pc.cast(pa.array(values, pa.binary()), pa.string(), safe=False)


def tokens(rows: DataFrame, named: bool, held: int = 1 << 24) -> DataFrame:
    """lang, source and the terms of its texts, those of many texts of a source in one row;
    `named` terms begin with their language. A task holds `held` bytes of text and a batch."""
    def out(texts):
        for (lang, source), found in texts.items():
            flat = pc.ascii_split_whitespace(_strings([b" ".join(found)])).flatten()
            if named:
                flat = pc.binary_join_element_wise(
                    _strings([lang])[0], flat, pa.scalar(_END.decode(), pa.string()))
            yield pa.RecordBatch.from_arrays(
                [_strings([lang]), _strings([source]),
                 pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
                names=["lang", "source", "terms"])

    def run(batches):
        texts, size = defaultdict(list), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for lang, source, text in zip(*map(raw, part.columns), strict=True):
                    folded = text.translate(_FOLD).strip() if text else b""
                    if folded:
                        texts[lang, source].append(folded)
                        size += len(folded)
                if size >= held:
                    yield from out(texts)
                    texts, size = defaultdict(list), 0
        yield from out(texts)
    return map_arrow(rows, run, "lang string, source string, terms array<string>")


def _kept(rows: DataFrame, min_df: int) -> DataFrame:
    """lang and term of the terms in at least `min_df` documents of the language."""
    def run(batches):
        held, size = defaultdict(Counter), 0

        def out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [_strings([lang] * len(counts)), _strings(list(counts)),
                     pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "df"])
            held.clear()
        for _, langs, found in _slices(batches):
            for lang, f in zip(langs, found, strict=True):
                held[lang].update(set(f))
            size = sum(map(len, held.values()))
            if size >= _HELD:
                yield from out()
        yield from out()
    return (map_arrow(rows, run, "lang string, term string, df long").groupBy("lang", "term")
            .agg(F.sum("df").alias("df")).where(F.col("df") >= min_df).select("lang", "term"))


def vector_counts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term, n from the sparse vectors of a CountVectorizer that has the terms of
    `kept` for its vocabulary."""
    name = F.concat("lang", F.lit(_END.decode()), "term")
    model = CountVectorizer(inputCol="terms", outputCol="vector", vocabSize=(1 << 31) - 1).fit(
        kept.select(F.array(name).alias("terms")))
    names = model.vocabulary  # no more than `most_terms`
    words = rows.sparkSession.createDataFrame(pa.table(
        {"at": pa.array(range(len(names)), pa.int32()), "name": names}))
    vector = F.unwrap_udt("vector")
    sums = (model.transform(tokens(rows, True)).select(
        "lang", "source", F.explode(F.arrays_zip(
            vector["indices"].alias("at"), vector["values"].alias("n"))).alias("entry"))
        .groupBy("lang", "source", F.col("entry.at").alias("at"))
        .agg(F.sum("entry.n").cast("long").alias("n")))
    return sums.join(F.broadcast(words), "at").select(
        "lang", "source", F.substring_index("name", _END.decode(), -1).alias("term"), "n")


def shuffled_counts(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The same with the vocabulary in Spark."""
    sums = (tokens(rows, False).select("lang", "source", F.explode("terms").alias("term"))
            .groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("n")))
    return sums.join(kept, ["lang", "term"]).select(
        "lang", "source", "term", "n")


def _share(n: str) -> Column:
    """Smoothed share of a count among those of its group, in billionths, plus one."""
    return F.expr(f"1 + (cast({n} + 2 AS decimal(20,0)) * {_SCALE}) div (held + 2 * kept)")


def _far(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, item and value for every two sources of a language, both ways."""
    by_count = counts.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    alone = (by_count.join(other, "lang").where("source <> item")
             .groupBy("lang", "source", "item")
             .agg(F.sum(F.expr(f"times * ({_far('p', 'q0')})")).alias("far")))
    left = counts.select("lang", "term", "source", "p", "p0")
    right = counts.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"),
                          F.col("p0").alias("q0"))
    both = (left.join(right, ["lang", "term"]).where("source < item")
            .groupBy("lang", "source", "item").agg(
                F.count(F.lit(1)).alias("shared"),
                F.sum(F.expr(f"({_far('p', 'q')}) - ({_far('p', 'q0')}) - ({_far('p0', 'q')})"))
                .alias("change")))
    base = groups.select("lang", "source", "kept", "p0", "own").join(
        groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"),
                      F.col("own").alias("theirs")), "lang").where("source < item")
    swapped = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                           F.col("far").alias("back"))
    keys = ["lang", "source", "item"]
    zero = {"far": 0, "back": 0, "shared": 0, "change": 0}
    joined = base.join(alone, keys, "left").join(swapped, keys, "left").join(both, keys, "left")
    value = F.expr(f"far + back + change + (kept - own - theirs + shared) * ({_far('p0', 'q0')})")
    one_way = joined.fillna(zero).select(*keys, F.coalesce(value, F.lit(0)).alias("value"))
    return one_way.unionByName(one_way.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def _terms_above(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item and value of the terms that a source has more of than its language."""
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(totals, "lang").select(
        "lang", "term", _share("n").alias("q"))
    return counts.select("lang", "term", "source", "p").join(whole, ["lang", "term"]).where(
        "p > q").select("lang", "source", F.col("term").alias("item"),
                        F.expr(_far("p", "q")).alias("value"))


def audit(docs: DataFrame, min_df: int = 10, top: int = 10,
          most_terms: int = 1_000_000) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank; `term` to `top` ranks only."""
    split = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("lang", "source", "text")])
    terms_kept = stored(_kept(split, min_df), "vocabulary")
    few = 0 < terms_kept.count() <= most_terms
    counts = stored((vector_counts if few else shuffled_counts)(split, terms_kept), "counts")
    kept = counts.select("lang", "term").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"))
    per_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("held"),
                                                      F.count(F.lit(1)).alias("own"))
    occurring = split.select("lang", "source").distinct()
    groups = (occurring.join(per_source, ["lang", "source"], "left").join(kept, "lang", "left")
              .fillna(0, ["held", "own", "kept"]))
    groups = stored(groups.withColumn("p0", F.when(F.col("kept") > 0, _share("0"))), "groups")
    shares = stored(counts.join(groups.select("lang", "source", "held", "kept", "p0"),
                                ["lang", "source"])
                    .select("lang", "source", "term", "n", "p0", _share("n").alias("p")), "shares")
    totals = groups.groupBy("lang").agg(F.sum("held").alias("held"), F.max("kept").alias("kept"))
    order = "OVER (PARTITION BY lang, source ORDER BY value DESC, item)"
    ranked = F.expr(f"row_number() {order}").alias("rank")
    out = ["lang", "source", "part", "item", "value", "rank"]
    pairs = _pairs(groups, shares).select("*", F.lit("pair").alias("part"), ranked)
    above = _terms_above(shares, totals).select("*", F.lit("term").alias("part"), ranked).where(
        F.col("rank") <= top)
    return pairs.select(out).unionByName(above.select(out))
