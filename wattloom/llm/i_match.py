"""I-Match fingerprints over randomised lexicons, and how alike two of them are.

A term is a run of letters or digits in lower case, held as a 64-bit hash. The lexicon keeps
the terms whose inverse document frequency lies in a band: common terms tell texts apart no
better than rare ones, which are mostly noise. A text keeps its distinct lexicon terms, sorted.
Classic I-Match hashes that list whole, so that one changed term changes the name. Here
`SEEDS` randomised lexicons are nested in scales: scale e of a lexicon keeps one term in 2**e.
A text of m terms is hashed at the `SCALES` scales from log2(m), where a sub-lexicon holds
about one of its terms or less, whatever its length; the likeness of two texts is the share of equal
hashes among those that are not empty in both.

A text with fewer than `thin` terms in the band also keeps a share of its other terms, chosen
by hash and about `spare` in number, so that short texts and texts of rare words have a name.

Size of the lexicon: at most (mean number of distinct terms) * exp(idf_max) terms, whatever
the number of documents. It is broadcast if its counted size is below `BROADCAST_TERMS`, and
joined by a shuffle otherwise.

Everything is DataFrame expressions. Defined results: null text is empty; texts without terms
have the hash of the text alone, are like equal texts (1.0) and like no other (0.0); rows that
repeat a doc_id are separate documents, ordered by a hash of their text; rows equal in both
are one document in that order and each get its result; null ids come first; an empty table
gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import stored
from wattloom.operators.ordered import row_index

SEEDS, SCALES, TOP_SCALE = 16, 3, 13  # levels have four bits, so base + SCALES - 1 <= 15
#: Broadcast bound of the lexicon, 8 bytes a term.
BROADCAST_TERMS = 2_000_000
KEY = ["id", "tie"]
_SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def distinct_terms(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _SPLIT)), "")


def lexicon(docs: DataFrame, idf_min: float, idf_max: float) -> DataFrame:
    """The hashes of the terms of `docs.text` in the band, written to the shared folder."""
    total = docs.count()
    counts = (docs.select(F.explode(distinct_terms(F.col("text"))).alias("term"))
              .groupBy(F.xxhash64("term").alias("term")).agg(F.count(F.lit(1)).alias("df")))
    least = max(2.0, total * math.exp(-idf_max))
    return stored(counts.where((F.col("df") >= least)
                               & (F.col("df") <= total * math.exp(-idf_min))).select("term"),
                  "lexicon")


def _levels(term: Column) -> Column:
    """For each seed the deepest scale whose sub-lexicon keeps the term, four bits a seed."""
    packed = F.lit(0).cast("long")
    for seed in range(SEEDS):
        h = F.shiftrightunsigned(F.xxhash64(term, F.lit(seed)), 1)
        zeros = F.least(F.bit_count(F.bitwise_not(h).bitwiseAND(h - 1)), F.lit(15))
        packed = packed.bitwiseOR(F.shiftleft(zeros.cast("long"), 4 * seed))
    return packed


def _named(terms: str, text: str) -> Column:
    """struct(full, base, slots) from a sorted array of struct(term, lev)."""
    base = f"greatest(0, least({TOP_SCALE}, cast(floor(log2(greatest(1, size({terms})))) as int)))"
    slot = "(shiftrightunsigned(x.lev, 4 * s) & 15)"

    def hashed(step: int) -> str:
        kept = f"transform(filter(k, x -> {slot} >= b + {step}), x -> x.term)"
        return (f"CASE WHEN size({kept}) = 0 THEN 0"
                f" ELSE cast(pmod(xxhash64({kept}), 2147483647) as int) + 1 END")
    steps = ", ".join(hashed(step) for step in range(SCALES))
    by_seed = (f"transform(sequence(0, {SEEDS - 1}), s -> transform(array(filter({terms}, "
               f"x -> {slot} >= b)), k -> array({steps}))[0])")
    slots = (f"flatten(transform(array({base}), b -> flatten(transform(array({by_seed}), g -> "
             f"transform(sequence(0, {SCALES - 1}), i -> transform(g, h -> h[i]))))))")
    full = (f"CASE WHEN size({terms}) = 0 THEN xxhash64({text}, 0)"
            f" ELSE xxhash64(transform({terms}, x -> x.term)) END")
    return F.expr(f"struct({full} AS full, {base} AS base, flatten({slots}) AS slots)")


def fingerprint(rows: DataFrame, keys: list[str], texts: list[str], words: DataFrame,
                thin: int = 8, spare: int = 16) -> DataFrame:
    """`rows` with `<text>_name`, a struct(full, base, slots), for each of its text columns.

    `keys` tell the rows apart. If `rows` is already partitioned by them nothing more is
    shuffled while the lexicon is small enough to be broadcast.
    """
    small = words.count() <= BROADCAST_TERMS
    held = words.select(F.col("term"), F.lit(True).alias("band"))
    held = F.broadcast(held) if small else held
    split = rows.select(*keys, *texts, *[distinct_terms(F.col(t)).alias(f"{t}_w") for t in texts])
    each = split.select(*keys, *texts, F.inline(F.array(*[
        F.struct(F.lit(i).alias("side"), F.size(f"{t}_w").alias("held"),
                 F.col(f"{t}_w").alias("words")) for i, t in enumerate(texts)])))
    terms = (each.select(*keys, "side", "held", F.explode("words").alias("word"))
             .select(*keys, "side", "held", F.xxhash64("word").alias("term")))
    terms = terms.join(held, "term", "left")
    spared = F.shiftrightunsigned("term", 33) * F.col("held") < spare * (1 << 31)
    terms = terms.where(F.col("band") | spared).select(
        *keys, "side", "band", F.struct("term", _levels(F.col("term")).alias("lev")).alias("t"))
    lists = [(F.collect_list(F.when((F.col("side") == i) & F.col("band"), F.col("t"))),
              F.collect_list(F.when((F.col("side") == i) & F.col("band").isNull(), F.col("t"))))
             for i in range(len(texts))]
    grouped = terms.groupBy(*keys).agg(*[c.alias(f"_{kind}{i}") for i, pair in enumerate(lists)
                                         for kind, c in zip("bs", pair, strict=True)])
    joined = rows.join(grouped, keys, "left")
    for i, t in enumerate(texts):
        joined = joined.withColumn(f"_t{i}", F.expr(
            f"array_sort(coalesce(CASE WHEN size(_b{i}) >= {thin} THEN _b{i}"
            f" ELSE concat(_b{i}, _s{i}) END, array()))"))
    return joined.select(*rows.columns, *[_named(f"_t{i}", t).alias(f"{t}_name")
                                          for i, t in enumerate(texts)])


def as_string(name: str) -> Column:
    """full hash, base scale and the slots, in hexadecimal."""
    return F.expr(f"concat_ws(':', lpad(hex({name}.full), 16, '0'), {name}.base, "
                  f"array_join(transform({name}.slots, x -> lpad(hex(x), 8, '0')), ''))")


def likeness(a: str, b: str) -> Column:
    """Share of equal hashes among the slots of common scales that are not empty in both."""
    shift = f"({b}.base - {a}.base)"
    common = f"greatest(0, {SCALES} - abs({shift})) * {SEEDS}"
    left = f"slice({a}.slots, 1 + {SEEDS} * greatest({shift}, 0), {common})"
    right = f"slice({b}.slots, 1 + {SEEDS} * greatest(-{shift}, 0), {common})"
    counts = (f"aggregate(zip_with({left}, {right}, (x, y) -> struct(x, y)), "
              "struct(0 AS same, 0 AS used), (s, p) -> struct("
              "s.same + CASE WHEN p.x = p.y AND p.x <> 0 THEN 1 ELSE 0 END AS same, "
              "s.used + CASE WHEN p.x <> 0 OR p.y <> 0 THEN 1 ELSE 0 END AS used), "
              "s -> CASE WHEN s.used = 0 THEN 0D ELSE cast(s.same AS double) / s.used END)")
    return F.expr(f"CASE WHEN {a}.full = {b}.full THEN 1D ELSE {counts} END")


def in_order(docs: DataFrame) -> DataFrame:
    """The documents in ascending doc_id order, one row for equal rows: doc_id, text, n_chars,
    copies, a key (id, tie) without nulls, and the key and n_chars of the document before
    (prev_id, prev_tie, prev_chars; the first comes after the last)."""
    null = F.col("doc_id").isNull()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = rows.select(F.coalesce("doc_id", F.lit(0)).alias("id"),
                        F.xxhash64("text", null).alias("tie"), "doc_id", "text")
    ids = (keyed.select("id", "tie", "doc_id", F.char_length("text").alias("n_chars"))
           .groupBy("id", "tie", "doc_id").agg(F.max("n_chars").alias("n_chars"),
                                               F.count(F.lit(1)).alias("copies")))
    indexed = row_index(ids, ["doc_id", "tie"], "at")
    total = max(indexed.count(), 1)
    before = indexed.select(((F.col("at") + 1) % total).alias("at"), F.col("id").alias("prev_id"),
                            F.col("tie").alias("prev_tie"), F.col("n_chars").alias("prev_chars"))
    places = stored(indexed.join(before, "at").drop("at"), "places")
    first = F.expr("row_number() OVER (PARTITION BY id, tie ORDER BY n_chars)")
    return (places.join(keyed.select("id", "tie", "text"), KEY).withColumn("_nth", first)
            .where("_nth = 1").drop("_nth"))


def edited_by_next(docs: DataFrame, parts: int = 4) -> DataFrame:
    """The rows of `in_order` with `edited`: the last floor(n / parts) code points of a text
    replaced by the first as many of the next document."""
    rows = in_order(docs)
    heads = rows.select(F.col("prev_id").alias("id"), F.col("prev_tie").alias("tie"),
                        F.expr(f"left(text, prev_chars div {parts})").alias("_head"))
    return rows.join(heads, KEY).withColumn("edited", F.expr(
        f"concat(left(text, n_chars - cast(n_chars div {parts} as int)), _head)")).drop("_head")


def compare(docs: DataFrame, idf_min: float = 3.0, idf_max: float = 7.6) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next of every document."""
    words = lexicon(docs.select(F.col("text").cast("string").alias("text")), idf_min, idf_max)
    named = stored(fingerprint(edited_by_next(docs), KEY, ["text", "edited"], words).select(
        "doc_id", *KEY, "n_chars", "copies", "prev_id", "prev_tie", "text_name", "edited_name",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")), "names")
    after = named.select(F.col("prev_id").alias("id"), F.col("prev_tie").alias("tie"),
                         F.col("text_name").alias("next_name"))
    return named.join(after, KEY).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        as_string("text_name").alias("fingerprint"),
        as_string("edited_name").alias("edited_fingerprint"),
        likeness("text_name", "edited_name").alias("near_edited"),
        likeness("text_name", "next_name").alias("near_next"),
        F.explode(F.expr("sequence(1, cast(copies as int))")).alias("_copy")).drop("_copy")
