"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from wattloom.llm import (byte_bpe, collocations, decontaminate, divergence, i_match,
                          jaccard_join, line_dedup, quality_classifier, repair_ids, rule_ledger,
                          token_counts, toxicity, warc)
from wattloom.llm.registry import query, table, texts
from wattloom.llm.sql import COLLOCATIONS, CONTAMINATION, DIVERGENCE, LINE_DEDUP, RULE_LEDGER, WARC
from wattloom.session import work_path

QUALITY_CUT, TOXIC_CUT = 0.3, 0.7
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op1_ngram_jaccard_join")
def op1(spark, sf_dir):
    return jaccard_join.link(texts(table(spark, sf_dir, "documents")), size=4, percent=85)


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    docs = texts(table(spark, sf_dir, "documents"))
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id", (~quality_classifier.in_training(F.col("doc_id"))).alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= QUALITY_CUT, 1).otherwise(0).alias("predicted"))


@query("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts.count_tokens(texts(table(spark, sf_dir, "documents")),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_repair_token_ids")
def op4(spark, sf_dir):
    path = work_path(spark, "token_ids")
    repair_ids.write_ids(table(spark, sf_dir, "documents"), path,
                         public_tokenizers.path("word_bpe_49k.json"))
    return repair_ids.read_ids(spark, path, digest=True)


@query("op5_byte_bpe")
def op5(spark, sf_dir):
    return byte_bpe.digests(texts(table(spark, sf_dir, "documents")), RANKS,
                            public_tokenizers.PATTERN, byte_bpe.RUNS)


@query("op6_quality_rules", RULE_LEDGER)
def op6(spark, sf_dir):
    entries = rule_ledger.ledger(texts(table(spark, sf_dir, "documents")))
    base = rule_ledger.failed("v1")
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~rule_ledger.failed("v2")).alias("kept"), "failures")


@query("op7_toxicity")
def op7(spark, sf_dir):
    docs = texts(table(spark, sf_dir, "documents"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (~toxicity.in_training(F.col("doc_id"))).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_CUT, 1).otherwise(0).alias("predicted"))


@query("op8_line_dedup", LINE_DEDUP)
def op8(spark, sf_dir):
    return line_dedup.dedup_lines(texts(table(spark, sf_dir, "documents"))).select(
        "doc_id", F.col("_lines").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op9_benchmark_decontamination", CONTAMINATION)
def op9(spark, sf_dir):
    marked = decontaminate.mark(texts(table(spark, sf_dir, "documents")),
                                table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", F.col("_words").alias("n_words"), F.size("_hits").cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("_items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("_hits") > 0).alias("contaminated"))


@query("op10_warc_derivatives", WARC)
def op10(spark, sf_dir):
    return warc.derive(table(spark, sf_dir, "pages"))


@query("op11_i_match")
def op11(spark, sf_dir):
    return i_match.compare(table(spark, sf_dir, "documents"))


@query("op12_collocations", COLLOCATIONS)
def op12(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), top=2000)


@query("op13_source_divergence", DIVERGENCE)
def op13(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))
