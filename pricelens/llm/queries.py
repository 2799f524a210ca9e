"""The registered queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, conversation_repair, divergence, exact_dedup, jaccard_join, line_dedup, mixing, nbsvm, packing, quality_rules, repeats, toxicity, url_filter
from .common import table

QUERIES = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    # behind the contract's columns: whether the document holds any of the repeated strings
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeats"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.selectExpr("doc_id", "held_out", "score", "predicted", "CAST(size(spans) AS BIGINT) AS n_offending")


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality_rules", quality_rules.RULES_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def public_tokenizer() -> dict[str, str]:
    """Files of the public byte-level vocabulary, as parameters of the packer."""
    import public_tokenizers

    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), **public_tokenizer())


@query("op10_mixing", mixing.MIX_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_line_dedup", line_dedup.LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@query("op7_url_filters", url_filter.URL_SQL)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.url_filter(pages, url_filter.tracked_hosts(pages), url_filter.RULES)


@query("op4_nearest")
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair", conversation_repair.REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


@query("op12_source_divergence", divergence.DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query("op13_exact_dedup", exact_dedup.COPIES_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
