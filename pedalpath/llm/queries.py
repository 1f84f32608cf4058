"""One query per corpus operator, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (chat_format, decontaminate, filter_audit, licenses, line_dedup, mixing, ngram_join, prefix_trie, quality,
               secret_scan, span_dedup, toxicity, url_filter)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return span_dedup.dedup_report(_table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licence_scan(_table(spark, folder, "documents"))


def op3_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.drop("sig")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_report(_table(spark, folder, "documents"), line_dedup.WHOLE)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(_table(spark, folder, "documents"))


def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_sets(_table(spark, folder, "documents"))


#: One more conversation, whose texts hold marks of another template.
MARKS = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], rows.schema)
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(more)))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, folder, "conversations"))


def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES = {
    "op1_span_dedup": op1_span_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_benchmark_leaks": op3_benchmark_leaks,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_source_mixing": op8_source_mixing,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_chat_format": op10_chat_format,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secret_scan": op12_secret_scan,
    "op13_filter_audit": op13_filter_audit,
}
