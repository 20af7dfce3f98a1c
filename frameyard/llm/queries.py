"""The registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameyard.llm import oracles
from frameyard.llm.common import table
from frameyard.llm.decontam import decontaminate
from frameyard.llm.embedding_dedup import near_duplicates
from frameyard.llm.jaccard_join import jaccard_join
from frameyard.llm.license_scan import license_scan
from frameyard.llm.packing import pack_documents
from frameyard.llm.personal_data import pii_scan, span_list
from frameyard.llm.secret_scan import secret_scan
from frameyard.llm.source_audit import source_audit
from frameyard.llm.suffix_dedup import suffix_dedup
from frameyard.llm.token_counts import token_counts
from frameyard.llm.toxicity import score_toxicity
from frameyard.llm.url_filter import url_filter
from frameyard.llm.whitening import whiten


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).drop("recall")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_near")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), with_kept=False).drop("kept")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(table(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_scan(table(spark, sf_dir, "documents"))
    base = F.sha2(span_list(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256")
    n_added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, span_list("spans").alias("spans"), n_added)


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_embedding_near_dedup, op3_best_fit_packing, op4_toxicity, op5_secret_scan, op6_ngram_jaccard_join, op7_token_counts, op8_benchmark_decontamination, op9_suffix_array_dedup, op10_url_filter, op11_embedding_whitening, op12_source_divergence_audit, op13_pii)}

ORACLE = {
    "op2_embedding_near_dedup": oracles.OP2, "op5_secret_scan": oracles.OP5, "op6_ngram_jaccard_join": oracles.OP6,
    "op8_benchmark_decontamination": oracles.OP8, "op10_url_filter": oracles.OP10,
    "op12_source_divergence_audit": oracles.OP12,
}
