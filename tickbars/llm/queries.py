"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm import filter_audit, hard_negatives, url_rules
from tickbars.llm.decontaminate import contamination
from tickbars.llm.lattice_lm import score_documents
from tickbars.llm.mixing import mixture
from tickbars.llm.near_text import near_components
from tickbars.llm.near_vectors import vector_components
from tickbars.llm.pii import find_personal_data, fit_field
from tickbars.llm.quality import fit_quality, grade_documents
from tickbars.llm.repeats import remove_repeats
from tickbars.llm.tables import read_table, tokenizer_file
from tickbars.llm.token_counts import token_counts
from tickbars.llm.tokens import read_tokens, token_digest, write_tokens
from tickbars.session import new_run_dir


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op2_lattice_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_file("piece_bpe_32k.model")
    return score_documents(read_table(spark, sf_dir, "documents"), vocabulary)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_run_dir(spark, "tokens")
    documents = read_table(spark, sf_dir, "documents")
    write_tokens(documents, path, tokenizer_file("byte_bpe_50k.json"))
    return token_digest(read_tokens(spark, path))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(read_table(spark, sf_dir, "embeddings"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(read_table(spark, sf_dir, "documents")).drop("row_key", "group")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return contamination(documents, read_table(spark, sf_dir, "benchmark")).drop("row_key")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return find_personal_data(documents, fit_field(documents))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixture(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rule_table(spark, url_rules.RULES)
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = fit_quality(documents, read_table(spark, sf_dir, "labels"))
    return grade_documents(documents, model)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return filter_audit.filter_audit(documents, read_table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    vectors = vectors.withColumn("label", shifted.otherwise(F.col("label")))
    return hard_negatives.hard_negatives(vectors)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return token_counts(documents, tokenizer_file("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_lattice_lm_scoring,
        op3_token_files,
        op4_embedding_near_dedup,
        op5_minhash_near_dedup,
        op6_benchmark_decontamination,
        op7_personal_data,
        op8_source_mixing,
        op9_url_filters,
        op10_quality_classifier,
        op11_filter_audit,
        op12_hard_negatives,
        op13_token_counts,
    )
}
ORACLES: dict[str, str] = {
    "op9_url_filters": url_rules.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
