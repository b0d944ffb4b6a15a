"""The corpus pipeline: five stages from raw documents to training tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm.decontaminate import keep_uncontaminated
from tickbars.llm.mixing import mixed
from tickbars.llm.near_text import keep_first
from tickbars.llm.quality import fit_quality, keep_good
from tickbars.llm.shingles import SketchSettings
from tickbars.llm.tables import read_table, store, tokenizer_file
from tickbars.llm.tokens import read_tokens, write_tokens
from tickbars.session import new_run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted grades call good; toxic and low-quality ones go."""
    return keep_good(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by sets of five words."""
    return keep_first(docs, SketchSettings(shingle=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark item to go."""
    return keep_uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight takes it."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens, ids of every row."""
    path = new_run_dir(spark, "pipeline-tokens")
    write_tokens(docs, path, tokenizer_file("byte_bpe_50k.json"))
    return read_tokens(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("token-ID output", tokens),
]
#: The fitted classifier, hashes, draws and the tokenizer have no SQL; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
