"""A corpus pipeline: language, boilerplate lines, near duplicates, benchmark passages, tokens.

STAGES are (name, function of (spark, docs, sf_dir)). Each result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents; the last returns tokens.
Rows without a doc_id can be named by no decision: they pass the near-duplicate and benchmark stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sonoquarry.llm import bpe, decontaminate, language, lines, minhash
from sonoquarry.llm.registry import vocabulary_path
from sonoquarry.llm.shared import saved


# Share of a source's pages above which a line is boilerplate. On sf0.1 the boilerplate line has 0.086 to 0.132 in each
# source and no other line more than 0.048: a ratio between the two, the same at every size. op6_lines takes the same.
LINE_RATIO = 0.06


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no learned language: null, without a letter, or parsed into too many phrases by every language."""
    return language.in_known_language(docs, language.fitted(docs))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that much of their source repeats; n_chars follows the text."""
    return lines.without_boilerplate(docs, ratio=LINE_RATIO, length_col="n_chars", report=False)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (0.8 of five-word shingles): the one with the smallest doc_id."""
    return minhash.without_copies(docs, shingle=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left."""
    return bpe.digests(docs, vocabulary_path())


STAGES = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_duplicates", one_of_each),
    ("benchmark", without_benchmark),
    ("tokens", tokens),
]

#: No SQL: automata, signatures and byte-pair encoding have none; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
