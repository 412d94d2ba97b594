"""The corpus pipeline: language, boilerplate lines, near copies, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each stage's result as
Parquet and hands the next stage what it reads back. All stages but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curaspark.llm import common, decontam, langid, line_dedup, mixing, ngram_join


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from their own labelled rows.

    Null texts, texts without a letter and long texts that no language claims go; a null language is filled in. Repeated
    rows are judged alike. Without labelled rows every document stays. No documents, no rows.
    """
    return langid.keep_identified(docs, ~common.held_out())


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines whose template recurs in other documents; a document that had nothing else is gone.

    Null texts and rows with a null id stay as they are. Repeated rows lose the same lines. The smallest document keeps a line,
    whatever the order. No documents, no rows.
    """
    return line_dedup.clean_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by five-word shingles at 0.8 or more.

    Null and blank texts are linked with nothing and stay, as do rows with a null id; repeated rows of an id stay or go together.
    """
    return ngram_join.keep_one(docs, words=5, num=80, den=100)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark. Null texts, and every document where the benchmark is empty, stay."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left with memberships, rates and expected tokens, a row for each row of documents; null texts have no tokens."""
    return mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_to_targets),
]

#: Models are fitted on the way, so SQL cannot say what run() returns; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
    return docs
