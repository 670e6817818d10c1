"""The corpus pipeline: stages that each read what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import language, line_dedup, minhash, mixing, packing
from ledgerline.llm.common import read_table, written
from ledgerline.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with the predicted language as ``lang``; ambiguous ones and those without a
    letter go. The sources are mixed by it."""
    return language.with_language(docs, language.AMBIGUOUS, predicted=True)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them hold; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for. A language's part of a source, by the predicted
    language, counts as a source of its own."""
    named = F.concat_ws("/", docs["lang"].cast("string"), docs["source"].cast("string"))
    own = docs.withColumns({"__source": docs["source"], "source": named})
    return mixing.mix(own).withColumn("source", F.col("__source")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language prediction and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written as Parquet to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
