"""Training-corpus pipeline over the documents table.

Each stage works on all documents that the stage before it kept, and is
written as Parquet before the next one reads it. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigwatch.llm.byte_gru import keep_identified
from sigwatch.llm.common import staged, start, table
from sigwatch.llm.decontaminate import keep_clean
from sigwatch.llm.deobfuscate import redact
from sigwatch.llm.parity_join import keep_representatives
from sigwatch.llm.piece_sampler import encoded
from sigwatch.llm.shingles import Rule

#: Five-word shingles, four fifths shared: the rule of stages without a contract.
NEAR = Rule(5, 80, 100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    start(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, rule: Rule = NEAR) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays."""
    start(spark)
    return keep_representatives(docs, rule)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    start(spark)
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    start(spark)
    return redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document."""
    start(spark)
    return encoded(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("pieces", pieces)]

#: A trained network decides in the first stage, and sampled pieces end the
#: last: SQL has neither. tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
