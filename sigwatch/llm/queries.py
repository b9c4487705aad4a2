"""Registered queries of the training-data operators (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .boosted_quality import scored
from .byte_gru import identify
from .chat_repair import damaged, repair_report
from .common import start, table
from .decontaminate import decontaminate
from .deobfuscate import personal_data
from .license_scan import license_report
from .line_dedup import repeated_units
from .outliers import quality
from .parity_join import classes
from .passages import repeated_passages
from .periodic_runs import planted, run_report
from .piece_sampler import digests, encoded
from .sql import ORACLE  # noqa: F401  (re-exported for the entry module)
from .token_trees import counted
from .warc_bundles import read_bundles, write_bundles


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op2_deobfuscate(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return personal_data(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that stand earlier in the corpus, however
    their lines break."""
    start(spark)
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_line_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lines of five words and more that stand earlier in the corpus."""
    start(spark)
    return repeated_units(table(spark, sf_dir, "documents"))


def op3_every_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op3_line_units, with short lines (menus, footers) too."""
    start(spark)
    return repeated_units(table(spark, sf_dir, "documents"), min_words=1)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return license_report(table(spark, sf_dir, "documents"))


def op5_token_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return counted(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents, one row each."""
    start(spark)
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=False).drop("spans")


def op7_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return classes(table(spark, sf_dir, "documents"))


def op8_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return identify(table(spark, sf_dir, "documents"))


def op9_piece_sampler(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return digests(encoded(table(spark, sf_dir, "documents")))


def op10_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    start(spark)
    return read_bundles(*write_bundles(table(spark, sf_dir, "pages")))


def op11_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; labels of the held-out fold are not read."""
    start(spark)
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation, one row each."""
    start(spark)
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, after the contract's planting."""
    start(spark)
    return run_report(table(spark, sf_dir, "documents"), change=planted).drop("n_words")


QUERIES = {f.__name__: f for f in (
    op1_robust_outliers, op2_deobfuscate, op3_line_dedup, op3_line_units, op3_every_line, op4_license_scan, op5_token_trees,
    op6_decontaminate, op7_parity_join, op8_byte_gru, op9_piece_sampler, op10_warc_bundles,
    op11_boosted_quality, op12_chat_repair, op13_periodic_runs)}
