"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigwatch.session import ensure_checkpoint_dir, prepare

# Separators of the two word definitions, as Java regular expressions.
SPACE_SEPARATORS = r"[\x20\x09-\x0D]+"
ALNUM_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_SEPARATOR_BYTES = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: bytes.translate table: A-Z to a-z, every ASCII non-alphanumeric to a space.
ALNUM_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in _SEPARATOR_BYTES else c for c in range(256))


def start(spark: SparkSession) -> SparkSession:
    """Session settings of every operator here: small Arrow batches, so that
    a batch of very long texts stays within a Python worker's memory."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the
    lineage is cut, lost executors lose nothing, and the planner knows the
    table's real size (so it picks broadcast joins by itself)."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def space_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank: empty."""
    t = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(t != "", F.split(t, SPACE_SEPARATORS)).otherwise(F.array().cast("array<string>"))


def as_batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    """Row tuples as an Arrow batch with the (name, type) fields."""
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], [n for n, _ in fields])


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""
