"""Lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in ``spark.checkpoint.dir``."""
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by a table in ``spark.checkpoint.dir``; the planner then
    knows its real size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
