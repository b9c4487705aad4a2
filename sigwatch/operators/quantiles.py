"""Exact percentiles by rank selection: no task holds a group's values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import add_row_index


def percentiles(df: DataFrame, value: str, shares: dict[str, float], key=(), tie: str = "event_id") -> DataFrame:
    """Linear-interpolation percentiles per key, one column per entry of
    ``shares``. Rows are range-sorted by (key, value, tie), so a value that a
    third of the rows share is split as well; per share only the rows of the
    two neighbouring ranks are aggregated. Nulls are left out."""
    key = list(key)
    rows = add_row_index(df.where(F.col(value).isNotNull()).select(*key, F.col(value).alias("_v"), tie),
                         order=(*key, "_v", tie))
    spans = rows.groupBy(*key).agg(F.min("row_idx").alias("_first"), F.count("*").alias("_n"))
    if key:
        ranked = rows.join(spans, key)
    else:
        span = spans.first()
        ranked = rows.withColumn("_first", F.lit(span["_first"])).withColumn("_n", F.lit(span["_n"]))
    rank = F.col("row_idx") - F.col("_first")
    place = {name: (F.col("_n") - 1) * F.lit(float(share)) for name, share in shares.items()}
    near = None
    for at in place.values():
        hit = (rank == F.floor(at)) | (rank == F.ceil(at))
        near = hit if near is None else near | hit
    picked = ranked.where(near)
    out = []
    for name, at in place.items():
        low = F.max(F.when(rank == F.floor(at), F.col("_v")))
        high = F.max(F.when(rank == F.ceil(at), F.col("_v")))
        out.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    return picked.groupBy(*key).agg(*out)
