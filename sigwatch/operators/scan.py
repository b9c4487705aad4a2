"""Exact per-key prefix sums and prefix minima without one task per key.

A window ``partitionBy(key).orderBy(t)`` puts each key in one task, so a key
holding a third of the table would be one task. Here each key is cut into
event-time segments (``segment_seconds`` wide). Built-in windows partitioned by
(key, segment) take local running sums and minima (JVM, codegen). A summary
table with one row per segment gives every segment its offset (the sum of all
earlier segments of its key) and the minimum reached before it. The summary
joins back on (key, segment) without moving the rows again: the window has
already partitioned and sorted them that way (only the summary is shuffled).
Everything is a deterministic function of the rows, so a lost task recomputes
the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


DEFAULT_SEGMENT_SECONDS = 3600


def prefix_scan(df: DataFrame, key: list[str], order: list[str], sums: dict[str, str],
                mins: dict[str, str] | None = None, ts_col: str = "ts",
                segment_seconds: int = DEFAULT_SEGMENT_SECONDS) -> DataFrame:
    """Adds, per key in ``order`` (which must start with ``ts_col``):
    ``out`` = running sum of ``sums[out]``, and ``out`` = running minimum of the
    running sum ``mins[out]`` (including the current row)."""
    mins = mins or {}
    key = list(key)
    seg = F.floor(F.unix_micros(ts_col) / F.lit(segment_seconds * 1_000_000)).cast("long")
    d = df.withColumn("_seg", seg)
    w = Window.partitionBy(*key, "_seg").orderBy(*order) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for o, col in sums.items():
        d = d.withColumn(f"_l_{o}", F.sum(F.col(col).cast("double")).over(w))
    for o, s_out in mins.items():
        d = d.withColumn(f"_lm_{o}", F.min(f"_l_{s_out}").over(w))
    aggs = [F.sum(F.col(col).cast("double")).alias(f"_t_{o}") for o, col in sums.items()] + \
           [F.min(f"_lm_{o}").alias(f"_sm_{o}") for o in mins]
    segs = d.groupBy(*key, "_seg").agg(*aggs)
    before = Window.partitionBy(*key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    for o in sums:
        segs = segs.withColumn(f"_o_{o}", F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0.0)))
    for o, s_out in mins.items():
        segs = segs.withColumn(f"_pm_{o}", F.min(F.col(f"_o_{s_out}") + F.col(f"_sm_{o}")).over(before))
    keep = key + ["_seg"] + [f"_o_{o}" for o in sums] + [f"_pm_{o}" for o in mins]
    # ``d`` is already hash-partitioned and sorted on (key, segment) by its
    # window, so this join shuffles only the small summary side
    j = d.join(segs.select(*keep), key + ["_seg"])
    for o in sums:
        j = j.withColumn(o, F.col(f"_o_{o}") + F.col(f"_l_{o}"))
    for o, s_out in mins.items():
        own = F.col(f"_o_{s_out}") + F.col(f"_lm_{o}")
        j = j.withColumn(o, F.when(F.col(f"_pm_{o}").isNull(), own).otherwise(F.least(own, F.col(f"_pm_{o}"))))
    drop = ["_seg"] + [f"_l_{o}" for o in sums] + [f"_lm_{o}" for o in mins] + \
           [f"_o_{o}" for o in sums] + [f"_pm_{o}" for o in mins]
    return j.drop(*drop)
