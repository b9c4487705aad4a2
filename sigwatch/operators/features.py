"""Ordering, micro-batches and detector features.

* ``add_row_index`` (W1): exact global position without a global window --
  range-partition on the order, sort inside partitions, checkpoint, then add
  per-partition offsets (one row per partition, broadcast).
* ``batch_key`` windows (W2-W4) are partitioned by the 500-row batch, so no
  window ever holds more than one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import log_magnitude, scaled_square

ORDER = ("ts", "event_id")
LOW_BITS = 33


def add_row_index(df: DataFrame, order=ORDER, num_partitions: int | None = None,
                  batch_rows: int | None = None) -> DataFrame:
    """``row_idx`` = 0-based position in ``order``; ``batch_key`` =
    ``row_idx // batch_rows`` when ``batch_rows`` is given."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *[F.col(o) for o in order])
           .sortWithinPartitions(*[F.col(o) for o in order])
           .withColumn("_mid", F.monotonically_increasing_id()))
    # ids depend on partition layout: pin it before using them twice
    s = s.checkpoint(eager=True).withColumn("_pid", F.shiftright("_mid", LOW_BITS))
    counts = s.groupBy("_pid").agg(F.count("*").alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per partition: bounded by the partition count
    out = s.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
    out = out.withColumn("row_idx", F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid"), LOW_BITS))
    if batch_rows:
        out = out.withColumn("batch_key", F.floor(F.col("row_idx") / F.lit(batch_rows)).cast("long"))
    return out.drop("_mid", "_pid", "_off")


def _bw():
    return Window.partitionBy("batch_key").orderBy(*ORDER)


def with_diff(df: DataFrame) -> DataFrame:
    """First difference inside the batch, first row 0."""
    return df.withColumn("f_diff", F.col("value") - F.lag("value", 1).over(_bw())) \
             .withColumn("f_diff", F.coalesce("f_diff", F.lit(0.0)))


def with_rolling_ratio(df: DataFrame, rows: int = 50) -> DataFrame:
    """Mean of the last ``rows`` values (incl. current) and ``v/(mean+1e-8)``."""
    roll = F.avg("value").over(_bw().rowsBetween(-(rows - 1), 0))
    return df.withColumn("f_roll_ratio", F.col("value") / (roll + F.lit(1e-8)))


def forest_features(df: DataFrame) -> DataFrame:
    """``[v, log1p|v|, diff]`` per row (needs ``batch_key``)."""
    return with_diff(df).withColumn("f_value", F.col("value")).withColumn("f_log", log_magnitude())


FOREST_FEATURES = ("f_value", "f_log", "f_diff")
AE_FEATURES = ("f_value", "f_log", "f_sq", "f_diff", "f_roll_ratio", "f_metric")


def metric_index(baseline: DataFrame) -> DataFrame:
    """P5: sorted distinct metric names of the baseline -> position (one row per
    metric name; the ordering window runs over that small table only)."""
    names = baseline.select("metric_name").distinct()
    return names.withColumn("m_pos", F.row_number().over(Window.orderBy("metric_name")) - 1) \
                .withColumn("m_count", F.count("*").over(Window.partitionBy()))


def one_row_batches(df: DataFrame) -> DataFrame:
    """W2 + W3 where every row is its own batch: no window is needed."""
    return (df.withColumn("f_diff", F.lit(0.0))
              .withColumn("f_roll_ratio", F.col("value") / (F.col("value") + F.lit(1e-8))))


#: Rows per block of a whole-sequence feature window, and rows that the
#: longest window looks back.
SEQUENCE_BLOCK, LOOK_BACK = 10_000, 49


def whole_sequence(df: DataFrame, features) -> DataFrame:
    """``features`` over all rows as one sequence (the baseline): blocks of
    ``SEQUENCE_BLOCK`` rows, each with a copy of the last ``LOOK_BACK`` rows
    of the block before, so no window is larger than a block."""
    rows = add_row_index(df)
    block = F.floor(F.col("row_idx") / SEQUENCE_BLOCK).cast("long")
    tail = F.col("row_idx") % SEQUENCE_BLOCK >= SEQUENCE_BLOCK - LOOK_BACK
    places = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
    out = features(rows.select("*", F.explode(places).alias("batch_key")))
    return out.where(F.col("batch_key") == block)


def autoencoder_features(df: DataFrame, metric_idx: DataFrame, one_row: bool = False) -> DataFrame:
    """``[v, log1p|v|, v^2/1e6, diff, v/(roll50+1e-8), metric_pos/n]``;
    an unseen metric maps to position 0."""
    n_metrics = metric_idx.count()
    mi = metric_idx.select("metric_name", F.col("m_pos").cast("int").alias("m_pos"))
    d = one_row_batches(df) if one_row else with_rolling_ratio(with_diff(df))
    d = d.join(mi.select("metric_name", "m_pos"), "metric_name", "left")
    return (d.withColumn("f_value", F.col("value"))
             .withColumn("f_log", log_magnitude())
             .withColumn("f_sq", scaled_square())
             .withColumn("f_metric", F.coalesce(F.col("m_pos"), F.lit(0)) / F.lit(float(max(n_metrics, 1))))
             .drop("m_pos"))


def scaler(df: DataFrame, cols, zero_std_to_one: bool) -> DataFrame:
    """One row of feature means and population stds."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(c)
        if zero_std_to_one:
            sd = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        aggs += [F.avg(c).alias(f"{c}_mean"), sd.alias(f"{c}_std")]
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, sc_row, cols, eps: float) -> DataFrame:
    """Standardise with a fitted scaler row (a handful of literals)."""
    for c in cols:
        df = df.withColumn(f"{c}_z", (F.col(c) - F.lit(float(sc_row[f"{c}_mean"])))
                           / F.lit(float(sc_row[f"{c}_std"]) + eps))
    return df


def batch_minmax_confidence(df: DataFrame, score: str, out: str) -> DataFrame:
    """``1 - (s-min)/(max-min)`` over the batch, 0 when the batch is flat."""
    w = Window.partitionBy("batch_key")
    lo, hi = F.min(score).over(w), F.max(score).over(w)
    return df.withColumn(out, F.when(hi > lo, F.lit(1.0) - (F.col(score) - lo) / (hi - lo))
                         .otherwise(F.lit(0.0)))
