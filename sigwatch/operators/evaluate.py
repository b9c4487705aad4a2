"""Evaluation against labels: confusion counts, rates, per-type recall,
detection lag and chart datasets. One scan for all methods (unpivot)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fround


def unpivot_methods(scored: DataFrame, methods: list[tuple[str, str, str]]) -> DataFrame:
    """One row per (event, method) with ``pred`` and ``conf``; the labels
    ``label`` / ``label_type`` and ``ts`` are carried."""
    arr = F.array(*[F.struct(F.lit(m).alias("method"), F.coalesce(F.col(p), F.lit(False)).alias("pred"),
                             F.col(c).cast("double").alias("conf")) for m, p, c in methods])
    return scored.select("event_id", "ts", "label", "label_type", F.explode(arr).alias("_m")) \
                 .select("event_id", "ts", "label", "label_type", "_m.*")


def _rate(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion(long: DataFrame) -> DataFrame:
    """A4 + A5 + A6: counts, rates (0 on empty denominators) and mean
    confidence by true label, per method."""
    p, g = F.col("pred"), F.col("label")
    agg = long.groupBy("method").agg(
        F.count("*").alias("total_events"),
        F.count_if(p & g).alias("true_positives"),
        F.count_if(p & ~g).alias("false_positives"),
        F.count_if(~p & ~g).alias("true_negatives"),
        F.count_if(~p & g).alias("false_negatives"),
        F.avg(F.when(g, F.col("conf"))).alias("_ca"),
        F.avg(F.when(~g, F.col("conf"))).alias("_cn"))
    tp, fp, tn, fn = (F.col(c) for c in ("true_positives", "false_positives", "true_negatives",
                                         "false_negatives"))
    prec = _rate(tp, tp + fp)
    rec = _rate(tp, tp + fn)
    return (agg.withColumn("_p", prec).withColumn("_r", rec)
               .withColumn("precision", fround("_p", 4))
               .withColumn("recall", fround("_r", 4))
               .withColumn("f1", fround(_rate(2 * F.col("_p") * F.col("_r"), F.col("_p") + F.col("_r")), 4))
               .withColumn("accuracy", fround(_rate(tp + tn, F.col("total_events")), 4))
               .withColumn("false_positive_rate", fround(_rate(fp, fp + tn), 4))
               .withColumn("avg_confidence_anomaly", fround(F.coalesce("_ca", F.lit(0.0)), 4))
               .withColumn("avg_confidence_normal", fround(F.coalesce("_cn", F.lit(0.0)), 4))
               .drop("_p", "_r", "_ca", "_cn"))


def per_type(long: DataFrame) -> DataFrame:
    """Count, detected and recall per (method, anomaly type)."""
    g = long.where(F.col("label_type").isNotNull()).groupBy("method", "label_type").agg(
        F.count("*").alias("count"),
        F.count_if(F.col("pred") & F.col("label")).alias("detected"),
        F.count_if(~F.col("pred") & F.col("label")).alias("_fn"))
    return g.select("method", F.col("label_type").alias("anomaly_type"), "count", "detected",
                    fround(_rate(F.col("detected"), F.col("detected") + F.col("_fn")), 4).alias("recall"))


def per_type_map(long: DataFrame) -> DataFrame:
    """A7 map form: method -> {type: struct(count, detected, recall)}."""
    t = per_type(long)
    return t.groupBy("method").agg(F.map_from_entries(F.collect_list(F.struct(
        "anomaly_type", F.struct("count", "detected", "recall")))).alias("per_type"))


def detection_lag(long: DataFrame) -> DataFrame:
    """J5 + W9: per method and scenario, first labelled row vs first detected
    labelled row, lag in seconds (null when never detected)."""
    t = F.unix_micros("ts") / F.lit(1e6)
    g = long.where(F.col("label_type").isNotNull()).groupBy("method", "label_type").agg(
        F.min(t).alias("start_s"), F.min(F.when(F.col("pred"), t)).alias("first_s"))
    return g.select("method", F.col("label_type").alias("scenario"),
                    fround(F.col("first_s") - F.col("start_s"), 2).alias("lag_sec"))


def lag_sla(lags: DataFrame, sla_sec: float = 4.0) -> DataFrame:
    """A11 + V5: band per scenario and the mean over detected scenarios."""
    band = (F.when(F.col("lag_sec").isNull(), "not_detected").when(F.col("lag_sec") > 5, "slow")
            .when(F.col("lag_sec") > 2, "medium").otherwise("fast"))
    per = lags.select("method", "scenario", "lag_sec", band.alias("band"),
                      (F.col("lag_sec") <= F.lit(sla_sec)).alias("within_sla"))
    return per


def mean_lag(lags: DataFrame, sla_sec: float = 4.0) -> DataFrame:
    m = lags.groupBy("method").agg(fround(F.coalesce(F.avg("lag_sec"), F.lit(0.0)), 2).alias("avg_lag_sec"),
                                   F.count("lag_sec").alias("detected_scenarios"))
    return m.withColumn("within_sla", F.col("avg_lag_sec") <= F.lit(sla_sec))


def confidence_histogram(df: DataFrame, conf: str = "ensemble_confidence", flag: str = "is_anomaly",
                         bins: int = 29) -> DataFrame:
    """A13 + V3: ``linspace(0,1,bins+1)`` edges, last bin closed, density per flag."""
    b = F.least(F.floor(F.col(conf) * bins), F.lit(bins - 1)).cast("int")
    g = df.where(F.col(conf).between(0.0, 1.0)).groupBy(F.col(flag).alias("flagged"), b.alias("bin")) \
          .agg(F.count("*").alias("n"))
    tot = F.sum("n").over(Window.partitionBy("flagged"))
    return g.withColumn("density", fround(F.col("n") / (tot * F.lit(1.0 / bins)), 4))
