"""Sinks: partitioned audit table, payload files, alert log, reports; and
the audit reader that repairs damaged records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.alerts import pagerduty_json, slack_json
from ..operators.small import materialize

AUDIT_COLUMNS = ["event_id", "timestamp", "service", "metric_name", "value", "is_anomaly",
                 "ensemble_confidence", "severity", "votes", "detector_confidences", "fusion_strategy"]


def audit_rows(results: DataFrame, batch_id: int | None = None) -> DataFrame:
    """S5 rows: ensemble result + audit columns and the partition columns."""
    out = results.select(
        "event_id", (F.unix_micros("ts") / F.lit(1000.0)).alias("timestamp"), "service", "metric_name",
        "value", "is_anomaly", "ensemble_confidence", "severity", "votes", "detector_confidences",
        "fusion_strategy",
        F.current_timestamp().alias("_audit_ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"))
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(int(batch_id)))
    return out


def write_audit(results: DataFrame, path: str, fmt: str = "parquet", batch_id: int | None = None) -> None:
    """``date=/service=`` layout (plus ``batch_id=`` for stream batches, with
    dynamic partition overwrite so a replayed batch replaces only itself)."""
    rows = audit_rows(results, batch_id)
    parts = ["date", "service"] + (["batch_id"] if batch_id is not None else [])
    w = rows.write.format(fmt).partitionBy(*parts)
    if batch_id is not None:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.save(path)


AUDIT_JSON_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("timestamp", T.DoubleType()),
    T.StructField("service", T.StringType()), T.StructField("metric_name", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("is_anomaly", T.StringType()),
    T.StructField("ensemble_confidence", T.DoubleType()), T.StructField("severity", T.StringType()),
    T.StructField("votes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("detector_confidences", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("fusion_strategy", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])


def _bool(c):
    return F.lower(F.trim(c.cast("string"))) == F.lit("true")


def read_audit_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read JSON audit records (one document per file, possibly truncated,
    booleans as real booleans or as ``"True"``/``"False"``). Returns
    (repaired rows, corrupt records); partition columns are discovered."""
    raw = (spark.read.schema(AUDIT_JSON_SCHEMA).option("multiLine", "true")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
           .json(path))
    raw = materialize(raw)  # Spark does not filter files on the corrupt column alone
    bad = raw.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")
    good = raw.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    good = good.withColumn("is_anomaly", _bool(F.col("is_anomaly"))) \
               .withColumn("votes", F.transform_values("votes", lambda k, v: _bool(v)))
    return good, bad


def write_payloads(alerts: DataFrame, path: str) -> None:
    """S7 + S8: payload documents as text files partitioned by channel."""
    pd_ = pagerduty_json(alerts).withColumn("channel", F.lit("pagerduty"))
    sl = slack_json(alerts).withColumn("channel", F.lit("slack"))
    pd_.unionByName(sl).write.mode("append").partitionBy("channel").json(path)


def write_alert_log(alerts: DataFrame, path: str) -> None:
    """The alert log as JSON lines."""
    alerts.drop("ts").write.mode("append").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """Small report tables (evaluation, lag) as JSON."""
    df.repartition(1).write.mode("overwrite").json(path)
