"""Event sources: the test-table adapter, API-shaped input, JSON lines, envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import derived_event_id
from ..schema import API_EVENT, ENVELOPE, EVENT_COLUMNS, METRIC_EVENT

# Defaults of the API event model (fixed values).
DEFAULT_HOST = "unknown"
DEFAULT_REGION = "us-east-1"
MAX_ENVELOPE_EVENTS = 10000


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def adapt_events(raw: DataFrame) -> DataFrame:
    """Driver ``events`` table -> METRIC_EVENT rows without labels.

    Only five columns are read (column pruning reaches the scan)."""
    uid = F.col("user_id")
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("svc-"), (uid % 5).cast("string")).alias("service"),
        F.col("event_type").alias("metric_name"),
        F.col("value").cast("double").alias("value"),
        F.lit("u").alias("unit"),
        F.concat(F.lit("host-"), (uid % 10).cast("string")).alias("host"),
        F.concat(F.lit("r"), (uid % 3).cast("string")).alias("region"),
        F.lit(False).alias("is_anomaly"),
        F.lit(None).cast("string").alias("anomaly_type"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled metric events of the driver's test table."""
    return adapt_events(spark.read.parquet(table_path(sf_dir, "events")))


def with_api_defaults(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """Apply host/region defaults and convert epoch-ms to ``ts``.
    Returns all rows plus a boolean ``_valid`` (required fields present);
    ``keep`` names extra columns carried in front."""
    valid = (F.col("event_id").isNotNull() & F.col("timestamp").isNotNull()
             & F.col("service").isNotNull() & F.col("metric_name").isNotNull()
             & F.col("value").isNotNull())
    return df.select(
        *[F.col(k) for k in keep],
        F.col("event_id"),
        F.timestamp_micros((F.col("timestamp") * 1000).cast("long")).alias("ts"),
        F.col("service"), F.col("metric_name"), F.col("value").cast("double").alias("value"),
        F.lit(None).cast("string").alias("unit"),
        F.coalesce(F.col("host"), F.lit(DEFAULT_HOST)).alias("host"),
        F.coalesce(F.col("region"), F.lit(DEFAULT_REGION)).alias("region"),
        F.lit(False).alias("is_anomaly"),
        F.lit(None).cast("string").alias("anomaly_type"),
        valid.alias("_valid"),
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted METRIC_EVENT rows, rejected raw rows)."""
    d = with_api_defaults(df)
    return d.where("_valid").select(*EVENT_COLUMNS), d.where(~F.col("_valid")).drop("_valid")


def read_api_events(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(API_EVENT).format(fmt).load(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines dataset (one event per line, epoch-ms ``timestamp``)."""
    (df.withColumn("timestamp", F.unix_micros("ts") / F.lit(1000.0)).drop("ts")
       .write.mode(mode).json(path))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([f for f in METRIC_EVENT.fields if f.name != "ts"]
                          + [T.StructField("timestamp", T.DoubleType())])
    raw = spark.read.schema(schema).json(path)
    return raw.withColumn("ts", F.timestamp_micros((F.col("timestamp") * 1000).cast("long"))) \
              .select(*EVENT_COLUMNS)


def flatten_envelopes(env: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Request envelopes -> (defaulted events with request_id and position,
    rejected envelopes). An envelope is accepted when it holds 1..10000 events."""
    n = F.size("events")
    in_range = F.col("events").isNotNull() & (n >= 1) & (n <= MAX_ENVELOPE_EVENTS)
    rows = env.where(in_range).select("request_id", F.posexplode("events").alias("pos", "e")) \
              .select("request_id", "pos", "e.*")
    return with_api_defaults(rows, keep=("request_id", "pos")), env.where(~in_range)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(path)


def with_derived_ids(df: DataFrame) -> DataFrame:
    """Fill missing event ids from the natural key."""
    return df.withColumn("event_id", F.coalesce(F.col("event_id"), derived_event_id()))


def envelope_answers(scored: DataFrame) -> DataFrame:
    """S4 answer: per request, total events, anomalies and the per-event
    results in request order (a request holds at most 10000 events, so each
    group is bounded by the envelope validation)."""
    res = F.struct("pos", "event_id", "service", "metric_name", "value", "is_anomaly", "severity",
                   "ensemble_confidence", "votes")
    g = scored.groupBy("request_id").agg(F.count("*").alias("total"),
                                         F.count_if("is_anomaly").alias("anomalies"),
                                         F.array_sort(F.collect_list(res), lambda a, b: F.when(
                                             a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1)
                                             .otherwise(0)).alias("results"))
    return g.withColumn("results", F.transform("results", lambda r: r.dropFields("pos")))
