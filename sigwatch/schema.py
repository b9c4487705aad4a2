"""Canonical schemas and parameter objects."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

METRIC_EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("service", T.StringType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("host", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("is_anomaly", T.BooleanType(), True),
    T.StructField("anomaly_type", T.StringType(), True),
])

EVENT_COLUMNS = [f.name for f in METRIC_EVENT.fields]

# Raw input of the scoring API: the label columns and unit are absent and
# host / region are optional (defaults applied by ``sources.events``).
API_EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("timestamp", T.DoubleType(), True),
    T.StructField("service", T.StringType(), True),
    T.StructField("metric_name", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("host", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
])

ENVELOPE = T.StructType([
    T.StructField("request_id", T.StringType(), True),
    T.StructField("events", T.ArrayType(API_EVENT), True),
])

CHART_RESULT = T.StructType([
    T.StructField("z_score", T.DoubleType()),
    T.StructField("cusum_pos", T.DoubleType()),
    T.StructField("cusum_neg", T.DoubleType()),
    T.StructField("control_mean", T.DoubleType()),
    T.StructField("control_std", T.DoubleType()),
    T.StructField("upper_limit", T.DoubleType()),
    T.StructField("lower_limit", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("rule_triggered", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

ALERT_COLUMNS = ["alert_id", "triggered_at", "severity", "service", "metric_name",
                 "value", "confidence", "channel", "message", "event_id", "acknowledged"]

# Fixed values that must equal the reference: detector names in vote order,
# default fusion weights and severity cut-offs (checked highest first).
DETECTORS = ("IsolationForest", "Autoencoder", "ControlCharts")
DEFAULT_WEIGHTS = {"IsolationForest": 0.35, "Autoencoder": 0.35, "ControlCharts": 0.30}
SEVERITY_CUTS = (("Critical", 0.85), ("High", 0.65), ("Medium", 0.40), ("Low", 0.0))


@dataclass(frozen=True)
class ChartParams:
    sigma: float = 3.0
    cusum_k: float = 0.5
    cusum_h: float = 5.0
    window: int = 500
    min_window: int = 30
    adaptive: bool = True
    series_key: tuple = ("metric_name",)
    # a series is cut into segments of about so many rows, folded in parallel
    segment_rows: int = 500_000
    # no effect any more (series above this size were cut); callers may still set it
    split_rows: int = 2_000_000


@dataclass(frozen=True)
class ForestParams:
    trees: int = 200
    sample: int = 256
    contamination: float = 0.02
    threshold_percentile: float = 98.0
    seed: int = 42


@dataclass(frozen=True)
class AutoencoderParams:
    latent: int = 8
    hidden: tuple = (32, 16)
    lr: float = 0.001
    batch_size: int = 128
    epochs: int = 80
    epochs_per_round: int = 10
    # fewest shards, and rows per shard: shards follow the data
    shards: int = 4
    shard_rows: int = 50_000
    threshold_percentile: float = 97.5
    seed: int = 42


@dataclass(frozen=True)
class AlertParams:
    cooldown_sec: float = 60.0
    pagerduty: tuple = ("Critical", "High")
    slack: tuple = ("Medium",)
    audit_scope: str = "fired"  # "fired" (reference behaviour) or "all"


@dataclass(frozen=True)
class RunParams:
    """How the driver's test tables are cut into baseline and stream."""
    origin: str = "2024-01-01 00:00:00"
    baseline_days: int = 3
    batch_rows: int = 500
    fusion: str = "majority_vote"
    weights: dict = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
