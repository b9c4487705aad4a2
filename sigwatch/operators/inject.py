"""Known-fault overlay (scenario injection) for back-testing on any event table.

The scenario table is small and its size is checked before it is broadcast.
Events meet it in a broadcast hash join on ``metric_name`` with the interval
and service test as join condition; when scenarios overlap, each event
instead picks the first match by priority from its metric's scenario array.
No cross join, no shuffle of the event table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import epoch_sec, hashed_normal, hashed_uniform
from ..schema import EVENT_COLUMNS

# Scenarios up to this many are broadcast; more are joined by time bucket.
BROADCAST_SCENARIOS = 10_000
BUCKET_SECONDS = 3600

SCENARIO_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("start_s", T.DoubleType(), False),
    T.StructField("end_s", T.DoubleType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("service", T.StringType(), True),
    T.StructField("base_mean", T.DoubleType(), False),
])

DAY = 86400.0

# Fixed scenario plan for the driver's 30-day event table (our design, the
# shape follows the reference's five fault kinds): name, start offset (s),
# duration (s), metric, service, baseline mean of the metric.
DEFAULT_PLAN = (
    ("pipeline_failure", 5 * DAY, 3 * DAY, "view", "svc-0", 50.0),
    ("memory_leak", 9 * DAY, 6 * DAY, "purchase", "svc-1", 50.0),
    ("traffic_spike", 16 * DAY, 2 * DAY, "click", "svc-2", 50.0),
    ("error_storm", 20 * DAY, 2 * DAY, "error", "svc-3", 50.0),
    ("network_degradation", 24 * DAY, 3 * DAY, "signup", "svc-4", 50.0),
)

# Memory-leak rows are labelled only above base_mean + this margin
# (reference: baseline mean 55, label above 85).
LEAK_LABEL_MARGIN = 30.0


@dataclass(frozen=True)
class Scenario:
    priority: int
    name: str
    start_s: float
    end_s: float
    metric_name: str
    service: str | None
    base_mean: float


def origin_epoch(origin: str) -> float:
    dt = datetime.strptime(origin, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    return dt.timestamp()


def scenario_plan(origin: str = "2024-01-01 00:00:00", plan=DEFAULT_PLAN) -> list[Scenario]:
    """``add_scenario(name, start, duration, metric, service)`` in list order."""
    o = origin_epoch(origin)
    return [Scenario(i + 1, n, o + s, o + s + d, m, sv, bm)
            for i, (n, s, d, m, sv, bm) in enumerate(plan)]


def scenario_table(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    rows = [(s.priority, s.name, float(s.start_s), float(s.end_s), s.metric_name, s.service,
             float(s.base_mean)) for s in scenarios]
    return spark.createDataFrame(rows, SCENARIO_SCHEMA)


def _overlapping(scenarios: DataFrame) -> bool:
    """True when two scenarios could match the same event: same metric,
    intersecting closed intervals, compatible services (checked on the small
    scenario table by an equi-join on metric)."""
    a = scenarios.alias("a")
    b = scenarios.alias("b")
    pairs = a.join(b, F.col("a.metric_name") == F.col("b.metric_name")).where(
        (F.col("a.priority") < F.col("b.priority"))
        & (F.col("a.start_s") <= F.col("b.end_s")) & (F.col("b.start_s") <= F.col("a.end_s"))
        & (F.col("a.service").isNull() | F.col("b.service").isNull()
           | (F.col("a.service") == F.col("b.service"))))
    return pairs.limit(1).count() > 0


def _match_by_bucket(events: DataFrame, scenarios: DataFrame, t, fields) -> DataFrame:
    """First matching scenario by priority, any number of scenarios: intervals
    are listed under every hour that they touch, and events meet them there."""
    hour = lambda x: F.floor(x / BUCKET_SECONDS)
    listed = scenarios.select(F.col("metric_name").alias("_sc_metric"), F.struct(*fields).alias("_one"),
                              F.explode(F.sequence(hour(F.col("start_s")), hour(F.col("end_s")))).alias("_hour"))
    hits = (events.select("event_id", "metric_name", "service", t.alias("_t"))
            .join(listed, (F.col("metric_name") == F.col("_sc_metric")) & (hour(F.col("_t")) == F.col("_hour")))
            .where((F.col("_one.start_s") <= F.col("_t")) & (F.col("_t") <= F.col("_one.end_s"))
                   & (F.col("_one.service").isNull() | (F.col("_one.service") == F.col("service"))))
            .groupBy("event_id").agg(F.min("_one").alias("_sc")))
    return events.join(hits, "event_id", "left")


def match_scenarios(events: DataFrame, scenarios: DataFrame, broadcast_rows: int = BROADCAST_SCENARIOS) -> DataFrame:
    """Add ``_sc`` (first matching scenario struct or null) and ``progress``.

    When no two scenarios can match the same event, this is a broadcast
    hash join on ``metric_name`` with the interval and service test as the
    join condition (codegen, at most one match per event). Otherwise every
    event takes the first match, by priority, from its metric's scenario array.
    A scenario table too large to broadcast is joined on (metric, hour)."""
    t = epoch_sec("ts")
    fields = ("priority", "name", "start_s", "end_s", "service", "base_mean")
    if scenarios.count() > broadcast_rows:
        joined = _match_by_bucket(events, scenarios, t, fields)
    elif not _overlapping(scenarios):
        sc = scenarios.select(F.col("metric_name").alias("_sc_metric"), F.struct(*fields).alias("_sc"))
        cond = ((F.col("metric_name") == F.col("_sc_metric")) & (F.col("_sc.start_s") <= t)
                & (t <= F.col("_sc.end_s"))
                & (F.col("_sc.service").isNull() | (F.col("_sc.service") == F.col("service"))))
        joined = events.join(F.broadcast(sc), cond, "left").drop("_sc_metric")
    else:
        by_metric = scenarios.groupBy("metric_name").agg(
            F.array_sort(F.collect_list(F.struct(*fields))).alias("_scs"))
        joined = events.join(F.broadcast(by_metric), "metric_name", "left")
        hits = F.filter("_scs", lambda x: (x["start_s"] <= t) & (t <= x["end_s"])
                        & (x["service"].isNull() | (x["service"] == F.col("service"))))
        joined = joined.withColumn("_sc", F.try_element_at(hits, F.lit(1))).drop("_scs")
    sc = F.col("_sc")
    span = sc["end_s"] - sc["start_s"]
    progress = F.when(span > 0, (t - sc["start_s"]) / span).otherwise(F.lit(0.0))
    return joined.withColumn("progress", progress)


def inject(events: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Overlay the matched scenario on value and labels."""
    m = match_scenarios(events, scenarios)
    name = F.col("_sc.name")
    mean = F.col("_sc.base_mean")
    p = F.col("progress")
    u = hashed_uniform("event_id", "-u")
    z = hashed_normal("event_id", "-n")
    new_value = (F.when(name == "pipeline_failure", F.round(mean * (10 + 10 * p) + 20 * z, 2))
                 .when(name == "memory_leak", F.round(mean + 40 * p + z, 2))
                 .when(name == "traffic_spike", F.round(mean * (5 + 3 * u), 1))
                 .when(name == "error_storm", F.round(0.30 + 0.30 * u, 4))
                 .when(name == "network_degradation", F.round(mean * (0.02 + 0.06 * u), 1))
                 .otherwise(F.col("value")))
    known = name.isin("pipeline_failure", "memory_leak", "traffic_spike", "error_storm",
                      "network_degradation")
    labelled = (F.when(name == "memory_leak", F.col("_new") > mean + LEAK_LABEL_MARGIN)
                .when(known, F.lit(True)).otherwise(F.col("is_anomaly")))
    out = (m.withColumn("_new", new_value)
            .withColumn("_lab", F.coalesce(labelled, F.lit(False)))
            .withColumn("anomaly_type", F.when(known & F.col("_lab"), name)
                        .otherwise(F.col("anomaly_type")))
            .withColumn("value", F.col("_new"))
            .withColumn("is_anomaly", F.col("_lab")))
    return out.select(*EVENT_COLUMNS)


def scenario_matches(events: DataFrame, scenarios: DataFrame) -> DataFrame:
    """J4 as a table: event id, matched scenario name and progress (matched rows only)."""
    m = match_scenarios(events, scenarios)
    return m.where(F.col("_sc").isNotNull()).select(
        "event_id", F.col("_sc.name").alias("scenario"), F.round("progress", 6).alias("progress"))
