"""Alerting: cooldown suppression, routing, alert rows, payloads, summary.

Cooldown (H1) is greedy in event-time order per (service, metric): an anomaly
fires when no alert of its key fired within ``cooldown_sec`` before it. Event
time replaces the reference's wall clock (deliberate; with ``cooldown_sec = 0``
nothing is suppressed). ``cooldown`` takes it by pointer doubling;
``segmented_cooldown`` is the same by folds, against which it is tested.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import alert_id, fround, iso_utc, percent2
from ..schema import AlertParams
from . import next_fire
from .carry import ordered_fold

KEY = ["service", "metric_name"]

# Fixed values (reference): Slack colour marks by severity, default mark.
SLACK_MARKS = {"Critical": "\U0001F534", "High": "\U0001F7E0", "Medium": "\U0001F7E1"}
SLACK_DEFAULT_MARK = "⚪"
PD_ROUTING_KEY = "SIMULATED_PD_ROUTING_KEY"


def _cooldown_fold(anomalies: DataFrame, cooldown_sec: float, key: list[str], state: DataFrame | None,
                   num_partitions: int | None = None) -> DataFrame:
    """Greedy cooldown per ``key`` starting from ``state`` (key..., last_fired_s).
    Output rows: fired anomalies (``_kind`` = r) and one end state per key (s)."""
    fields = [T.StructField(f.name, f.dataType, True) for f in anomalies.schema.fields]
    out_schema = T.StructType(fields + [T.StructField("last_fired_s", T.DoubleType()),
                                        T.StructField("_kind", T.StringType())])
    cols = anomalies.columns
    names = [f.name for f in out_schema.fields]
    cd = float(cooldown_sec)
    u = anomalies.withColumn("_phase", F.lit(1)).withColumn("last_fired_s", F.lit(None).cast("double"))
    if state is not None:
        fill = [F.col(f.name) if f.name in key else F.lit(None).cast(f.dataType).alias(f.name)
                for f in anomalies.schema.fields]
        u = u.unionByName(state.select(*fill, F.lit(0).alias("_phase"), "last_fired_s"))

    def factory(k, first):
        lf = first["last_fired_s"] if first["_phase"] == 0 else None
        st = {"last": None if lf is None or pd.isna(lf) else float(lf)}

        def step(pdf: pd.DataFrame):
            rows = pdf[pdf["_phase"] == 1]
            if rows.empty:
                return None
            t = (pd.to_datetime(rows["ts"]).to_numpy().astype("datetime64[us]").astype("int64") / 1e6).tolist()
            keep = []
            last = st["last"]
            for i, ti in enumerate(t):
                if last is None or not (ti - last < cd):
                    keep.append(i)
                    last = ti
            st["last"] = last
            out = rows.iloc[keep][cols].copy()
            out["last_fired_s"] = None
            out["_kind"] = "r"
            return out

        def finish():
            row = {c: None for c in names}
            row.update(dict(zip(key, k)))
            row["last_fired_s"] = st["last"]
            row["_kind"] = "s"
            return pd.DataFrame([row])

        step.finish = finish
        return step

    return ordered_fold(u, key, ["_phase", "ts", "event_id"], factory, out_schema, num_partitions)


def cooldown(anomalies: DataFrame, cooldown_sec: float, num_partitions: int | None = None,
             split_rows: int | None = None, segment_rows: int | None = None) -> DataFrame:
    """H1: keep the anomalies that fire, for keys of any size by pointer
    doubling (``next_fire``). ``split_rows`` and ``segment_rows`` have no
    effect; earlier callers may still pass them."""
    return next_fire.fired(anomalies, KEY, cooldown_sec, num_partitions)


def segmented_cooldown(anomalies: DataFrame, cooldown_sec: float, segment_seconds: int,
                       num_partitions: int | None = None) -> DataFrame:
    """Cooldown with every key cut into event-time segments folded in
    parallel; segment start states (last fired time) are iterated to their
    fixed point, so the result equals the sequential greedy fold. A segment
    forgets its start state one cooldown period after its first alert. Every
    pass settles one more segment at least, so the passes end, and none folds
    a whole key in one task."""
    from .small import materialize
    skey = KEY + ["_seg"]
    s = anomalies.withColumn("_seg", F.floor(F.unix_micros("ts") / F.lit(segment_seconds * 1_000_000)).cast("long"))
    segs = materialize(s.select(*KEY, "_seg").distinct()
                        .withColumn("_prev", F.lag("_seg").over(Window.partitionBy(*KEY).orderBy("_seg"))))
    start = None
    while True:
        out = _cooldown_fold(s, cooldown_sec, skey, start, num_partitions)
        end = materialize(out.where(F.col("_kind") == "s")
                          .select(*KEY, F.col("_seg").alias("_prev"), "last_fired_s"))
        # the last alert so far: latest end state among the earlier segments of the key
        chained = segs.where(F.col("_prev").isNotNull()).join(end, KEY + ["_prev"]) \
                      .select(*skey, "last_fired_s")
        w = Window.partitionBy(*KEY).orderBy("_seg").rowsBetween(Window.unboundedPreceding, 0)
        nxt = materialize(chained.withColumn("last_fired_s", F.max("last_fired_s").over(w))
                          .where(F.col("last_fired_s").isNotNull()))
        if start is not None:
            a, b = nxt.alias("a"), start.alias("b")
            on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in skey]
            changed = a.join(b, on, "full_outer").where(
                F.col("a._seg").isNull() | F.col("b._seg").isNull()
                | ~F.col("a.last_fired_s").eqNullSafe(F.col("b.last_fired_s")))
            if changed.limit(1).count() == 0:
                return out.where(F.col("_kind") == "r").select(*anomalies.columns)
        start = nxt


def route(sev, params: AlertParams = AlertParams()):
    """H2: severity -> channel."""
    c = F.col(sev) if isinstance(sev, str) else sev
    return (F.when(c.isin(*params.pagerduty), F.lit("pagerduty"))
             .when(c.isin(*params.slack), F.lit("slack")).otherwise(F.lit("log")))


def detectors_list(col="voted_detectors"):
    """Python-list rendering of the voting detector names: ``['A', 'B']``."""
    items = F.transform(F.col(col), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def alert_rows(fired: DataFrame, params: AlertParams = AlertParams()) -> DataFrame:
    """H3: ALERT rows of fired ensemble results."""
    msg = F.concat(
        F.lit("["), F.upper("severity"), F.lit("] Anomaly detected on "), F.col("service"),
        F.lit(" | metric="), F.col("metric_name"),
        F.lit(" | value="), F.format_string("%.4f", F.col("value")),
        F.lit(" | confidence="), percent2("ensemble_confidence"),
        F.lit(" | detectors="), detectors_list())
    return fired.select(
        alert_id().alias("alert_id"), iso_utc().alias("triggered_at"), "severity", "service",
        "metric_name", "value", F.col("ensemble_confidence").alias("confidence"),
        route("severity", params).alias("channel"), msg.alias("message"), "event_id",
        F.lit(False).alias("acknowledged"), "ts")


def pagerduty_fields(alerts: DataFrame) -> DataFrame:
    """S7 (flattened): PagerDuty trigger event fields."""
    return alerts.where(F.col("channel") == "pagerduty").select(
        F.lit(PD_ROUTING_KEY).alias("routing_key"), F.lit("trigger").alias("event_action"),
        F.col("alert_id").alias("dedup_key"), F.col("message").alias("summary"),
        F.lower("severity").alias("severity"), F.col("service").alias("source"),
        F.col("triggered_at").alias("timestamp"), F.col("metric_name").alias("metric"),
        "value", "confidence")


def pagerduty_json(alerts: DataFrame) -> DataFrame:
    """The nested payload document as JSON text, keyed by alert id."""
    f = pagerduty_fields(alerts)
    doc = F.struct(
        "routing_key", "event_action", "dedup_key",
        F.struct("summary", "severity", "source", "timestamp",
                 F.struct(F.col("metric"), F.col("value"), F.col("confidence")).alias("custom_details"))
        .alias("payload"))
    return f.select(F.col("dedup_key").alias("alert_id"), F.to_json(doc).alias("payload"))


def _mark(sev):
    e = F.when(F.col(sev) == "Critical", F.lit(SLACK_MARKS["Critical"]))
    for k in ("High", "Medium"):
        e = e.when(F.col(sev) == k, F.lit(SLACK_MARKS[k]))
    return e.otherwise(F.lit(SLACK_DEFAULT_MARK))


def slack_fields(alerts: DataFrame) -> DataFrame:
    """S8 (flattened): Slack message text and the two block texts."""
    m = _mark("severity")
    text = F.concat(m, F.lit(" *Anomaly Alert — "), F.col("severity"), F.lit("*"))
    block1 = F.concat(
        m, F.lit(" *"), F.col("severity"), F.lit(" Anomaly* on `"), F.col("service"), F.lit("`\n"),
        F.lit("*Metric:* `"), F.col("metric_name"), F.lit("` | *Value:* `"),
        F.format_string("%.4f", F.col("value")), F.lit("`\n"),
        F.lit("*Confidence:* `"), percent2("confidence"), F.lit("`\n"),
        F.lit("*Time:* `"), F.col("triggered_at"), F.lit("`"))
    block2 = F.concat(F.lit("*Message:* "), F.col("message"))
    return alerts.where(F.col("channel") == "slack").select(
        "alert_id", text.alias("text"), block1.alias("block1"), block2.alias("block2"))


def slack_json(alerts: DataFrame) -> DataFrame:
    """``{"text": .., "blocks": [{type, text{type, text}} x2]}`` as JSON text."""
    f = slack_fields(alerts)

    def block(c):
        return F.struct(F.lit("section").alias("type"),
                        F.struct(F.lit("mrkdwn").alias("type"), F.col(c).alias("text")).alias("text"))
    doc = F.struct(F.col("text"), F.array(block("block1"), block("block2")).alias("blocks"))
    return f.select("alert_id", F.to_json(doc).alias("payload"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Totals by nothing / severity / channel / service in one pass."""
    g = alerts.groupingSets([[], ["severity"], ["channel"], ["service"]],
                            "severity", "channel", "service") \
              .agg(F.count("*").alias("alerts"), F.grouping_id().alias("_gid"))
    dim = (F.when(F.col("_gid") == 7, "total").when(F.col("_gid") == 3, "severity")
           .when(F.col("_gid") == 5, "channel").otherwise("service"))
    key = F.coalesce("severity", "channel", "service", F.lit("all"))
    return g.select(dim.alias("dimension"), key.alias("key"), "alerts")


def recent_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` alerts (a top-n)."""
    return alerts.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(n)


def severity_share(alerts: DataFrame) -> DataFrame:
    """Percent of alerts per severity (window over the grouped rows)."""
    g = alerts.groupBy("severity").agg(F.count("*").alias("alerts"))
    return g.withColumn("share_pct", fround(F.col("alerts") * 100.0 / F.sum("alerts").over(Window.partitionBy()), 2))
