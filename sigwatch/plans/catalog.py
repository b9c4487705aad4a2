"""Query catalogue: each entry takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through the adapter; doubles are
rounded to 4 places so the DuckDB oracle (``plans.sql``) compares exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import derived_event_id, epoch_ms, fround, severity
from ..operators import charts
from ..operators.inject import scenario_matches
from ..operators.quantiles import percentiles
from ..sources.events import flatten_envelopes, load_events, split_valid
from . import data

R = 4


def r(col, k: int = R):
    return F.round(col if not isinstance(col, str) else F.col(col), k)


def _lev(spark, sf_dir):
    return data.labelled_events(spark, sf_dir)


# ------------------------------------------------------------------ step 0 / 1

def breach_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: which service/metric broke its fitted 3-sigma limits, how
    often and how badly (A1 + D12 + P7 + A9-style summary)."""
    lev = _lev(spark, sf_dir)
    stats = charts.fitted_stats(data.baseline(lev))
    sh = charts.shewhart(data.stream(lev), stats)
    conf = F.least(F.abs("z_score") / F.lit(6.0), F.lit(1.0))
    g = sh.withColumn("_conf", F.round(conf, 4)).groupBy("service", "metric_name").agg(
        F.count("*").alias("events"),
        F.count_if("breach").alias("breaches"),
        F.max(F.when(F.col("breach"), F.col("_conf"))).alias("_worst"),
        r(F.max(F.abs("z_score"))).alias("max_abs_z"))
    return g.select("service", "metric_name", "events", "breaches",
                    r(F.col("breaches") / F.col("events")).alias("breach_rate"),
                    "max_abs_z",
                    F.coalesce(severity(F.col("_worst")), F.lit("Normal")).alias("worst_severity"))


def metric_baseline_stats(spark, sf_dir):
    """A1: per-metric baseline mean, population std (+1e-8) and count."""
    st = charts.fitted_stats(data.baseline(_lev(spark, sf_dir)))
    return st.select("metric_name", "n", r("fit_mean").alias("fit_mean"), r("fit_std").alias("fit_std"))


def percentile_thresholds(spark, sf_dir):
    """A2: linear-interpolation percentiles (2nd and 97.5th) per metric."""
    b = data.baseline(_lev(spark, sf_dir))
    p = percentiles(b, "value", {"p02": 0.02, "p975": 0.975}, ("metric_name",))
    return p.select("metric_name", r("p02").alias("p02"), r("p975").alias("p975"))


def dataset_summary(spark, sf_dir):
    """A3 + A15: totals, labelled anomalies, rate and the distinct domains."""
    lev = _lev(spark, sf_dir)
    return lev.agg(
        F.count("*").alias("total_events"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(~F.col("is_anomaly")).alias("normal"),
        r(F.avg(F.col("is_anomaly").cast("int"))).alias("anomaly_rate"),
        # scenario names are bounded by the scenario table; metric and service
        # domains are counted here (their names are rows of ``distinct_metrics``)
        F.array_join(F.array_sort(F.collect_set("anomaly_type")), ",").alias("anomaly_types"),
        F.count_distinct("metric_name").alias("metrics"),
        F.count_distinct("service").alias("services"))


def baseline_split(spark, sf_dir):
    """P1 + P2: which part each event belongs to."""
    lev = _lev(spark, sf_dir)
    cut = data.cut_col()
    part = (F.when(F.col("ts") >= cut, "stream")
            .when(~F.col("is_anomaly"), "baseline").otherwise("excluded"))
    return lev.select("event_id", part.alias("part"))


def distinct_metrics(spark, sf_dir):
    """Distinct metric names and anomaly types."""
    lev = _lev(spark, sf_dir)
    a = lev.select(F.lit("metric").alias("kind"), F.col("metric_name").alias("name")).distinct()
    b = lev.where(F.col("anomaly_type").isNotNull()) \
           .select(F.lit("anomaly_type").alias("kind"), F.col("anomaly_type").alias("name")).distinct()
    return a.unionByName(b)


def append_batches(spark, sf_dir):
    """Baseline and stream appended into one table (by name)."""
    lev = _lev(spark, sf_dir)
    b = data.baseline(lev).select("event_id", "metric_name", "value", F.lit("baseline").alias("part"))
    s = data.stream(lev).select("event_id", "metric_name", "value", F.lit("stream").alias("part"))
    return b.unionByName(s)


def metric_slice(spark, sf_dir, metric: str = "view", n: int = 800):
    """The first ``n`` stream rows of one metric (a top-n by time)."""
    s = data.stream(_lev(spark, sf_dir)).where(F.col("metric_name") == metric)
    top = s.orderBy("ts", "event_id").limit(n)
    return top.select("event_id", epoch_ms().alias("timestamp"), "value", "is_anomaly")


def event_defaults(spark, sf_dir):
    """API-shaped rows with missing host/region get the defaults; rows
    missing a required field are rejected."""
    ev = load_events(spark, sf_dir)
    eid = F.col("event_id").cast("long")
    api = ev.select(
        F.when(eid % 97 == 0, F.lit(None)).otherwise(F.col("event_id")).alias("event_id"),
        epoch_ms().alias("timestamp"), "service", "metric_name", "value",
        F.when(eid % 7 == 0, F.lit(None)).otherwise(F.col("host")).alias("host"),
        F.when(eid % 11 == 0, F.lit(None)).otherwise(F.col("region")).alias("region"))
    ok, bad = split_valid(api)
    return (ok.select("event_id", "host", "region", F.lit(True).alias("accepted"))
              .unionByName(bad.select("event_id", "host", "region", F.lit(False).alias("accepted"))))


def derived_event_id_q(spark, sf_dir):
    """Deterministic 16-hex ids from (ts, service, metric, host)."""
    ev = load_events(spark, sf_dir)
    return ev.select("event_id", derived_event_id().alias("derived_id"))


def scenario_match(spark, sf_dir):
    """J4 + I6: first matching scenario per event and its progress."""
    return scenario_matches(load_events(spark, sf_dir), data.scenarios(spark))


def inject_scenario(name: str):
    def q(spark, sf_dir):
        lev = _lev(spark, sf_dir)
        m = scenario_matches(load_events(spark, sf_dir), data.scenarios(spark)) \
            .where(F.col("scenario") == name).select("event_id")
        return lev.join(m, "event_id").select("event_id", "value", "is_anomaly", "anomaly_type")
    q.__name__ = f"inject_{name}"
    q.__doc__ = f"I1-I5: overlaid values and labels of the {name} rows."
    return q


SCENARIO_NAMES = ("pipeline_failure", "memory_leak", "traffic_spike", "error_storm",
                  "network_degradation")


def shewhart_flags(spark, sf_dir):
    """D12 + J3: fitted-limit z and flag for every stream row."""
    lev = _lev(spark, sf_dir)
    sh = charts.shewhart(data.stream(lev), charts.fitted_stats(data.baseline(lev)))
    return sh.select("event_id", "metric_name", r("z_score").alias("z_score"),
                     r("upper_limit").alias("upper_limit"), r("lower_limit").alias("lower_limit"),
                     F.col("breach").alias("is_anomaly"))


SERIES = ("service", "metric_name")


def reference_limits_q(spark, sf_dir):
    """First-100 reference mean/std and 3-sigma limits per series."""
    lim = charts.reference_limits(data.stream(_lev(spark, sf_dir)), SERIES)
    return lim.select(*SERIES, r("ref_mean").alias("ref_mean"), r("ref_std").alias("ref_std"),
                      r("ucl").alias("ucl"), r("lcl").alias("lcl"))


def limit_violations_q(spark, sf_dir):
    """Stream rows outside their series' reference limits."""
    s = data.stream(_lev(spark, sf_dir))
    v = charts.limit_violations(s, charts.reference_limits(s, SERIES), SERIES)
    return v.select("event_id", *SERIES, "value", "side")


def cusum_scan_q(spark, sf_dir):
    """CUSUM without reset per series (prefix-scan form)."""
    s = data.stream(_lev(spark, sf_dir))
    lim = charts.reference_limits(s, SERIES, eps=1e-8)
    c = charts.cusum_scan(s, lim, SERIES)
    return c.select("event_id", *SERIES, r("z").alias("z"), r("cusum_pos").alias("cusum_pos"),
                    r("cusum_neg").alias("cusum_neg"))


def label_zones_q(spark, sf_dir):
    """Runs of labelled rows per series (gaps and islands)."""
    z = charts.label_zones(data.stream(_lev(spark, sf_dir)), SERIES)
    return z.select(*SERIES, "first_event_id", "last_event_id", "n_rows")


def control_chart_series(spark, sf_dir, metric: str = "purchase", n: int = 600):
    """V4: first ``n`` stream rows of one metric with first-100 limits, the
    CUSUM pair and 3-sigma violations (chart dataset; the limit is the feature)."""
    s = data.stream(_lev(spark, sf_dir)).where(F.col("metric_name") == metric)
    head = s.orderBy("ts", "event_id").limit(n)
    lim = charts.reference_limits(head, ("metric_name",), eps=1e-8)
    c = charts.cusum_scan(head, lim, ("metric_name",))
    return c.select(F.col("_rn").alias("idx"), "event_id", "value", "is_anomaly",
                    r("ucl").alias("ucl"), r("lcl").alias("lcl"),
                    r("cusum_pos").alias("cusum_pos"), r("cusum_neg").alias("cusum_neg"),
                    ((F.col("value") > F.col("ucl")) | (F.col("value") < F.col("lcl"))).alias("violation"))


# ------------------------------------------------------------------ features

from ..operators import features as FT  # noqa: E402
from ..schema import ChartParams  # noqa: E402

BATCH = data.RUN.batch_rows


def indexed_stream(spark, sf_dir):
    lev = _lev(spark, sf_dir)
    return FT.add_row_index(data.stream(lev), batch_rows=BATCH)


def micro_batch_index(spark, sf_dir):
    """Exact stream position and 500-row batch key (no global window)."""
    return indexed_stream(spark, sf_dir).select("event_id", "row_idx", "batch_key")


def forest_features_q(spark, sf_dir):
    """D1 + P3 + W2: isolation-forest features per stream row."""
    f = FT.forest_features(indexed_stream(spark, sf_dir))
    return f.select("event_id", "batch_key", *[r(c).alias(c) for c in FT.FOREST_FEATURES])


def forest_scaler_q(spark, sf_dir):
    """Standard scaler of the baseline forest features (std 0 -> 1)."""
    f = FT.whole_sequence(data.baseline(_lev(spark, sf_dir)), FT.forest_features)
    s = FT.scaler(f, FT.FOREST_FEATURES, zero_std_to_one=True)
    return s.select(*[r(c).alias(c) for c in s.columns])


def autoencoder_features_q(spark, sf_dir):
    """D5 + P4 + P5 + W3: the six autoencoder features per stream row."""
    b = data.baseline(_lev(spark, sf_dir))
    f = FT.autoencoder_features(indexed_stream(spark, sf_dir), FT.metric_index(b))
    return f.select("event_id", *[r(c).alias(c) for c in FT.AE_FEATURES])


def autoencoder_scaler_q(spark, sf_dir):
    """Mean / population std of the baseline autoencoder features."""
    b = data.baseline(_lev(spark, sf_dir))
    mi = FT.metric_index(b)
    f = FT.whole_sequence(b, lambda rows: FT.autoencoder_features(rows, mi))
    s = FT.scaler(f, FT.AE_FEATURES, zero_std_to_one=False)
    return s.select(*[r(c).alias(c) for c in s.columns])


def batch_minmax_confidence_q(spark, sf_dir):
    """W4 + P13: batch min-max confidence with ``value`` as the score."""
    f = FT.batch_minmax_confidence(indexed_stream(spark, sf_dir), "value", "confidence")
    return f.select("event_id", "batch_key", r("confidence").alias("confidence"))


# ------------------------------------------------------------------ adaptive charts

CHART_OUT = ["z_score", "cusum_pos", "cusum_neg", "control_mean", "control_std", "upper_limit",
             "lower_limit", "cc_is_anomaly", "rule_triggered", "cc_confidence"]


def _chart(spark, sf_dir, params: ChartParams, baseline_filter=None):
    lev = _lev(spark, sf_dir)
    s = data.stream(lev).select("event_id", "ts", "service", "metric_name", "value")
    b = data.baseline(lev).select("event_id", "ts", "service", "metric_name", "value")
    if baseline_filter is not None:
        b = b.where(baseline_filter)
    out = charts.adaptive_chart(s, b, params)
    return out.select("event_id", *list(params.series_key), *CHART_OUT)


def adaptive_control_chart(spark, sf_dir):
    """D9 + D11 (reference keying by metric name): adaptive 3-sigma + CUSUM."""
    return _chart(spark, sf_dir, ChartParams())


def fixed_control_chart(spark, sf_dir):
    """Non-adaptive chart (fitted limits, window takes every value)."""
    return _chart(spark, sf_dir, ChartParams(adaptive=False))


def series_control_chart(spark, sf_dir):
    """One chart per (service, metric) series."""
    return _chart(spark, sf_dir, ChartParams(series_key=("service", "metric_name")))


def unseen_series(spark, sf_dir):
    """Series without a baseline start from mean 0 / std 1 (svc-4 unseen)."""
    return _chart(spark, sf_dir, ChartParams(series_key=("service", "metric_name")),
                  baseline_filter=F.col("service") != "svc-4")


# ------------------------------------------------------------------ fusion, alerts, evaluation
# The SQL-checkable detector trio: fitted 3-sigma (D12), CUSUM scan (W8) and
# the adaptive chart (D9); all three are fused like the reference's detectors.

from ..operators import alerts as AL  # noqa: E402
from ..operators import ensemble as EN  # noqa: E402
from ..operators import evaluate as EV  # noqa: E402
from ..schema import AlertParams  # noqa: E402

TRIO = [("Shewhart", "sh_vote", "sh_conf"), ("Cusum", "cu_vote", "cu_conf"),
        ("ControlCharts", "cc_is_anomaly", "cc_confidence")]
TRIO_WEIGHTS = {"Shewhart": 0.35, "Cusum": 0.35, "ControlCharts": 0.30}
COOLDOWN_SEC = 86400.0


def _lev_once(spark, sf_dir, metric: str | None = None) -> DataFrame:
    """The labelled events (of a metric) as a table: the trio's detectors, fits
    and cuts read them seven times, the overlay is computed once."""
    lev = _lev(spark, sf_dir)
    if metric is not None:
        lev = lev.where(F.col("metric_name") == metric)
    return written(lev.select("event_id", "ts", "service", "metric_name", "value", "is_anomaly", "anomaly_type"),
                   "labelled")


def trio_scored(spark, sf_dir, metric: str | None = None) -> DataFrame:
    """Stream rows with the three detectors' votes and confidences; labels
    are renamed to ``label`` / ``label_type``. Every detector works within a
    metric, so a wanted ``metric`` is picked before they run."""
    lev = _lev_once(spark, sf_dir, metric)
    base = data.baseline(lev).select("event_id", "ts", "service", "metric_name", "value")
    s = (data.stream(lev).withColumnRenamed("is_anomaly", "label")
         .withColumnRenamed("anomaly_type", "label_type")
         .select("event_id", "ts", "service", "metric_name", "value", "label", "label_type"))
    # fits are tables before the stream meets them: where the planner knows that they are small,
    # the stream is not gathered by metric for the join, and each hour of a series stays a key of its own
    sh = charts.shewhart(s, written(charts.fitted_stats(base), "stats"))
    sh = sh.select(*s.columns, F.col("breach").alias("sh_vote"),
                   fround(F.least(F.abs("z_score") / 6.0, F.lit(1.0)), 4).alias("sh_conf"))
    lim = written(charts.reference_limits(s, SERIES, eps=1e-8), "limits")
    cu = charts.cusum_scan(sh, lim, SERIES)
    cu = cu.select(*sh.columns, F.col("cusum_alarm").alias("cu_vote"),
                   fround(F.least(F.greatest("cusum_pos", "cusum_neg") / 10.0, F.lit(1.0)), 4).alias("cu_conf"))
    return charts.adaptive_chart(cu, base, ChartParams(), rows=s)


def fused(spark, sf_dir, strategy="majority_vote", metric: str | None = None):
    return EN.fuse(trio_scored(spark, sf_dir, metric), TRIO, strategy, TRIO_WEIGHTS)


def _fuse_q(strategy):
    def q(spark, sf_dir):
        f = fused(spark, sf_dir, strategy)
        return f.select("event_id", "is_anomaly", "ensemble_confidence", "severity",
                        F.size("voted_detectors").alias("n_votes"))
    q.__name__ = f"fuse_{strategy}"
    q.__doc__ = f"F1-F5 + P7: {strategy} fusion of the detector trio."
    return q


def fired_alerts(spark, sf_dir, cooldown_sec=COOLDOWN_SEC):
    f = fused(spark, sf_dir).where("is_anomaly")
    # an alert row shows the voters' names, neither the two maps nor the labels
    f = f.select("event_id", "ts", *AL.KEY, "value", "ensemble_confidence", "severity", "voted_detectors")
    return AL.alert_rows(AL.cooldown(f, cooldown_sec))


def alert_cooldown(spark, sf_dir):
    """H1: anomalies that fire under a one-day event-time cooldown per key."""
    f = fused(spark, sf_dir).where("is_anomaly").select("event_id", "ts", *AL.KEY)
    return AL.cooldown(f, COOLDOWN_SEC).select("event_id", "service", "metric_name")


def alert_rows_q(spark, sf_dir):
    """H2 + H3 + P8-P10: alert rows with channel and message."""
    return fired_alerts(spark, sf_dir).drop("ts")


def alert_pipeline(spark, sf_dir):
    """H4 + S5 rows: audit records of fired alerts with partition columns."""
    f = fused(spark, sf_dir).where("is_anomaly")
    f = f.select("event_id", "ts", *AL.KEY, "value", "is_anomaly", "ensemble_confidence", "severity")
    fired = AL.cooldown(f, COOLDOWN_SEC)
    return fired.select("event_id", "service", "metric_name", "value", "is_anomaly",
                        "ensemble_confidence", "severity",
                        F.date_format("ts", "yyyy-MM-dd").alias("date"),
                        AL.route("severity").alias("channel"))


def pagerduty_payload(spark, sf_dir):
    """S7 (flattened fields)."""
    return AL.pagerduty_fields(fired_alerts(spark, sf_dir))


def slack_payload(spark, sf_dir):
    """S8 (flattened fields)."""
    return AL.slack_fields(fired_alerts(spark, sf_dir))


def alert_summary_q(spark, sf_dir):
    """Alert totals by severity / channel / service (grouping sets)."""
    return AL.alert_summary(fired_alerts(spark, sf_dir))


def recent_alerts_q(spark, sf_dir):
    """The last 20 alerts."""
    return AL.recent_alerts(fired_alerts(spark, sf_dir)).select("alert_id", "triggered_at", "severity",
                                                                 "channel", "event_id")


def severity_share_q(spark, sf_dir):
    """Share of alerts per severity."""
    return AL.severity_share(fired_alerts(spark, sf_dir))


METHODS = [("Shewhart", "sh_vote", "sh_conf"), ("Cusum", "cu_vote", "cu_conf"),
           ("ControlCharts", "cc_is_anomaly", "cc_confidence"),
           ("Ensemble", "is_anomaly", "ensemble_confidence")]


def _long(spark, sf_dir):
    return EV.unpivot_methods(fused(spark, sf_dir), METHODS)


def confusion_q(spark, sf_dir):
    """A4 + J2: confusion counts per method."""
    c = EV.confusion(_long(spark, sf_dir))
    return c.select("method", "total_events", "true_positives", "false_positives",
                    "true_negatives", "false_negatives")


def quality_metrics(spark, sf_dir):
    """A5: precision, recall, F1, accuracy, FPR per method."""
    c = EV.confusion(_long(spark, sf_dir))
    return c.select("method", "precision", "recall", "f1", "accuracy", "false_positive_rate")


def confidence_by_label(spark, sf_dir):
    """Mean confidence of labelled / unlabelled rows per method."""
    c = EV.confusion(_long(spark, sf_dir))
    return c.select("method", "avg_confidence_anomaly", "avg_confidence_normal")


def per_type_recall(spark, sf_dir):
    """Per method and anomaly type: count, detected, recall."""
    return EV.per_type(_long(spark, sf_dir))


def detector_report(spark, sf_dir):
    """A8 + V2: all rates of all methods from one scan."""
    return EV.confusion(_long(spark, sf_dir))


def detection_lag_q(spark, sf_dir):
    """J5 + W9: lag from first labelled row to first detection per scenario."""
    return EV.detection_lag(_long(spark, sf_dir))


def lag_sla_q(spark, sf_dir):
    """A11 + V5: lag bands and the 4 s SLA flag."""
    return EV.lag_sla(EV.detection_lag(_long(spark, sf_dir)))


def kpi_row(spark, sf_dir):
    """A12 + V6: one-row run summary of the fused detector."""
    f = materialize(fused(spark, sf_dir))  # read by four aggregates
    long = EV.unpivot_methods(f, METHODS[3:])
    q = EV.confusion(long).select("precision", "recall", "f1")
    lag = EV.mean_lag(EV.detection_lag(long)).select("avg_lag_sec")
    alerts = AL.cooldown(f.where("is_anomaly"), COOLDOWN_SEC).agg(F.count("*").alias("alerts_fired"))
    ev = f.agg(F.count("*").alias("events"), F.count_if("is_anomaly").alias("anomalies_detected"))
    # four one-row aggregates stacked and folded into one row (no cross join)
    parts = ev.unionByName(q, allowMissingColumns=True).unionByName(alerts, allowMissingColumns=True) \
              .unionByName(lag, allowMissingColumns=True)
    cols = ["events", "anomalies_detected", "precision", "recall", "f1", "alerts_fired", "avg_lag_sec"]
    return parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def confidence_histogram_q(spark, sf_dir):
    """A13 + V3: density histogram of the fused confidence by flag."""
    return EV.confidence_histogram(fused(spark, sf_dir))


def timeline_rows(spark, sf_dir, metric="view", n=800):
    """W11 + V1: first ``n`` rows of one metric with flag, label and confidence."""
    f = fused(spark, sf_dir, metric=metric)
    head = f.orderBy("ts", "event_id").limit(n)
    w = Window.orderBy("ts", "event_id")
    return head.select(F.row_number().over(w).cast("long").alias("idx"), "event_id", "value", "label",
                       "is_anomaly", "ensemble_confidence")


def bucket_kpi(spark, sf_dir):
    """Per day and service: events, flagged anomalies, labelled anomalies."""
    f = fused(spark, sf_dir)
    g = f.groupBy(F.window("ts", "1 day").alias("w"), "service").agg(
        F.count("*").alias("events"), F.count_if("is_anomaly").alias("flagged"),
        F.count_if("label").alias("labelled"))
    return g.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "service", "events",
                    "flagged", "labelled")


# ------------------------------------------------------------------ model detectors (rows-only checks)

from . import pipeline as PL  # noqa: E402
from ..operators import autoencoder as AEm  # noqa: E402
from ..operators import forest as IFm  # noqa: E402
from ..operators.small import materialize, written  # noqa: E402


def _fit_inputs(spark, sf_dir):
    lev = _lev(spark, sf_dir)
    base = data.baseline(lev)
    mi = FT.metric_index(base)
    b = FT.whole_sequence(base, lambda rows: FT.autoencoder_features(rows, mi)).select("event_id", *FT.AE_FEATURES)
    b = materialize(b)  # read by several fit jobs
    s = FT.autoencoder_features(FT.add_row_index(data.stream(lev), batch_rows=BATCH), mi)
    return b, s


def forest_scores(spark, sf_dir):
    """D2 + D3 + W4: forest fitted on the baseline, stream scored in 500-row batches."""
    b, s = _fit_inputs(spark, sf_dir)
    forest = IFm.fit_forest(b, FT.FOREST_FEATURES)
    d = FT.batch_minmax_confidence(IFm.decision(s, FT.FOREST_FEATURES, forest), "if_decision", "_c")
    return d.select("event_id", "if_score", "if_is_anomaly", F.round("_c", 4).alias("if_confidence"))


def autoencoder_scores(spark, sf_dir):
    """D6 + D7: autoencoder fitted on the baseline, stream reconstruction errors."""
    b, s = _fit_inputs(spark, sf_dir)
    model = AEm.fit_autoencoder(b, FT.AE_FEATURES)
    return AEm.score(s, FT.AE_FEATURES, model).select("event_id", "reconstruction_error", "ae_is_anomaly",
                                                      "ae_confidence")


def autoencoder_loss(spark, sf_dir):
    """Mean training loss per epoch."""
    b, _ = _fit_inputs(spark, sf_dir)
    return AEm.loss_table(spark, AEm.fit_autoencoder(b, FT.AE_FEATURES))


def ensemble_scores(spark, sf_dir):
    """F6 + F7: the reference's three detectors fused by majority vote."""
    _, out = PL.run(spark, sf_dir)
    return out.select("event_id", "service", "metric_name", "value", "is_anomaly", "ensemble_confidence",
                      "severity", "votes", "detector_confidences", "fusion_strategy")


def single_event(spark, sf_dir):
    """F8: every stream event scored as its own one-event batch (IF confidence
    and difference are 0 there, as in the reference)."""
    lev = _lev(spark, sf_dir)
    models = PL.fit(data.baseline(lev))
    out = PL.score(data.stream(lev), models, batch_rows=None)
    return out.select("event_id", "is_anomaly", "severity", "ensemble_confidence", "votes")


def ensemble_report(spark, sf_dir):
    """A8 over the reference's detectors: IF, AE, CC and the fused result."""
    _, out = PL.run(spark, sf_dir)
    methods = [("IsolationForest", "if_is_anomaly", "if_confidence"),
               ("Autoencoder", "ae_is_anomaly", "ae_confidence"),
               ("ControlCharts", "cc_is_anomaly", "cc_confidence"),
               ("Ensemble", "is_anomaly", "ensemble_confidence")]
    return EV.confusion(EV.unpivot_methods(out, methods))


def prediction_alignment(spark, sf_dir):
    """Predictions and ground truth joined on event id (full outer); the
    reference's length assertion becomes the two unmatched counts (both 0)."""
    pred = fused(spark, sf_dir).select("event_id", F.col("is_anomaly").alias("pred"))
    truth = data.stream(_lev(spark, sf_dir)).select("event_id", F.col("is_anomaly").alias("truth"))
    j = pred.join(truth, "event_id", "full_outer")
    return j.agg(F.count_if(F.col("pred").isNotNull() & F.col("truth").isNotNull()).alias("matched"),
                 F.count_if(F.col("truth").isNull()).alias("predictions_without_label"),
                 F.count_if(F.col("pred").isNull()).alias("labels_without_prediction"),
                 F.count_if(F.col("pred") & F.col("truth")).alias("true_positives"))


def service_counters(spark, sf_dir):
    """A10: per service: requests scored, anomalies detected, alerts fired."""
    f = written(fused(spark, sf_dir).select(*AL.KEY, "event_id", "ts", "is_anomaly"), "fused")  # read twice
    fired = AL.cooldown(f.where("is_anomaly"), COOLDOWN_SEC).select("event_id").withColumn("_fired", F.lit(1))
    j = f.join(fired, "event_id", "left")
    return j.groupBy("service").agg(F.count("*").alias("requests"),
                                    F.count_if("is_anomaly").alias("anomalies_detected"),
                                    F.count("_fired").alias("alerts_fired"))


def lag_summary(spark, sf_dir):
    """Mean lag over detected scenarios per method and the 4 s SLA flag."""
    return EV.mean_lag(EV.detection_lag(_long(spark, sf_dir)))


# ---- checked forms of the models, joins and summaries ---------------------------

from ..operators import forest_table as FTB  # noqa: E402
from ..operators import sketches as SK  # noqa: E402
from ..operators.quantiles import percentiles  # noqa: E402
from ..operators.scan import prefix_scan  # noqa: E402

FOREST_TREES, FOREST_SAMPLE, FOREST_SHARE = 100, 128, 0.02


def forest_table_scores(spark, sf_dir):
    """D2 + D3 over a node table that SQL can grow and walk as well: stream rows
    whose paths are shorter than the 2 % shortest of the baseline are flagged."""
    base = FT.whole_sequence(data.baseline(_lev(spark, sf_dir)), FT.forest_features).select("event_id", *FT.FOREST_FEATURES)
    base = materialize(base)  # read by several fit jobs
    table = FTB.fit(base, FT.FOREST_FEATURES, FOREST_TREES, FOREST_SAMPLE)
    trained = FTB.score(base, FT.FOREST_FEATURES, table)
    limit = percentiles(trained, "path_sum", {"limit": FOREST_SHARE}).first()["limit"]
    out = FTB.score(FT.forest_features(indexed_stream(spark, sf_dir)), FT.FOREST_FEATURES, table)
    return out.select("event_id", "path_sum", F.round("raw_score", 6).alias("score"),
                      (F.col("path_sum") < F.lit(limit)).alias("flagged"))


def quantile_sketch(spark, sf_dir):
    """A2 from sketches: per metric and day one KLL sketch, merged per metric;
    whether the thresholds' ranks are within the sketch's error."""
    base = data.baseline(_lev(spark, sf_dir)).select("metric_name", "ts", "value")
    merged = SK.merged(SK.by_bucket(base, ["metric_name"], "value", F.to_date("ts")), ["metric_name"])
    return SK.rank_check(base, merged, ["metric_name"], "value", {"p02": 0.02, "p975": 0.975})


def fuse_joined(spark, sf_dir):
    """The detectors run apart, each with its own result table, joined on
    the event id and fused; equal to the single plan's majority vote."""
    lev = _lev_once(spark, sf_dir)
    cols = ["event_id", "ts", "service", "metric_name", "value"]
    base, s = data.baseline(lev).select(*cols), data.stream(lev).select(*cols)
    sh = charts.shewhart(s, written(charts.fitted_stats(base), "stats")).select(
        "event_id", F.col("breach").alias("sh_vote"), fround(F.least(F.abs("z_score") / 6.0, F.lit(1.0)), 4).alias("sh_conf"))
    lim = written(charts.reference_limits(s, SERIES, eps=1e-8), "limits")
    cu = charts.cusum_scan(s, lim, SERIES).select(
        "event_id", F.col("cusum_alarm").alias("cu_vote"),
        fround(F.least(F.greatest("cusum_pos", "cusum_neg") / 10.0, F.lit(1.0)), 4).alias("cu_conf"))
    cc = charts.adaptive_chart(s, base, ChartParams()).select("event_id", "cc_is_anomaly", "cc_confidence")
    j = s.join(sh, "event_id", "left").join(cu, "event_id", "left").join(cc, "event_id", "left")
    f = EN.fuse(j, TRIO, "majority_vote", TRIO_WEIGHTS)
    return f.select("event_id", "is_anomaly", "ensemble_confidence", "severity", F.size("voted_detectors").alias("n_votes"))


def alert_audit_summary(spark, sf_dir):
    """A9 whole: alerts by severity, channel and service, and the number of
    audit records (one a fired alert) with their partitions."""
    alerts = materialize(fired_alerts(spark, sf_dir))  # read twice
    audit = alerts.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), "service")
    counts = audit.agg(F.count("*").alias("records"), F.count_distinct("date", "service").alias("partitions"))
    rows = counts.select(F.lit("audit").alias("dimension"),
                         F.explode(F.create_map(F.lit("records"), F.col("records"), F.lit("partitions"), F.col("partitions")))
                         .alias("key", "alerts"))
    return AL.alert_summary(alerts).unionByName(rows)


def timeline_slice(spark, sf_dir):
    """V1 whole: a metric's first 800 rows with the reference limits of its
    series, the side of a violation and the number of the labelled zone."""
    head = materialize(data.stream(_lev(spark, sf_dir)).where(F.col("metric_name") == "view")
                       .select("event_id", "ts", "service", "metric_name", "value", "is_anomaly")
                       .orderBy("ts", "event_id").limit(800))  # the slice is the feature
    lim = charts.reference_limits(head, SERIES, eps=1e-8).select(*SERIES, "ucl", "lcl")
    zone = prefix_scan(head.withColumn("_gap", F.when(F.col("is_anomaly"), 0.0).otherwise(1.0)), SERIES, ["ts", "event_id"],
                       sums={"_island": "_gap"})
    j = zone.join(lim, list(SERIES), "left")
    side = F.when(F.col("value") > F.col("ucl"), "above").when(F.col("value") < F.col("lcl"), "below").otherwise("")
    return j.select("event_id", "service", "value", "is_anomaly", r("ucl").alias("ucl"), r("lcl").alias("lcl"),
                    side.alias("side"), F.when(F.col("is_anomaly"), F.col("_island").cast("long")).alias("zone"))
