"""Sources, sinks, fault data, micro-batch index and stream = batch."""

import json
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import Window

from sigwatch.operators import charts, features as FT
from sigwatch.plans import data
from sigwatch.schema import ChartParams
from sigwatch.sources import events as SE, sinks


def test_api_defaults_and_rejects(spark):
    df = spark.createDataFrame([("a", 1.7e12, "s", "m", 1.0, None, None), (None, 1.7e12, "s", "m", 1.0, "h", "r"),
                                ("c", 1.7e12, "s", "m", None, "h", None)],
                               "event_id string, timestamp double, service string, metric_name string, "
                               "value double, host string, region string")
    ok, bad = SE.split_valid(df)
    o = ok.toPandas()
    assert list(o["host"]) == ["unknown"] and list(o["region"]) == ["us-east-1"]
    assert bad.count() == 2


def test_envelope_bounds(spark):
    env = spark.createDataFrame(
        [("r1", [("a", 1.0, "s", "m", 2.0, None, None)]), ("r2", []), ("r3", None)],
        "request_id string, events array<struct<event_id string, timestamp double, service string, "
        "metric_name string, value double, host string, region string>>")
    rows, rejected = SE.flatten_envelopes(env)
    assert rows.count() == 1 and rejected.count() == 2


def test_jsonl_roundtrip(spark, lev):
    d = tempfile.mkdtemp(prefix="sw-jsonl-")
    SE.write_jsonl(lev, d + "/ds")
    back = SE.read_jsonl(spark, d + "/ds")
    assert back.count() == lev.count()
    assert back.exceptAll(lev).count() == 0


def test_audit_read_repairs_records(spark):
    d = tempfile.mkdtemp(prefix="sw-audit-")
    p = os.path.join(d, "date=2026-06-21", "service=api")
    os.makedirs(p)
    good = {"event_id": "x1", "timestamp": 1.0, "service": "api", "metric_name": "m", "value": 2.0,
            "is_anomaly": "True", "ensemble_confidence": 0.5, "severity": "Medium",
            "votes": {"IsolationForest": "True", "Autoencoder": False, "ControlCharts": "False"},
            "detector_confidences": {"IsolationForest": 0.5}, "fusion_strategy": "majority_vote"}
    good2 = dict(good, event_id="x2", is_anomaly=True)
    with open(os.path.join(p, "a.json"), "w") as f:
        json.dump(good, f, indent=2)
    with open(os.path.join(p, "b.json"), "w") as f:
        json.dump(good2, f, indent=2)
    with open(os.path.join(p, "c.json"), "w") as f:
        f.write(json.dumps(good, indent=2)[:60])
    ok, bad = sinks.read_audit_json(spark, d)
    o = ok.toPandas().sort_values("event_id")
    assert list(o["is_anomaly"]) == [True, True]
    assert o.iloc[0]["votes"]["IsolationForest"] is True and o.iloc[0]["votes"]["Autoencoder"] is False
    assert bad.count() == 1 and set(o["date"].astype(str)) == {"2026-06-21"}


def test_row_index_matches_row_number(lev):
    s = data.stream(lev)
    a = FT.add_row_index(s, batch_rows=500, num_partitions=7).select("event_id", "row_idx")
    b = s.select("event_id", (F.row_number().over(Window.orderBy("ts", "event_id")) - 1).alias("rn"))
    j = a.join(b, "event_id")
    assert j.where(F.col("row_idx") != F.col("rn")).count() == 0 and j.count() == s.count()


def test_chart_state_batches_equal_batch_run(spark, lev):
    cols = ["event_id", "ts", "service", "metric_name", "value"]
    b = data.baseline(lev).select(*cols)
    s = data.stream(lev).select(*cols)
    p = ChartParams()
    whole = charts.adaptive_chart(s, b, p).toPandas().set_index("event_id").sort_index()
    cuts = ["2024-01-10", "2024-01-20"]
    state = charts.initial_state(b, p)
    parts = []
    bounds = [None] + cuts + [None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = s
        if lo:
            part = part.where(F.col("ts") >= F.lit(lo).cast("timestamp"))
        if hi:
            part = part.where(F.col("ts") < F.lit(hi).cast("timestamp"))
        out = charts.chart_with_state(part, state, p).checkpoint(eager=True)
        state = out.where("_kind = 's'").select("metric_name", *[n for n, _ in charts.STATE_FIELDS])
        parts.append(out.where("_kind = 'r'").toPandas())
    inc = pd.concat(parts).set_index("event_id").sort_index()
    assert len(inc) == len(whole)
    for c in ("z_score", "cusum_pos", "rule_triggered", "cc_confidence"):
        assert (inc[c] == whole[c]).all(), c


def test_stream_end_to_end(spark, lev, tmp_path):
    """Files arrive slightly out of event-time order; with a 2-day hold
    the streamed chart results equal the batch fold over the same rows, and
    every row is scored exactly once after the final flush."""
    from sigwatch.plans import pipeline
    from sigwatch.schema import AutoencoderParams, ForestParams, AlertParams, ChartParams
    from sigwatch.streaming import stream as ST
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = str(tmp_path / "src")
    ts = F.col("ts")
    d = lambda x: F.lit(x).cast("timestamp_ntz")
    slices = [(ts < d("2024-01-12")) | ((ts >= d("2024-01-13")) & (ts < d("2024-01-13 12:00:00"))),
              ((ts >= d("2024-01-12")) & (ts < d("2024-01-13"))) | ((ts >= d("2024-01-13 12:00:00")) & (ts < d("2024-01-22"))),
              ts >= d("2024-01-22")]
    for i, cond in enumerate(slices):
        raw.where(cond).coalesce(1).write.parquet(f"{src}/part{i}")
        os.system(f"mv {src}/part{i}/*.parquet {src}/f{i}.parquet 2>/dev/null")
    models = pipeline.fit(data.baseline(data.labelled_events(spark, "/root/testdata/sf0.001")),
                          ForestParams(trees=20), AutoencoderParams(epochs=5, epochs_per_round=5))
    out = str(tmp_path / "out")
    q, scorer = ST.run_stream(spark, src, models, out, str(tmp_path / "ckpt"),
                              alert_p=AlertParams(cooldown_sec=86400.0), hold_seconds=2 * 86400.0)
    q.awaitTermination(600)
    assert len(ST.progress_rows(q)) >= 1
    scorer.flush(spark)
    scored = spark.read.parquet(out + "/scored").toPandas().set_index("event_id").sort_index()
    assert len(scored) == raw.count() and scored.index.is_unique
    from sigwatch.sources.events import adapt_events
    cols = ["event_id", "ts", "service", "metric_name", "value"]
    batch = charts.adaptive_chart(adapt_events(raw).select(*cols), models.baseline.select(*cols), ChartParams())
    b = batch.toPandas().set_index("event_id").sort_index()
    for c in ("z_score", "cusum_pos", "rule_triggered", "cc_confidence"):
        assert (scored[c] == b[c]).all(), c
    assert spark.read.json(out + "/alerts").count() >= 1


def test_envelope_answers(spark, lev):
    """S4 end to end: stream rows packed into envelopes, flattened, scored by the
    SQL trio fusion and answered per request."""
    from sigwatch.operators.ensemble import fuse
    env_rows = [("req1", [(f"e{i}", 1.7e12 + i, "s", "m", float(i), None, None) for i in range(5)]),
                ("req2", [("x", 1.7e12, "s", "m", 9999.0, "h", "r")])]
    env = spark.createDataFrame(env_rows, "request_id string, events array<struct<event_id string, "
                                "timestamp double, service string, metric_name string, value double, "
                                "host string, region string>>")
    rows, bad = SE.flatten_envelopes(env)
    rows = rows.withColumn("va", F.col("value") > 100).withColumn("ca", F.lit(0.9)) \
               .withColumn("vb", F.col("value") > 100).withColumn("cb", F.lit(0.8)) \
               .withColumn("vc", F.lit(False)).withColumn("cc", F.lit(0.1))
    scored = fuse(rows, [("IsolationForest", "va", "ca"), ("Autoencoder", "vb", "cb"), ("ControlCharts", "vc", "cc")])
    ans = {r["request_id"]: r for r in SE.envelope_answers(scored).collect()}
    assert ans["req1"]["total"] == 5 and ans["req1"]["anomalies"] == 0
    assert [x["event_id"] for x in ans["req1"]["results"]] == [f"e{i}" for i in range(5)]
    assert ans["req2"]["anomalies"] == 1 and bad.count() == 0


def test_writers_roundtrip(spark, tmp_path):
    from sigwatch.operators import alerts as AL, evaluate as EV
    df = spark.createDataFrame([("abcdef0123", 1_000_000_000, "api", "lat", 5.0, True, 0.9, "Critical"),
                                ("bcdef01234", 1_000_000_100, "api", "lat", 5.0, True, 0.5, "Medium")],
                               "event_id string, t long, service string, metric_name string, value double, "
                               "is_anomaly boolean, ensemble_confidence double, severity string") \
        .withColumn("ts", F.timestamp_seconds("t")).withColumn("voted_detectors", F.array(F.lit("ControlCharts")))
    alerts = AL.alert_rows(df)
    sinks.write_payloads(alerts, str(tmp_path / "payloads"))
    sinks.write_alert_log(alerts, str(tmp_path / "log"))
    got = spark.read.json(str(tmp_path / "payloads"))
    assert {r["channel"] for r in got.collect()} == {"pagerduty", "slack"}
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    long = df.withColumn("label", F.lit(True)).withColumn("label_type", F.lit("spike"))
    m = EV.per_type_map(EV.unpivot_methods(long, [("Ensemble", "is_anomaly", "ensemble_confidence")]))
    sinks.write_report(m, str(tmp_path / "report"))
    r = spark.read.json(str(tmp_path / "report")).first()
    assert r["method"] == "Ensemble" and r["per_type"]["spike"]["detected"] == 2


def test_bucket_kpi_stream_matches_batch(spark, tmp_path):
    """Tumbling per-day, per-service counts from a stream equal the batch
    aggregation for every window, the last ones too."""
    import shutil
    from sigwatch.streaming import stream as ST
    from sigwatch.sources.events import adapt_events
    src = tmp_path / "src"
    src.mkdir()
    shutil.copy("/root/testdata/sf0.001/events.parquet", src / "events.parquet")
    q = ST.bucket_kpi_stream(spark, str(src), str(tmp_path / "ck"), str(tmp_path / "out"))
    q.awaitTermination(300)
    got = ST.bucket_kpi_table(spark, str(tmp_path / "out")).toPandas()
    ev = adapt_events(spark.read.parquet(str(src)))
    want = ev.groupBy(F.window("ts", "1 day").alias("w"), "service").agg(F.count("*").alias("events")) \
             .select(F.col("w.start").alias("bucket_start"), "service", "events").toPandas()
    merged = got.merge(want, on=["bucket_start", "service"], suffixes=("", "_b"))
    assert len(got) == len(want) == len(merged)
    assert (merged["events"] == merged["events_b"]).all()


def test_overlapping_scenarios_first_priority_wins(spark, lev):
    """J4 with overlapping scenarios: the array path picks the first by priority."""
    from sigwatch.operators import inject as I
    from sigwatch.sources.events import load_events
    plan = (("error_storm", 4 * 86400.0, 10 * 86400.0, "view", None, 50.0),
            ("traffic_spike", 5 * 86400.0, 3 * 86400.0, "view", "svc-0", 50.0))
    sc = I.scenario_table(spark, I.scenario_plan(plan=plan))
    assert I._overlapping(sc)
    m = I.scenario_matches(load_events(spark, "/root/testdata/sf0.01"), sc).toPandas()
    assert set(m["scenario"]) == {"error_storm"}
    assert not I._overlapping(data.scenarios(spark))
