"""Cooldown fold, routing, payloads and fusion properties."""

import pandas as pd
from pyspark.sql import functions as F

from sigwatch.operators import alerts as AL
from sigwatch.operators.ensemble import fuse


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, t long, service string, metric_name string, "
                                       "value double, is_anomaly boolean, ensemble_confidence double, "
                                       "severity string").withColumn("ts", F.timestamp_seconds("t")) \
                .withColumn("voted_detectors", F.array(F.lit("IsolationForest"), F.lit("ControlCharts")))


def test_cooldown_second_alert_suppressed(spark):
    df = _events(spark, [("e1", 1_000_000_000, "svc", "m", 99999.0, True, 0.97, "Critical"),
                         ("e2", 1_000_000_010, "svc", "m", 99999.0, True, 0.97, "Critical")])
    fired = AL.cooldown(df, 60).toPandas()
    assert list(fired["event_id"]) == ["e1"]
    assert len(AL.cooldown(df, 0).toPandas()) == 2


def test_cooldown_matches_greedy_loop(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"e{i}", 1_000_000 + rnd.randint(0, 5000), f"s{rnd.randint(0, 2)}", "m", 1.0, True, 0.5, "Medium")
            for i in range(400)]
    df = _events(spark, rows)
    got = set(AL.cooldown(df, 120).toPandas()["event_id"])
    want = set()
    pdf = pd.DataFrame(rows, columns=["event_id", "t", "service", "m", "v", "a", "c", "s"])
    for _, g in pdf.sort_values(["t", "event_id"]).groupby("service"):
        last = None
        for _, r in g.iterrows():
            if last is None or r["t"] - last >= 120:
                want.add(r["event_id"])
                last = r["t"]
    assert got == want


def test_critical_routes_to_pagerduty(spark):
    df = _events(spark, [("abcdef0123456789", 1_000_000_000, "api", "lat", 99999.0, True, 0.97, "Critical")])
    a = AL.alert_rows(df).first()
    assert a["channel"] == "pagerduty" and a["alert_id"] == "ALT-abcdef01"
    assert a["message"] == ("[CRITICAL] Anomaly detected on api | metric=lat | value=99999.0000 | "
                            "confidence=97.00% | detectors=['IsolationForest', 'ControlCharts']")
    assert a["triggered_at"] == "2001-09-09T01:46:40Z"
    p = AL.pagerduty_json(AL.alert_rows(df)).first()
    assert '"dedup_key":"ALT-abcdef01"' in p["payload"] and '"severity":"critical"' in p["payload"]


def test_fusion_set_inclusion(spark):
    import itertools
    rows = []
    for i, (a, b, c) in enumerate(itertools.product([True, False], repeat=3)):
        rows.append((str(i), a, 0.9 if a else 0.1, b, 0.8 if b else 0.2, c, 0.7 if c else 0.3))
    df = spark.createDataFrame(rows, "event_id string, va boolean, ca double, vb boolean, cb double, "
                                     "vc boolean, cc double")
    dets = [("IsolationForest", "va", "ca"), ("Autoencoder", "vb", "cb"), ("ControlCharts", "vc", "cc")]
    flags = {}
    for s in ("any", "majority_vote", "all", "weighted"):
        r = fuse(df, dets, s).toPandas().set_index("event_id")
        assert r["ensemble_confidence"].between(0, 1).all()
        assert set(r["severity"]) <= {"Normal", "Low", "Medium", "High", "Critical"}
        flags[s] = set(r.index[r["is_anomaly"]])
        assert all(len(v) == 3 for v in r["votes"])
    assert flags["all"] <= flags["majority_vote"] <= flags["any"]


def test_alert_summary_grouping_sets(spark):
    df = _events(spark, [("e1", 1, "a", "m", 1.0, True, 0.9, "Critical"),
                         ("e2", 2, "b", "m", 1.0, True, 0.5, "Medium")])
    s = AL.alert_summary(AL.alert_rows(df)).toPandas()
    assert int(s[s.dimension == "total"]["alerts"].iloc[0]) == 2
    assert set(s[s.dimension == "channel"]["key"]) == {"pagerduty", "slack"}


def test_segmented_cooldown_equals_sequential(spark):
    import random
    rnd = random.Random(11)
    rows = [(f"e{i}", 1_000_000 + rnd.randint(0, 20000), f"s{rnd.randint(0, 1)}", "m", 1.0, True, 0.5, "Medium")
            for i in range(600)]
    df = _events(spark, rows)
    seq = set(AL.cooldown(df, 300).toPandas()["event_id"])
    seg = set(AL.segmented_cooldown(df, 300, segment_seconds=1000).toPandas()["event_id"])
    auto = set(AL.cooldown(df, 300, split_rows=50, segment_rows=40).toPandas()["event_id"])
    assert seg == seq and auto == seq
