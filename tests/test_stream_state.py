"""State kept by the engine: charts per series, event-time release, repeats, alerts."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigwatch.operators import charts
from sigwatch.schema import ChartParams
from sigwatch.streaming import series_state as SS
from sigwatch.streaming import stream as ST

COLUMNS = ["event_id", "ts", "service", "metric_name", "value"]


class Run:
    """A chart query over parquet files of raw events; rows and progress of all its starts."""

    def __init__(self, spark, folder, hold, baseline=None, params=ChartParams(), remember=3600.0):
        self.spark, self.folder, self.hold, self.params, self.remember = spark, str(folder), hold, params, remember
        self.rows, self.progress, self.files = [], [], 0
        os.makedirs(f"{folder}/src")
        os.makedirs(f"{folder}/control")
        if baseline is not None:
            st = charts.initial_state(baseline, params)
            st.select(F.lit(None).cast("string").alias("service"), "metric_name", "win", "fit_mean", "fit_std",
                      F.lit(None).cast("timestamp").alias("until")).write.parquet(f"{folder}/control/fitted")

    def put(self, df):
        name = f"{self.folder}/src/{self.files:04}.parquet"
        df.select(*[F.col(f.name).cast(f.dataType) for f in ST.RAW_EVENTS.fields]).toPandas() \
          .astype({"event_id": "Int64"}).to_parquet(name, coerce_timestamps="us")
        os.utime(name, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def go(self):
        ev = ST.event_stream(self.spark, f"{self.folder}/src").withColumnRenamed("is_anomaly", "label") \
               .withColumnRenamed("anomaly_type", "label_type")
        control = self.spark.readStream.schema(SS.CONTROL).option("recursiveFileLookup", "true").parquet(f"{self.folder}/control")
        out = SS.chart_states(ev, control, self.params, self.hold, self.remember)
        q = out.writeStream.foreachBatch(lambda b, i: self.rows.extend((i, r) for r in b.collect())) \
               .option("checkpointLocation", f"{self.folder}/ck").trigger(availableNow=True).start()
        q.awaitTermination(300)
        assert q.exception() is None
        self.progress += [p for p in q.recentProgress]
        return q

    def end(self):
        row = [None] * (len(SS.CONTROL) - 1) + [ST.END_OF_STREAM]
        self.spark.createDataFrame([tuple(row)], SS.CONTROL).coalesce(1).write.parquet(f"{self.folder}/control/ended")
        return self.go()

    def frame(self):
        return pd.DataFrame([r.asDict() for _, r in self.rows])


def raw_events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")


def day(x):
    return F.lit(x).cast("timestamp_ntz")


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    """Files out of event-time order within the hold, with repeats of an earlier
    file, read in two runs of the query: the batch fold's result, row by row."""
    from sigwatch.sources.events import adapt_events
    raw = raw_events(spark)
    base = adapt_events(raw.where(F.col("ts") < day("2024-01-04"))).select(*COLUMNS)
    later = raw.where(F.col("ts") >= day("2024-01-04"))
    run = Run(spark, tmp_path, 2 * 86400.0, base, remember=40 * 86400.0)
    ts = F.col("ts")
    cuts = [(ts < day("2024-01-10")) | (ts >= day("2024-01-11")) & (ts < day("2024-01-11 12:00:00")),
            (ts >= day("2024-01-10")) & (ts < day("2024-01-11")) | (ts >= day("2024-01-11 12:00:00")) & (ts < day("2024-01-18")),
            (ts >= day("2024-01-18")) & (ts < day("2024-01-25")), ts >= day("2024-01-25")]
    for c in cuts[:2]:
        run.put(later.where(c))
    run.go()
    run.put(later.where(cuts[2]).union(later.where(cuts[1]).limit(50)))  # repeats of an earlier file
    run.put(later.where(cuts[3]))
    run.go()
    held = len(run.rows)
    assert 0 < held < later.count()  # the last two days wait
    run.end()
    got = run.frame().set_index("event_id").sort_index()
    assert got.index.is_unique and len(got) == later.count() and not got["late"].any()
    want = charts.adaptive_chart(adapt_events(later).select(*COLUMNS), base, ChartParams()).toPandas() \
        .set_index("event_id").sort_index()
    for c in ("z_score", "cusum_pos", "cusum_neg", "control_mean", "rule_triggered", "cc_confidence"):
        assert (got[c] == want[c]).all(), c
    series = later.select("event_type").distinct().count()
    for p in run.progress:
        for op in p.stateOperators:
            assert op.numRowsTotal <= series and op.numRowsUpdated <= series
    assert sorted(os.listdir(tmp_path)) == ["ck", "control", "src"]


def test_a_batch_touches_its_own_series_only(spark, tmp_path):
    rows = [[(10 * k + i, dt.datetime(2024, 1, 1, k, i), 1, f"m{k}", float(i), None) for i in range(5)] for k in range(6)]
    run = Run(spark, tmp_path, None)
    for part in rows:
        run.put(spark.createDataFrame(part, ST.RAW_EVENTS))
    run.go()
    updated = [op.numRowsUpdated for p in run.progress if p.numInputRows for op in p.stateOperators]
    total = [op.numRowsTotal for p in run.progress if p.numInputRows for op in p.stateOperators]
    assert updated == [1] * 6 and total == [1, 2, 3, 4, 5, 6]
    assert len(run.rows) == 30


def test_late_rows_are_kept_and_marked(spark, tmp_path):
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    run = Run(spark, tmp_path, 3600.0)
    run.put(spark.createDataFrame([(1, at(1), 1, "a", 1.0, None), (2, at(9), 1, "b", 2.0, None)], ST.RAW_EVENTS))
    run.put(spark.createDataFrame([(3, at(10), 1, "a", 3.0, None)], ST.RAW_EVENTS))  # watermark: day 9
    run.put(spark.createDataFrame([(4, at(2), 1, "a", 4.0, None), (5, at(3), 1, "c", 5.0, None)], ST.RAW_EVENTS))
    run.put(spark.createDataFrame([(6, at(1, 5), 1, "a", 6.0, None), (7, None, 1, "a", 7.0, None)], ST.RAW_EVENTS))
    run.go()
    run.end()
    got = {r["event_id"]: r["late"] for _, r in run.rows}
    # 4 and 5 are behind the watermark, but no later row of their series is scored; 6 follows 4
    assert got == {"1": False, "2": False, "3": False, "4": False, "5": False, "6": True, "7": False}
    order = [r["event_id"] for _, r in run.rows if r["metric_name"] == "a"]
    assert order.index("1") < order.index("4") < order.index("6") < order.index("3")


def test_repeats_and_rows_without_an_id(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d)
    run = Run(spark, tmp_path, 3600.0, remember=2 * 86400.0)
    run.put(spark.createDataFrame([(1, at(1), 1, "a", 1.0, None), (1, at(1), 1, "a", 1.0, None),
                                   (None, at(1), 1, "a", 2.0, None), (None, at(1), 1, "a", 2.0, None)], ST.RAW_EVENTS))
    run.put(spark.createDataFrame([(1, at(1), 1, "a", 1.0, None), (2, at(2), 1, "a", 3.0, None),
                                   (None, at(2), 1, "a", 2.0, None)], ST.RAW_EVENTS))
    run.put(spark.createDataFrame([(2, at(2), 1, "a", 3.0, None), (3, at(3), 1, "a", 3.0, None)], ST.RAW_EVENTS))
    run.go()
    run.end()
    ids = [r["event_id"] for _, r in run.rows]
    assert sorted(x for x in ids if x) == ["1", "2", "3"] and ids.count(None) == 3


def test_remembered_ids_expire():
    series = SS._Series(ChartParams(), type("S", (), {"exists": False})())
    us = np.arange(1000) * 1_000_000
    rows = pd.DataFrame({"event_id": [str(i) for i in range(1000)], "value": np.ones(1000)})
    series.score(rows, us)
    stored = series.stored(pd.DataFrame(columns=SS.ROW), 900 * 1_000_000)
    assert len(stored[7]) == 100 and stored[7][0] == "900" and stored[6] is None and len(stored[0]) <= 500


@pytest.mark.parametrize("gap", [0.0, 120.0])
def test_cooldown_of_a_stream_equals_the_greedy_loop(spark, tmp_path, gap):
    import random
    rnd = random.Random(5)
    rows = [(f"e{i}", 1_000_000 + rnd.randint(0, 5000), f"s{rnd.randint(0, 2)}", "m", f"p{i}") for i in range(300)]
    rows.sort(key=lambda r: (r[1], r[0]))
    schema = "event_id string, t long, service string, metric_name string, payload string"
    for k in range(3):
        spark.createDataFrame(rows[100 * k:100 * k + 100], schema).coalesce(1).write.parquet(f"{tmp_path}/src/{k}")
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1) \
        .parquet(f"{tmp_path}/src").withColumn("ts", F.timestamp_seconds("t"))
    got = []
    q = SS.cooldown_states(src, ["service", "metric_name"], gap).writeStream \
          .foreachBatch(lambda b, i: got.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/ck") \
          .trigger(availableNow=True).start()
    q.awaitTermination(300)
    want, last = set(), {}
    for event_id, t, service, _, payload in rows:
        if service not in last or t - last[service] >= gap:
            want.add(payload)
            last[service] = t
    assert {r["payload"] for r in got if r["fired"]} == want and len(got) == 300


def test_counters_equal_a_recount(spark, tmp_path):
    from sigwatch.plans import data, pipeline
    from sigwatch.schema import AlertParams, AutoencoderParams, ForestParams
    raw = raw_events(spark).limit(400)
    src = tmp_path / "src"
    src.mkdir()
    half = raw.withColumn("k", F.crc32(F.col("event_id").cast("string")) % 2)
    for k in range(2):
        half.where(F.col("k") == k).drop("k").toPandas().to_parquet(f"{src}/{k}.parquet", coerce_timestamps="us")
    models = pipeline.fit(data.baseline(data.labelled_events(spark, "/root/testdata/sf0.001")),
                          ForestParams(trees=10), AutoencoderParams(epochs=2, epochs_per_round=2))
    out = str(tmp_path / "out")
    q, scorer = ST.run_stream(spark, str(src), models, out, str(tmp_path / "ck"), alert_p=AlertParams(cooldown_sec=0.0))
    q.awaitTermination(300)
    scorer.flush(spark)
    scored = spark.read.parquet(out + "/scored")
    want = {r["batch_id"]: (r["n"], r["a"], r["l"], r["t"]) for r in scored.groupBy("batch_id").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("is_anomaly"), 1)).alias("a"),
        F.count(F.when(F.col("late"), 1)).alias("l"), F.max("ts").alias("t")).collect()}
    got = {r["batch_id"]: (r["requests"], r["anomalies"], r["late"], r["last_ts"]) for r in ST.counters(spark, out).collect()}
    assert got == want and sum(x[0] for x in got.values()) == 400
    # without a cooldown every anomaly is an alert, once, over any number of replays
    scorer(scored.drop("batch_id").limit(5), 0)
    assert spark.read.json(out + "/alerts").count() == sum(x[1] for x in got.values())
    assert spark.read.parquet(out + "/audit").count() == sum(x[1] for x in got.values())
