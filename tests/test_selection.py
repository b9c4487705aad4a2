"""Whole-sequence features over blocks, exact percentiles, restarted streams."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigwatch.operators import features as FT
from sigwatch.operators.quantiles import percentiles
from sigwatch.plans import data


def test_blocks_join_without_a_seam(lev, monkeypatch):
    monkeypatch.setattr(FT, "SEQUENCE_BLOCK", 60)
    rows = data.stream(lev)
    got = FT.whole_sequence(rows, lambda x: FT.with_rolling_ratio(FT.with_diff(x))).toPandas().sort_values("row_idx")
    want = rows.toPandas().sort_values(["ts", "event_id"])
    assert got["event_id"].tolist() == want["event_id"].tolist()
    v = want["value"].reset_index(drop=True)
    assert np.allclose(got["f_diff"], v.diff().fillna(0.0))
    assert np.allclose(got["f_roll_ratio"], v / (v.rolling(50, min_periods=1).mean() + 1e-8))


def test_percentiles_with_ties_nulls_and_small_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(f"e{i}", "many", float(v)) for i, v in enumerate(rng.integers(0, 4, 301))]
    rows += [("x", "one", 7.5), ("y", "none", None)]
    df = spark.createDataFrame(rows, "event_id string, k string, v double")
    shares = {"a": 0.02, "b": 0.5, "c": 0.975}
    got = {r["k"]: r for r in percentiles(df, "v", shares, ("k",)).collect()}
    many = [v for _, k, v in rows if k == "many"]
    assert set(got) == {"many", "one"}
    for name, share in shares.items():
        assert got["many"][name] == pytest.approx(np.quantile(many, share))
        assert got["one"][name] == 7.5
    every = percentiles(df, "v", shares).first()
    assert every["c"] == pytest.approx(pd.Series([v for *_, v in rows]).quantile(0.975))


def test_a_restarted_query_knows_earlier_ids(spark, tmp_path):
    from sigwatch.streaming import series_state, stream
    got = []

    def start(ids):
        name = f"{tmp_path}/src/{len(ids)}.parquet"
        spark.createDataFrame([(i, dt.datetime(2024, 1, 4 + i), 1, "view", 1.0, None) for i in ids], stream.RAW_EVENTS) \
             .toPandas().to_parquet(name, coerce_timestamps="us")
        rows = stream.event_stream(spark, f"{tmp_path}/src").withColumnRenamed("is_anomaly", "label") \
                     .withColumnRenamed("anomaly_type", "label_type")
        control = spark.readStream.schema(series_state.CONTROL).parquet(f"{tmp_path}/control")
        out = series_state.chart_states(rows, control, remember_seconds=30 * 86400.0)
        q = out.writeStream.foreachBatch(lambda b, i: got.extend(r["event_id"] for r in b.collect())) \
               .option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination(200)

    for folder in ("src", "control"):
        (tmp_path / folder).mkdir()
    start([1, 2])
    assert sorted(got) == ["1", "2"]
    start([1, 2, 3])
    assert sorted(got) == ["1", "2", "3"]
