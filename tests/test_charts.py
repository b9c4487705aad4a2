"""Adaptive chart, cusum scan and Shewhart: recursive queries and properties."""

import numpy as np
import pytest

from sigwatch.operators import charts
from sigwatch.operators.chart_fold import SeriesFold
from sigwatch.plans import data
from sigwatch.schema import ChartParams


def _frames(lev):
    cols = ["event_id", "ts", "service", "metric_name", "value"]
    return data.baseline(lev).select(*cols), data.stream(lev).select(*cols)


SF01 = "/root/testdata/sf0.01"


def _oracle(name):
    import duckdb
    from sigwatch.plans.sql import SQL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF01}/events.parquet')")
    return con.execute(SQL[name]).df()


@pytest.mark.parametrize("name", ["adaptive_control_chart", "fixed_control_chart"])
def test_chart_equals_recursive_query(spark, name):
    from sigwatch.plans.registry import QUERIES
    got = QUERIES[name](spark, SF01).toPandas()
    want = _oracle(name)
    for df in (got, want):
        df["event_id"] = df["event_id"].astype(str)
    got, want = (df.sort_values("event_id").reset_index(drop=True) for df in (got, want))
    assert len(got) == len(want)
    assert (got["rule_triggered"].fillna("") == want["rule_triggered"].fillna("")).all()


def test_large_offset_keeps_the_deviation():
    rng = np.random.default_rng(5)
    for offset in (0.0, 1e7, 1e9):
        v = rng.normal(0, 1, 3000) + offset
        fold = SeriesFold(ChartParams(), window=v[:500])
        got = fold.fold(v[500:])
        clean = [x for x, flag in zip(v[500:], got["cc_is_anomaly"]) if not flag]
        last = np.array(list(v[:500]) + clean)[-500:]
        assert abs(got["control_std"][-1] - last.std()) < 0.05
        assert sum(got["cc_is_anomaly"]) < 0.2 * 2500


def test_values_that_are_no_numbers_leave_the_series_alone():
    rng = np.random.default_rng(6)
    v = rng.normal(50, 1, 2000)
    holes = v.copy()
    holes[::97] = np.nan
    holes[::101] = np.inf
    ok = np.isfinite(holes)
    with_holes = SeriesFold(ChartParams(), window=v[:100]).fold(np.append(holes, 9999.0))
    without = SeriesFold(ChartParams(), window=v[:100]).fold(np.append(v[ok], 9999.0))
    kept = [z for z, good in zip(with_holes["z_score"], np.append(ok, True)) if good]
    assert kept == without["z_score"]
    assert with_holes["rule_triggered"][-1] == "3sigma"
    assert all(z is None for z, good in zip(with_holes["z_score"], ok) if not good)


def test_batches_do_not_matter_and_a_level_shift_is_frozen():
    v = np.concatenate([np.full(200, 50.0) + np.tile([0.0, 1.0], 100), np.full(3000, 200.0)])
    whole = SeriesFold(ChartParams()).fold(v)
    parts = SeriesFold(ChartParams())
    cut = [parts.fold(p) for p in np.array_split(v, 37)]
    assert whole["rule_triggered"] == [r for p in cut for r in p["rule_triggered"]]
    assert set(whole["rule_triggered"][200:]) == {"3sigma"}
    assert len(set(whole["control_mean"][200:])) == 1


def test_chart_properties(lev):
    b, s = _frames(lev)
    res = charts.adaptive_chart(s, b, ChartParams(series_key=("service", "metric_name"))).toPandas()
    assert res["cc_confidence"].between(0, 1).all()
    assert (res["upper_limit"] > res["lower_limit"]).all()
    assert set(res["rule_triggered"]) <= {"", "3sigma", "cusum_up", "cusum_down"}


def test_chart_independent_of_partitions(lev):
    b, s = _frames(lev)
    a = charts.adaptive_chart(s, b, ChartParams(), num_partitions=1).toPandas().sort_values("event_id")
    c = charts.adaptive_chart(s.repartition(7), b, ChartParams(), num_partitions=13).toPandas().sort_values("event_id")
    assert a.reset_index(drop=True).equals(c.reset_index(drop=True))


def test_spike_triggers_3sigma(spark, lev):
    b, s = _frames(lev)
    one = s.limit(1).withColumn("value", s["value"] * 0 + 9999.0)
    r = charts.adaptive_chart(one, b, ChartParams()).first()
    assert r["rule_triggered"] == "3sigma" and r["cc_is_anomaly"]


def test_unseen_series_starts_at_unit_scale(spark):
    from pyspark.sql import functions as F
    s = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 5.0), ("c", 3, 0.5)], "event_id string, t int, value double") \
        .select("event_id", F.timestamp_seconds("t").alias("ts"), F.lit("svc").alias("service"),
                F.lit("new_metric").alias("metric_name"), "value")
    r = charts.adaptive_chart(s, None, ChartParams()).orderBy("ts").toPandas()
    # first value 2.0 against mean 0 / std 1 -> z 2, not flagged; then window stats
    assert r.loc[0, "z_score"] == 2.0 and r.loc[0, "rule_triggered"] == ""


def test_cusum_scan_equals_loop(lev):
    s = data.stream(lev)
    lim = charts.reference_limits(s, ("metric_name",), eps=1e-8)
    c = charts.cusum_scan(s, lim, ("metric_name",)).toPandas()
    for m, g in c.groupby("metric_name"):
        g = g.sort_values("_rn")
        cp = 0.0
        for i, (_, r) in enumerate(g.iterrows()):
            if i > 0:
                cp = max(0.0, cp + r["z"] - 0.5)
            assert abs(cp - r["cusum_pos"]) < 1e-6


def test_prefix_scan_single_hot_key_matches_window(spark, lev):
    """One key holding every row still splits into many segments and gives
    the same running sum / running minimum as a per-key window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from sigwatch.operators.scan import prefix_scan
    s = data.stream(lev).withColumn("k", F.lit("hot")).withColumn("d", F.col("value") - 50.0)
    out = prefix_scan(s, ["k"], ["ts", "event_id"], sums={"S": "d"}, mins={"M": "S"}, segment_seconds=3600)
    w = Window.partitionBy("k").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    ref = s.withColumn("S0", F.sum("d").over(w)).withColumn("M0", F.min("S0").over(w))
    j = out.join(ref.select("event_id", "S0", "M0"), "event_id").toPandas()
    assert len(j) == s.count()
    assert (abs(j["S"] - j["S0"]) < 1e-6).all() and (abs(j["M"] - j["M0"]) < 1e-6).all()
    assert out.select(F.floor(F.unix_micros("ts") / 3.6e9)).distinct().count() > 100


def test_segmented_chart_equals_sequential(lev):
    """A series split into time segments folded in parallel (fixed-point start
    states) gives exactly the sequential fold."""
    b, s = _frames(lev)
    p = ChartParams()
    seq = charts.sequential_chart(s, b, p).toPandas().set_index("event_id").sort_index()
    seg = charts.segmented_chart(s, b, p, segment_seconds=10 * 86400).toPandas().set_index("event_id").sort_index()
    assert len(seg) == len(seq)
    for c in ("z_score", "cusum_pos", "cusum_neg", "control_mean", "rule_triggered", "cc_confidence"):
        assert (seg[c] == seq[c]).all(), c
    # a series above split_rows is cut into many segments
    auto = charts.adaptive_chart(s, b, ChartParams(split_rows=100, segment_rows=700)).toPandas()
    auto = auto.set_index("event_id").sort_index()
    assert (auto["rule_triggered"] == seq["rule_triggered"]).all()


def _shifted(spark, days=24, per_hour=60):
    """Series that leave their level after two days (one comes back on the last
    day, one swings between two levels) and one that keeps it; a day has more rows than the window."""
    import pandas as pd
    from pyspark.sql import functions as F
    rng = np.random.default_rng(8)
    n, parts = 24 * days * per_hour, []
    for name, base, up in (("up", 0.0, 80.0), ("down", 0.5, -90.0), ("plain", 0.0, 0.0), ("both", 0.0, 40.0)):
        v = base + rng.normal(0, 1, n)
        v[2 * 24 * per_hour:] += up
        if name == "down":
            v[-10:] -= up
        if name == "both":  # far off, now on one side and now on the other
            v[2 * 24 * per_hour + 1::2] -= 2 * up
        v[::97] = np.nan
        parts.append(pd.DataFrame({"event_id": [f"{name}{i:06}" for i in range(n)], "t": np.arange(n) * (3600 // per_hour),
                                   "metric_name": name, "value": v}))
    return spark.createDataFrame(pd.concat(parts)).select(
        "event_id", F.timestamp_seconds("t").alias("ts"), F.lit("svc").alias("service"), "metric_name", "value")


@pytest.mark.parametrize("with_baseline", [True, False])
def test_a_level_shift_over_all_segments_settles_in_few_passes(spark, with_baseline):
    from pyspark.sql import functions as F
    df = _shifted(spark)
    base = df.where(F.col("ts") < F.timestamp_seconds(F.lit(86400))) if with_baseline else None
    s = df.where(F.col("ts") >= F.timestamp_seconds(F.lit(86400))) if with_baseline else df
    cut = s.withColumn("_seg", F.floor(F.unix_micros("ts") / F.lit(24 * 3_600_000_000)).cast("long"))
    n = cut.select("metric_name", "_seg").distinct().count()
    out, passes = charts.chained_chart(cut, base, ChartParams())
    got = out.toPandas().set_index("event_id").sort_index()
    want = charts.sequential_chart(s, base, ChartParams()).toPandas().set_index("event_id").sort_index()
    assert n >= 92 and passes <= 5, (n, passes)
    assert (got["rule_triggered"] == want["rule_triggered"]).all() and len(got) == len(want)
    for c in ("z_score", "cusum_pos", "cusum_neg", "control_mean", "control_std", "cc_confidence"):
        assert np.allclose(got[c], want[c], atol=2e-4, equal_nan=True), c


def test_segments_follow_the_rows(spark):
    from pyspark.sql import functions as F
    rows = [("hot", 10 * i) for i in range(2000)] + [("hot", 10 ** 7 + 86400 * i) for i in range(50)] + [("thin", 5)]
    df = spark.createDataFrame(rows, "metric_name string, t long").withColumn("ts", F.timestamp_seconds("t"))
    cells = charts.segments_by_rows(df, ["metric_name"], 100)
    sizes = cells.join(df.withColumn("_cell", charts._cell()), ["metric_name", "_cell"]).groupBy("metric_name", "_seg").count()
    assert sizes.agg(F.max("count")).first()[0] <= 106 and sizes.count() >= 20
    assert charts.segments_by_rows(df, ["metric_name"], 5000) is None


def test_cut_series_equal_the_whole_fold(lev):
    b, s = _frames(lev)
    want = charts.sequential_chart(s, b, ChartParams()).toPandas().set_index("event_id").sort_index()
    got = charts.adaptive_chart(s, b, ChartParams(segment_rows=300)).toPandas().set_index("event_id").sort_index()
    assert got.columns.tolist() == want.columns.tolist()
    for c in ("z_score", "cusum_pos", "cusum_neg", "control_mean", "rule_triggered", "cc_confidence"):
        assert (got[c] == want[c]).all(), c


def test_the_stream_is_read_once_where_its_rows_are_given(spark, lev):
    """Detectors in front of the chart run once, also where series are cut."""
    b, s = _frames(lev)
    s = s.localCheckpoint()
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    out = charts.adaptive_chart(s.mapInArrow(counted, s.schema), b, ChartParams(segment_rows=300), rows=s)
    out.write.format("noop").mode("overwrite").save()
    assert read.value == s.count()


def test_start_states_reach_the_folds_as_they_are(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("metric_name", T.StringType()), T.StructField("_seg", T.LongType()),
                           *[T.StructField(n, t) for n, t in charts.STATE_FIELDS]])
    win = [0.1, 1e-300, -2.5e17, 1 / 3]
    starts = spark.createDataFrame([("m", 1, win, 0.1 + 0.2, 4.0, None, None), (None, 2, [], 0.0, 0.0, 1 / 7, 2.0)], schema)
    rows = spark.createDataFrame([("m", 1, "a", 1.0)], "metric_name string, _seg long, event_id string, value double")
    both = charts._with_starts(rows, starts, ["metric_name", "_seg"])
    assert not any(isinstance(f.dataType, T.ArrayType) for f in both.schema.fields)
    first, second = [charts._started(x, ChartParams()) for x in
                     both.where("_phase = 0").orderBy("_seg").toArrow().to_batches(max_chunksize=1)]
    assert first.window.tolist() == win and first.cusum == (0.1 + 0.2, 4.0) and first.fit is None
    assert second.window.tolist() == [] and second.cusum == (0.0, 0.0) and second.fit == (1 / 7, 2.0)


def test_rounding_of_blocks_is_python_rounding():
    from sigwatch.operators.chart_fold import rounded
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(0, 100, 5000), np.round(rng.normal(0, 10, 5000), 5), rng.normal(0, 1e13, 100),
                        [np.nan, np.inf, -np.inf, 0.0, -0.0, 0.00005, 0.00015, 1e308]])
    for places in (4, 8):
        assert np.array_equal(rounded(v, places), [round(x, places) for x in v.tolist()], equal_nan=True)


def test_a_window_that_turns_constant_has_no_deviation_left():
    rng = np.random.default_rng(6)
    v = np.concatenate([np.round(rng.normal(5000, 2000, 900), 2), np.full(1200, 5000.1)])
    got = SeriesFold(ChartParams(adaptive=False)).judge(v)
    for i in (1399, 1400, 1500, 2099):
        window, std = v[i - 500:i], 1e-8 if i >= 1400 else v[i - 500:i].std() + 1e-8
        assert abs(got[3][i] - window.mean()) < 1e-9 and abs(got[4][i] - std) < max(1e-12, 1e-6 * std), i


def test_a_cut_series_without_a_name_equals_its_whole_fold(lev):
    from pyspark.sql import functions as F
    b, s = [x.withColumn("metric_name", F.when(F.col("metric_name") != "view", F.col("metric_name"))) for x in _frames(lev)]
    want = charts.sequential_chart(s, b, ChartParams()).toPandas().set_index("event_id").sort_index()
    got = charts.adaptive_chart(s, b, ChartParams(segment_rows=300), rows=s).toPandas().set_index("event_id").sort_index()
    assert want["metric_name"].isna().any() and len(got) == len(want)
    for c in ("z_score", "cusum_pos", "control_mean", "rule_triggered"):
        assert (got[c] == want[c]).all(), c
