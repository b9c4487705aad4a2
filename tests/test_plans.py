"""Plan checks: no single-partition exchange under the big windows, no row-at-a-time Python."""

from sigwatch.operators import charts, features as FT
from sigwatch.plans import data
from sigwatch.schema import ChartParams


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_index_has_no_single_partition(lev):
    p = _plan(FT.add_row_index(data.stream(lev), batch_rows=500))
    assert "SinglePartition" not in p.split("BroadcastExchange")[0] or "RangePartitioning" in p


def test_chart_uses_arrow_not_rowwise_python(lev):
    cols = ["event_id", "ts", "service", "metric_name", "value"]
    df = charts.adaptive_chart(data.stream(lev).select(*cols), data.baseline(lev).select(*cols), ChartParams())
    p = _plan(df)
    assert "BatchEvalPython" not in p and "MapInPandas" in p
    assert "hashpartitioning(metric_name" in p


def test_scan_prunes_columns(spark):
    from sigwatch.sources.events import load_events
    p = _plan(load_events(spark, "/root/testdata/sf0.001").select("event_id", "value"))
    assert "props" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "worst_severity" in df.columns


def _tiny(spark, at):
    from pyspark.sql import functions as F
    rows = spark.range(600).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 4000).alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 11 + F.when(F.col("id") % 50 == 0, 500.0).otherwise(0.0)).alias("value"))
    rows.write.parquet(f"{at}/events.parquet")
    return str(at)


def test_fits_are_tables_before_the_stream_meets_them(spark, tmp_path, monkeypatch):
    """Their sizes are known to the planner: a join with a few rows gathers no metric's rows in one task."""
    from sigwatch.plans import catalog as C
    met = {}
    for name in ("shewhart", "cusum_scan"):
        plain = getattr(charts, name)
        monkeypatch.setattr(charts, name, lambda s, fit, *a, _n=name, _f=plain, **k: met.setdefault(_n, []).append(fit) or _f(s, fit, *a, **k))
    d = _tiny(spark, tmp_path)
    for q in (C.trio_scored, C.fuse_joined):
        q(spark, d)
    assert [len(x) for x in met.values()] == [2, 2]
    for fit in (f for x in met.values() for f in x):
        assert "Aggregate" not in _plan(fit) and fit.count() > 0


def test_the_trio_reads_its_source_once(spark, tmp_path):
    """The overlay runs once, whatever the number of detectors, fits and cuts on it."""
    from sigwatch.plans import catalog as C
    d = _tiny(spark, tmp_path)
    for q in (C.trio_scored, C.fuse_joined):
        out = q(spark, d)
        assert out.count() == 600 - 65  # three days of rows before the cut
        assert out.inputFiles() and not [f for f in out.inputFiles() if "events.parquet" in f]


def test_alert_queries_hand_the_cooldown_only_what_they_show(spark, tmp_path, monkeypatch):
    from sigwatch.operators import alerts as AL
    from sigwatch.plans import catalog as C
    seen, plain = [], AL.cooldown
    monkeypatch.setattr(AL, "cooldown", lambda rows, *a, **k: seen.append(set(rows.columns)) or plain(rows, *a, **k))
    d = _tiny(spark, tmp_path)
    found = [q(spark, d).count() for q in (C.alert_cooldown, C.alert_pipeline, C.alert_rows_q)]
    assert found[0] > 0 and len(set(found)) == 1
    assert len(seen) == 3 and not any(s & {"votes", "detector_confidences", "label", "sh_conf"} for s in seen)
