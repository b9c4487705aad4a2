"""Cooldown by pointer doubling: any key size, few rounds."""

import random

import pytest
from pyspark.sql import functions as F

from sigwatch.operators import alerts as AL
from sigwatch.operators import next_fire as NF


def greedy(rows, gap):
    out, last = set(), {}
    for key, t, event_id in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if key not in last or t - last[key] >= gap:
            out.add(event_id)
            last[key] = t
    return out


def frame(spark, rows):
    return spark.createDataFrame([(k, "m", t, e) for k, t, e in rows], "service string, metric_name string, t double, event_id string") \
        .withColumn("ts", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).drop("t")


@pytest.mark.parametrize("gap", [0.5, 7.0, 100.0, 1e6])
def test_one_key_with_nearly_all_rows(spark, gap):
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 3000)) / 2, f"h{i:05}") for i in range(4000)]
    rows += [(f"k{rnd.randint(0, 9)}", float(rnd.randint(0, 900)), f"c{i}") for i in range(200)]
    rows += [(None, float(10 * i), f"n{i}") for i in range(20)]
    got = [r["event_id"] for r in NF.fired(frame(spark, rows), ["service", "metric_name"], gap, num_partitions=16).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows, gap)


def test_rounds_are_the_logarithm_of_the_alerts(spark):
    rows = [("hot", float(i), f"e{i:05}") for i in range(3000)]
    table = NF.placed(frame(spark, rows), ["service"], num_partitions=8)
    timed = table.select("service", F.unix_micros("ts").alias("_us"), "_place")
    first = timed.groupBy("service").agg(F.min("_place").alias("_place")).select("_place")
    marks, rounds = NF.reached(first, NF.next_at_or_after(timed, ["service"], 3_000_000, 8))
    assert marks.count() == 1000 and rounds <= 10
    assert table.select(F.shiftright("_place", 33)).distinct().count() > 4  # the key lies in many partitions


def test_rows_without_time_empty_tables_and_extra_columns(spark):
    df = frame(spark, [("a", 1.0, "x"), ("a", 2.0, "y"), ("a", 50.0, "z")]).withColumns(
        {"_place_of": F.lit(1), "is_anomaly": F.lit(True)})
    df = df.unionByName(df.withColumn("ts", F.lit(None).cast("timestamp")).withColumn("event_id", F.concat(F.lit("n"), "event_id")))
    got = AL.cooldown(df, 10.0)
    assert got.columns == df.columns
    assert sorted(r["event_id"] for r in got.collect()) == ["nx", "ny", "nz", "x", "z"]
    assert AL.cooldown(df.where("false"), 10.0).count() == 0 and AL.cooldown(df, 0.0).count() == 6


def test_only_key_and_order_are_sorted(spark, monkeypatch):
    """Range-sorted are the columns that the cooldown needs, not whole rows."""
    seen, plain = [], NF.placed
    monkeypatch.setattr(NF, "placed", lambda rows, *a, **k: seen.append(rows.columns) or plain(rows, *a, **k))
    df = frame(spark, [("a", 1.0, "x"), ("a", 1.0, "x"), ("a", 50.0, "z"), ("b", 3.0, None)]).withColumn("message", F.lit("long"))
    got = AL.cooldown(df, 10.0)
    assert len(seen) == 1 and set(seen[0]) == {"service", "metric_name", "ts", "event_id", "_number"}
    assert got.columns == df.columns and got.where("message = 'long'").count() == 3  # a row that comes twice fires once
