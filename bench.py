"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Every query runs to completion through the ``noop``
sink (full execution, nothing collected)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sigwatch.plans import catalog as C  # noqa: E402
from sigwatch.plans import data  # noqa: E402
from sigwatch.plans import pipeline as PL  # noqa: E402
from sigwatch.session import build_session  # noqa: E402

HEADLINE = [
    ("breach_summary", C.breach_summary),
    ("shewhart_flags", C.shewhart_flags),
    ("cusum_scan", C.cusum_scan_q),
    ("micro_batch_index", C.micro_batch_index),
    ("autoencoder_features", C.autoencoder_features_q),
    ("adaptive_control_chart", C.adaptive_control_chart),
    ("fuse_majority_vote", C._fuse_q("majority_vote")),
    ("alert_rows", C.alert_rows_q),
    ("detector_report", C.detector_report),
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.sql.files.maxPartitionBytes": "64m"})
    only = set(sys.argv[1:])
    # session warm-up (JVM, Python workers), not timed
    lev = data.labelled_events(spark, sf_dir)
    stream_rows = data.stream(lev).count()
    C.metric_slice(spark, sf_dir).count()
    # start the Python workers on every core once (steady-state timing)
    spark.range(0, 4096, numPartitions=int(cpus) * 4) \
         .mapInPandas(lambda it: (p for p in it), "id long").write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    if not only or "ensemble" in only:
        t0 = time.time()
        models = PL.fit(data.baseline(lev))
        times["ensemble_fit"] = round(time.time() - t0, 3)
        t0 = time.time()
        PL.score(data.stream(lev), models).write.format("noop").mode("overwrite").save()
        times["ensemble_score"] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    ens = times.get("ensemble_score")
    out = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
           "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "stream_events": stream_rows,
           "ensemble_events_per_sec": round(stream_rows / ens, 1) if ens else None}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
