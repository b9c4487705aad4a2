"""Structured Streaming: scoring with state that the engine keeps.

Two queries:

* ``run_stream`` (T1): ``readStream`` -> chart state per series (T2), event-time
  release (T3) and de-duplication (T5) in one stateful operator
  (``series_state.chart_states``) -> ``foreachBatch``: forest and autoencoder
  scores of the released rows, fusion, one folder of scored rows per batch (U2).
* ``StreamScorer.alerts`` (T4): reads the scored folders as a stream, keeps the
  last alert per key (``series_state.cooldown_states``), writes alerts and audit
  rows.

A batch's folder is written once: a replayed batch whose folder is complete is
left alone, so the second query sees each row once.

* T3: ``flush`` ends the stream: a row in the control folder moves the watermark
  past everything, and all waiting rows are released.
* T6: tumbling per-day KPI as partial counts per micro-batch, summed on read.
* T7: rates and latencies come from ``StreamingQueryProgress``; ``counters`` are
  taken while a batch is written (``Observation``), nothing is scanned twice.

On a cluster set ``spark.sql.streaming.stateStore.providerClass`` to Spark's
RocksDB provider, so that state need not fit in memory.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import alerts as AL
from ..operators import autoencoder as AE
from ..operators import charts
from ..operators import features as FT
from ..operators import forest as IF
from ..operators.ensemble import fuse_reference
from ..operators.small import materialize
from ..plans.pipeline import EVENT_OUT, Models
from ..schema import AlertParams, ChartParams
from ..sources import sinks
from ..sources.events import adapt_events
from .series_state import CONTROL, chart_states, cooldown_states

RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

#: Later than any event.
END_OF_STREAM = datetime(9000, 1, 1)
#: Times in payloads keep their microseconds.
PAYLOAD_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """S3: a stream of metric events from parquet files of the raw table."""
    raw = spark.readStream.schema(RAW_EVENTS).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    return adapt_events(raw)


def _is_written(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to its end. Looks through the Hadoop file
    system, so any shared store works."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


class StreamScorer:
    """``foreachBatch`` function: forest, autoencoder, fusion, scored rows."""

    def __init__(self, models: Models, out_dir: str, control_dir: str, chart_p: ChartParams = ChartParams(),
                 alert_p: AlertParams = AlertParams(), batch_rows: int = 500):
        self.models, self.out_dir, self.control_dir = models, out_dir, control_dir
        self.chart_p, self.alert_p, self.batch_rows = chart_p, alert_p, batch_rows
        self.begin = None  # starts the scoring query again (set by run_stream)

    # -- the control folder --------------------------------------------------
    def fit_states(self, spark: SparkSession) -> None:
        """Fitted state of every series, written before the first start."""
        path = os.path.join(self.control_dir, "fitted")
        if not _is_written(spark, path):
            st = charts.initial_state(self.models.baseline, self.chart_p)
            have = set(st.columns)
            st.select(*[F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in CONTROL.fields]).write.mode("overwrite").parquet(path)

    def flush(self, spark: SparkSession) -> None:
        """End the stream: score everything still held, then fire the alerts.
        Rows that arrive later are scored as they come."""
        path = os.path.join(self.control_dir, "ended")
        if not _is_written(spark, path):
            row = [None] * (len(CONTROL) - 1) + [END_OF_STREAM]
            spark.createDataFrame([tuple(row)], CONTROL).coalesce(1).write.mode("overwrite").parquet(path)
        self.begin().awaitTermination()
        self.alerts(spark).awaitTermination()

    # -- scoring ---------------------------------------------------------------
    def score(self, rows: DataFrame) -> DataFrame:
        """Ensemble result of rows that carry their chart columns."""
        m = self.models
        s = FT.add_row_index(rows, batch_rows=self.batch_rows)
        f = FT.autoencoder_features(s, m.metric_index)
        f = IF.decision(f, FT.FOREST_FEATURES, m.forest)
        f = FT.batch_minmax_confidence(f, "if_decision", "_ifc").withColumn("if_confidence", F.round("_ifc", 4))
        f = AE.score(f, FT.AE_FEATURES, m.autoencoder)
        chart = [n for n, _ in charts.CHART_FIELDS]
        return fuse_reference(f.select(*EVENT_OUT, "if_score", "if_is_anomaly", "if_confidence", "reconstruction_error",
                                       "ae_is_anomaly", "ae_confidence", *chart, "late"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the stateful plan runs once a batch; a complete folder is a replay
        rows = materialize(batch)
        path = os.path.join(self.out_dir, "scored", f"batch_id={int(batch_id)}")
        if _is_written(spark, path) or rows.isEmpty():
            return
        seen = Observation(f"batch {batch_id}")
        result = self.score(rows).observe(
            seen, F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("is_anomaly"), 1)).alias("anomalies"),
            F.count(F.when(F.col("late"), 1)).alias("late"), F.max("ts").alias("last_ts"))
        result.write.mode("overwrite").parquet(path)
        row = {"batch_id": int(batch_id), **seen.get}
        spark.createDataFrame([row], "batch_id long, requests long, anomalies long, late long, last_ts timestamp") \
             .coalesce(1).write.mode("overwrite").parquet(os.path.join(self.out_dir, "counters", f"part={int(batch_id)}"))

    # -- alerts ----------------------------------------------------------------
    def alerts(self, spark: SparkSession, available_now: bool = True):
        """T4: the alert query over the scored rows; returns the StreamingQuery.
        The first scored batch must have been written."""
        path = os.path.join(self.out_dir, "scored")
        scored = spark.read.parquet(path).schema
        payload = F.to_json(F.struct(*[F.col(c) for c in scored.names]), PAYLOAD_OPTIONS)
        anomalies = (spark.readStream.schema(scored).parquet(path).where("is_anomaly")
                     .select(*AL.KEY, "ts", "event_id", payload.alias("payload")))
        out = cooldown_states(anomalies, AL.KEY, float(self.alert_p.cooldown_sec))

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = materialize(batch.select(F.from_json("payload", scored, PAYLOAD_OPTIONS).alias("r"), "fired"))
            if rows.isEmpty():
                return
            fired = rows.where("fired").select("r.*").drop("batch_id")
            audit = fired if self.alert_p.audit_scope == "fired" else rows.select("r.*").drop("batch_id")
            sinks.write_audit(audit, os.path.join(self.out_dir, "audit"), batch_id=batch_id)
            AL.alert_rows(fired, self.alert_p).drop("ts").withColumn("batch_id", F.lit(int(batch_id))) \
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id") \
              .json(os.path.join(self.out_dir, "alerts"))

        w = out.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(self.control_dir, "..", "alerts"))
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def run_stream(spark: SparkSession, source_path: str, models: Models, out_dir: str, checkpoint_dir: str,
               available_now: bool = True, alert_p: AlertParams = AlertParams(), max_files_per_trigger: int = 1,
               hold_seconds: float | None = None, chart_p: ChartParams = ChartParams(),
               remember_seconds: float | None = None):
    """Start the scoring query; returns (StreamingQuery, scorer). With
    ``hold_seconds`` rows are released in event-time order (T3). Call
    ``scorer.flush(spark)`` after an available-now run to score the tail and
    fire the alerts, or ``scorer.alerts(spark, available_now=False)`` beside a
    running query. Ids are remembered for ``remember_seconds`` of event time
    behind the watermark (default: an hour or the hold, whichever is longer)."""
    control_dir = os.path.join(checkpoint_dir, "control")
    scorer = StreamScorer(models, out_dir, control_dir, chart_p=chart_p, alert_p=alert_p)
    scorer.fit_states(spark)
    remember = max(3600.0, hold_seconds or 0.0) if remember_seconds is None else remember_seconds

    def begin():
        rows = (event_stream(spark, source_path, max_files_per_trigger)
                .withColumnRenamed("is_anomaly", "label").withColumnRenamed("anomaly_type", "label_type"))
        control = spark.readStream.schema(CONTROL).option("recursiveFileLookup", "true").parquet(control_dir)
        charted = chart_states(rows, control, chart_p, hold_seconds, remember)
        w = charted.writeStream.foreachBatch(scorer).option("checkpointLocation", os.path.join(checkpoint_dir, "query"))
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()

    scorer.begin = begin
    return begin(), scorer


def counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """A10: requests, anomalies and late rows of each batch, as counted while
    the batch was written."""
    return spark.read.parquet(os.path.join(out_dir, "counters")).drop("part")


def bucket_kpi_stream(spark: SparkSession, source_path: str, checkpoint_dir: str, out_path: str,
                      bucket: str = "1 day"):
    """Tumbling per-bucket, per-service event counts. Every micro-batch
    writes its own partial counts (replaced as a whole if it is replayed), so
    no bucket waits for a watermark and late rows count; ``bucket_kpi_table``
    sums them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(F.window("ts", bucket).alias("w"), "service").agg(
            F.count("*").alias("events"), F.sum("value").alias("value_sum"))
        part.select(F.col("w.start").alias("bucket_start"), "service", "events", "value_sum",
                    F.lit(int(batch_id)).alias("batch_id")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path)

    return (event_stream(spark, source_path).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def bucket_kpi_table(spark: SparkSession, out_path: str) -> DataFrame:
    """The buckets of all micro-batches so far."""
    return spark.read.parquet(out_path).groupBy("bucket_start", "service").agg(
        F.sum("events").alias("events"), F.sum("value_sum").alias("value_sum"))


def progress_rows(query) -> list[dict]:
    """Per-batch rates from the query's progress reports."""
    rows = []
    for p in query.recentProgress:
        rows.append({"batch_id": p.get("batchId"), "input_rows": p.get("numInputRows"),
                     "input_rows_per_sec": p.get("inputRowsPerSecond"),
                     "processed_rows_per_sec": p.get("processedRowsPerSecond"),
                     "trigger_ms": (p.get("durationMs") or {}).get("triggerExecution")})
    return rows
