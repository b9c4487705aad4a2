"""The full detector pipeline: fit on the baseline, score the stream, fuse.

Plan shape: read -> overlay -> cut -> fit jobs (bounded) -> small models ->
one lazy scoring plan: range shuffle (W1), shuffle on ``batch_key``
(features, IF confidence), Arrow UDFs (IF, AE), shuffle on the series key
(control-chart fold), fusion columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import autoencoder as AE
from ..operators import charts
from ..operators import features as FT
from ..operators import forest as IF
from ..operators.ensemble import fuse_reference
from ..operators.small import materialize
from ..schema import AutoencoderParams, ChartParams, ForestParams, RunParams
from . import data

EVENT_OUT = ["event_id", "ts", "service", "metric_name", "value", "label", "label_type"]


@dataclass
class Models:
    forest: IF.Forest
    autoencoder: AE.AutoencoderModel
    metric_index: DataFrame
    baseline: DataFrame


def fit(baseline: DataFrame, forest_p: ForestParams = ForestParams(),
        ae_p: AutoencoderParams = AutoencoderParams()) -> Models:
    """F7 fit: both models on the baseline features (one whole sequence)."""
    mi = FT.metric_index(baseline)
    b = FT.whole_sequence(baseline, lambda rows: FT.autoencoder_features(rows, mi))
    # the training table is read by several fit jobs: write it once
    b = materialize(b.select("event_id", *FT.AE_FEATURES))
    forest = IF.fit_forest(b, FT.FOREST_FEATURES, forest_p)
    ae = AE.fit_autoencoder(b, FT.AE_FEATURES, ae_p)
    return Models(forest, ae, mi, baseline)


def score(stream: DataFrame, models: Models, chart_p: ChartParams = ChartParams(),
          batch_rows: int | None = 500, strategy: str = "majority_vote",
          weights: dict | None = None) -> DataFrame:
    """F7 score. ``batch_rows=None`` makes every event its own batch (F8).
    J1: the three detectors' results are columns of the same row, so no
    positional alignment or re-join is needed."""
    s = stream.withColumnRenamed("is_anomaly", "label").withColumnRenamed("anomaly_type", "label_type") \
              .select(*EVENT_OUT)
    rows = None
    if batch_rows:
        s = FT.add_row_index(s, batch_rows=batch_rows)
        rows = s  # checkpointed: rows are counted by a cheap read
    else:
        s = s.withColumn("batch_key", F.lit(None).cast("long"))
    f = FT.autoencoder_features(s, models.metric_index, one_row=not batch_rows)
    f = IF.decision(f, FT.FOREST_FEATURES, models.forest)
    if batch_rows:
        f = FT.batch_minmax_confidence(f, "if_decision", "_ifc")
        f = f.withColumn("if_confidence", F.round("_ifc", 4))
    else:  # a batch of one row is flat
        f = f.withColumn("if_confidence", F.lit(0.0))
    f = AE.score(f, FT.AE_FEATURES, models.autoencoder)
    f = f.select(*EVENT_OUT, "batch_key", "if_score", "if_is_anomaly", "if_confidence",
                 "reconstruction_error", "ae_is_anomaly", "ae_confidence")
    base = models.baseline.select("event_id", "ts", "service", "metric_name", "value")
    f = charts.adaptive_chart(f, base, chart_p, rows=rows)
    return fuse_reference(f, strategy, weights)


def run(spark: SparkSession, sf_dir: str, params: RunParams = RunParams(),
        forest_p: ForestParams = ForestParams(), ae_p: AutoencoderParams = AutoencoderParams()):
    lev = data.labelled_events(spark, sf_dir, params)
    models = fit(data.baseline(lev, params), forest_p, ae_p)
    return models, score(data.stream(lev, params), models, batch_rows=params.batch_rows,
                         strategy=params.fusion, weights=params.weights)
