"""Vote / confidence fusion of three detectors (pure column arithmetic)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fround, severity
from ..schema import DEFAULT_WEIGHTS, DETECTORS

STRATEGIES = ("majority_vote", "any", "all", "weighted")


def fuse(df: DataFrame, detectors: list[tuple[str, str, str]], strategy: str = "majority_vote",
         weights: dict | None = None) -> DataFrame:
    """F1-F6. ``detectors`` = [(name, vote_col, confidence_col)] in vote order.

    Adds ``is_anomaly``, ``ensemble_confidence`` (rounded 4), ``severity``
    (from the rounded confidence; ``Normal`` when not anomalous), ``votes``
    and ``detector_confidences`` maps and ``fusion_strategy``."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown fusion strategy {strategy!r}")
    w = dict(DEFAULT_WEIGHTS if weights is None else weights)
    votes = [F.coalesce(F.col(v), F.lit(False)) for _, v, _ in detectors]
    confs = [F.coalesce(F.col(c), F.lit(0.0)) for _, _, c in detectors]
    weighted = reduce(lambda a, b: a + b,
                      [cf * F.lit(float(w[name])) for (name, _, _), cf in zip(detectors, confs)])
    if strategy == "majority_vote":
        n_yes = reduce(lambda a, b: a + b, [v.cast("int") for v in votes])
        flag = n_yes >= 2
        conf = F.when(flag, weighted).otherwise(weighted * F.lit(0.5))
    elif strategy == "any":
        flag = reduce(lambda a, b: a | b, votes)
        conf = F.greatest(*confs)
    elif strategy == "all":
        flag = reduce(lambda a, b: a & b, votes)
        conf = F.least(*confs)
    else:
        flag = weighted > F.lit(0.5)
        conf = weighted
    vote_map = F.create_map(*[x for (name, _, _), v in zip(detectors, votes) for x in (F.lit(name), v)])
    conf_map = F.create_map(*[x for (name, _, _), c in zip(detectors, confs) for x in (F.lit(name), c)])
    voted = F.array(*[F.when(v, F.lit(name)) for (name, _, _), v in zip(detectors, votes)])
    return (df.withColumn("is_anomaly", flag)
              .withColumn("ensemble_confidence", fround(conf, 4))
              .withColumn("severity", severity("ensemble_confidence", "is_anomaly"))
              .withColumn("votes", vote_map)
              .withColumn("detector_confidences", conf_map)
              .withColumn("voted_detectors", F.filter(voted, lambda x: x.isNotNull()))
              .withColumn("fusion_strategy", F.lit(strategy)))


def fuse_reference(df: DataFrame, strategy: str = "majority_vote", weights: dict | None = None) -> DataFrame:
    """F7 fusion over the reference's detectors (columns ``if_*``, ``ae_*``, ``cc_*``)."""
    cols = [("if_is_anomaly", "if_confidence"), ("ae_is_anomaly", "ae_confidence"),
            ("cc_is_anomaly", "cc_confidence")]
    return fuse(df, [(n, v, c) for n, (v, c) in zip(DETECTORS, cols)], strategy, weights)
