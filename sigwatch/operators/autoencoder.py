"""Autoencoder detector: data-parallel training by parameter mixing.

All training rows are hashed into shards whose number follows the data. Each round every shard runs a few local SGD epochs
from the current weights inside ``applyInPandas`` and returns its weights,
row count and epoch losses; Spark averages the weights by row count (one
row per weight comes to the driver). Scoring is
an Arrow ``pandas_udf`` with the weights broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import AutoencoderParams
from .quantiles import percentiles
from .small import materialize

SHARD_SCHEMA = T.StructType([
    T.StructField("shard", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("losses", T.ArrayType(T.DoubleType())),
])


def layer_dims(n_in: int, p: AutoencoderParams) -> list[tuple[int, int]]:
    sizes = [n_in, *p.hidden, p.latent, *reversed(p.hidden), n_in]
    return list(zip(sizes[:-1], sizes[1:]))


def init_weights(n_in: int, p: AutoencoderParams) -> list[np.ndarray]:
    """He initialisation, biases zero; one seeded stream per layer."""
    out = []
    for i, (a, b) in enumerate(layer_dims(n_in, p)):
        rng = np.random.default_rng([p.seed, i])
        out += [rng.standard_normal((a, b)) * np.sqrt(2.0 / a), np.zeros(b)]
    return out


def flatten(ws) -> np.ndarray:
    return np.concatenate([w.ravel() for w in ws])


def unflatten(vec: np.ndarray, n_in: int, p: AutoencoderParams) -> list[np.ndarray]:
    out, i = [], 0
    for a, b in layer_dims(n_in, p):
        out.append(vec[i:i + a * b].reshape(a, b))
        i += a * b
        out.append(vec[i:i + b].copy())
        i += b
    return out


def forward(ws, x, keep=False):
    acts, pre = [x], []
    h = x
    n_layers = len(ws) // 2
    for li in range(n_layers):
        z = h @ ws[2 * li] + ws[2 * li + 1]
        pre.append(z)
        h = np.maximum(z, 0.0) if li < n_layers - 1 else z
        acts.append(h)
    return (h, acts, pre) if keep else h


def sgd_epochs(ws, x: np.ndarray, epochs: int, p: AutoencoderParams, rng) -> tuple[list, list[float]]:
    """Plain mini-batch SGD on MSE (gradient ``2(x_hat - x)/rows``)."""
    n = len(x)
    losses = []
    n_layers = len(ws) // 2
    for _ in range(epochs):
        order = rng.permutation(n)
        total, batches = 0.0, 0
        for s in range(0, n, p.batch_size):
            b = x[order[s:s + p.batch_size]]
            out, acts, pre = forward(ws, b, keep=True)
            total += float(np.mean((b - out) ** 2))
            batches += 1
            g = 2.0 * (out - b) / b.shape[0]
            for li in reversed(range(n_layers)):
                if li < n_layers - 1:
                    g = g * (pre[li] > 0)
                gw = acts[li].T @ g
                gb = g.sum(axis=0)
                g = g @ ws[2 * li].T
                ws[2 * li] -= p.lr * gw
                ws[2 * li + 1] -= p.lr * gb
        losses.append(total / max(batches, 1))
    return ws, losses


@dataclass
class AutoencoderModel:
    weights: np.ndarray
    n_in: int
    params: AutoencoderParams
    mean: np.ndarray
    std: np.ndarray
    threshold: float = 0.0
    losses: list = field(default_factory=list)

    def errors(self, x_raw: np.ndarray) -> np.ndarray:
        x = (x_raw - self.mean) / (self.std + 1e-8)
        ws = unflatten(self.weights, self.n_in, self.params)
        out = forward(ws, x)
        return np.mean((x - out) ** 2, axis=1)


def _local_round(cur, ep, r, cols, m_b, s_b, n_in, p):
    """One shard's local epochs from the current weights."""
    def local(pdf):
        pdf = pdf.sort_values("event_id")
        x = (pdf[cols].to_numpy(dtype=np.float64) - m_b) / (s_b + 1e-8)
        sh = int(pdf["shard"].iloc[0])
        ws = unflatten(cur.copy(), n_in, p)
        ws, losses = sgd_epochs(ws, x, ep, p, np.random.default_rng([p.seed, r, sh]))
        return pd.DataFrame({"shard": [sh], "n": [len(x)], "weights": [flatten(ws)],
                             "losses": [np.asarray(losses)]})
    return local


def fit_autoencoder(train: DataFrame, feature_cols, p: AutoencoderParams = AutoencoderParams()) -> AutoencoderModel:
    """D6 + D8: returns the model with its per-epoch loss history."""
    cols = list(feature_cols)
    st = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
                   F.count("*").alias("n")).first()
    mean = np.array([st[f"m{i}"] for i in range(len(cols))], dtype=np.float64)
    std = np.array([st[f"s{i}"] for i in range(len(cols))], dtype=np.float64)
    n_rows = int(st["n"])
    shards = max(p.shards, -(-n_rows // p.shard_rows))
    rows = train.select("event_id", *cols)
    shard = F.pmod(F.xxhash64("event_id", F.lit(p.seed + 1)), F.lit(shards)).cast("int")
    data = materialize(rows.withColumn("shard", shard))   # re-read every round
    n_in = len(cols)
    vec = flatten(init_weights(n_in, p))
    history: list[float] = []
    rounds = max(1, -(-p.epochs // p.epochs_per_round))
    m_b, s_b = mean.copy(), std.copy()
    for r in range(rounds):
        ep = min(p.epochs_per_round, p.epochs - r * p.epochs_per_round)
        cur = vec.copy()

        res = materialize(data.groupBy("shard").applyInPandas(
            _local_round(cur, ep, r, cols, m_b, s_b, n_in, p), SHARD_SCHEMA))
        # the shards' weights are averaged in Spark: one row per weight comes back
        vec = _averaged(res, "weights")
        history += list(_averaged(res, "losses"))
    model = AutoencoderModel(vec, n_in, p, mean, std, losses=history)
    # written once: the selection reads its rows several times
    errs = materialize(errors(data, cols, model, "_e").select("event_id", "_e"))
    model.threshold = float(percentiles(errs, "_e", {"thr": p.threshold_percentile / 100.0}).first()["thr"])
    return model


def _averaged(res: DataFrame, column: str) -> np.ndarray:
    """Element-wise mean of an array column, weighted by the shards' rows."""
    at = res.select("n", F.posexplode(column).alias("k", "x")).groupBy("k") \
            .agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("x")).collect()
    return np.array([r["x"] for r in sorted(at, key=lambda r: r["k"])])


def errors(df: DataFrame, feature_cols, model: AutoencoderModel, out: str = "ae_error") -> DataFrame:
    bc = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def _err(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in cols])
        return pd.Series(bc.value.errors(x))

    return df.withColumn(out, _err(*[F.col(c) for c in feature_cols]))


def score(df: DataFrame, feature_cols, model: AutoencoderModel) -> DataFrame:
    """Reconstruction error (rounded 8), flag above threshold, confidence
    ``clip(err / (3 * threshold), 0, 1)`` rounded 4."""
    e = errors(df, feature_cols, model, "_err")
    thr = model.threshold
    conf = F.least(F.greatest(F.col("_err") / F.lit(3.0 * thr), F.lit(0.0)), F.lit(1.0))
    return (e.withColumn("reconstruction_error", F.round("_err", 8))
             .withColumn("ae_is_anomaly", F.col("_err") > F.lit(thr))
             .withColumn("ae_confidence", F.round(conf, 4))
             .drop("_err"))


def loss_table(spark, model: AutoencoderModel) -> DataFrame:
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.losses)],
                                 "epoch int, loss double")
