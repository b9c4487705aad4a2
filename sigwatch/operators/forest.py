"""Isolation forest (Liu, Ting & Zhou 2008) as Spark jobs.

Fit: a bounded hash sample of the baseline is dealt to trees (each tree
draws its own ``sample`` rows by a per-tree hash), every tree is grown in
its own ``applyInPandas`` group, and the forest (<= trees x (2*sample-1)
nodes, fixed by the parameters) comes back as a small table that is
broadcast to the scoring UDF. Score: an Arrow ``pandas_udf`` walks all
trees over a whole batch with numpy.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ForestParams
from .quantiles import percentiles
from .small import materialize

EULER_GAMMA = 0.5772156649015329
WALK_ROWS = 4096

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType()), T.StructField("node_id", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("split", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()), T.StructField("depth", T.IntegerType()),
])


def avg_path_length(n):
    """c(n): average unsuccessful-search path length in a BST of n nodes."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


def grow_tree(x: np.ndarray, tree_id: int, max_depth: int, seed: int) -> list[tuple]:
    """One isolation tree over rows ``x`` (n x d); returns node tuples."""
    rng = np.random.default_rng([seed, tree_id])
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        nid = len(nodes)
        nodes.append([tree_id, nid, -1, 0.0, -1, -1, int(len(idx)), depth])
        if depth >= max_depth or len(idx) <= 1:
            return nid
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if len(cand) == 0:
            return nid
        q = int(cand[rng.integers(len(cand))])
        p = float(rng.uniform(lo[q], hi[q]))
        go_left = sub[:, q] < p
        if go_left.all() or (~go_left).all():
            return nid
        nodes[nid][2], nodes[nid][3] = q, p
        nodes[nid][4] = build(idx[go_left], depth + 1)
        nodes[nid][5] = build(idx[~go_left], depth + 1)
        return nid

    build(np.arange(len(x)), 0)
    return [tuple(n) for n in nodes]


@dataclass
class Forest:
    """Packed forest: one row of arrays per tree, padded to the widest tree."""
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf_path: np.ndarray      # depth + c(size) for leaves
    sample_size: int
    scaler_mean: np.ndarray
    scaler_std: np.ndarray
    offset: float = 0.0
    threshold: float = 0.0

    @staticmethod
    def from_nodes(nodes: pd.DataFrame, sample_size: int, mean, std) -> "Forest":
        trees = sorted(nodes["tree_id"].unique())
        width = int(nodes.groupby("tree_id").size().max())
        shape = (len(trees), width)
        feat = np.full(shape, -1, dtype=np.int64)
        split = np.zeros(shape)
        left = np.zeros(shape, dtype=np.int64)
        right = np.zeros(shape, dtype=np.int64)
        path = np.zeros(shape)
        for t, (_, g) in enumerate(nodes.groupby("tree_id", sort=True)):
            i = g["node_id"].to_numpy()
            feat[t, i] = g["feature"].to_numpy()
            split[t, i] = g["split"].to_numpy()
            left[t, i] = g["left"].to_numpy()
            right[t, i] = g["right"].to_numpy()
            path[t, i] = g["depth"].to_numpy() + avg_path_length(g["size"].to_numpy())
        return Forest(feat, split, left, right, path, sample_size, np.asarray(mean), np.asarray(std))

    def _steps(self) -> list[tuple]:
        """Per tree arrays for walking all rows alike: node i stands at 2i, its
        children (left, right) at 2i and 2i + 1, and a leaf is its own child."""
        out = []
        for t in range(self.feature.shape[0]):
            inner, at = self.feature[t] >= 0, np.arange(self.feature.shape[1])
            child = np.stack([np.where(inner, self.left[t], at), np.where(inner, self.right[t], at)], axis=1)
            depth, level = 0, np.array([0])
            while len(level := level[inner[level]]):
                depth, level = depth + 1, child[level].ravel()
            feature, split, path = np.maximum(self.feature[t], 0), self.split[t], self.leaf_path[t]
            out.append((feature.repeat(2), split.repeat(2), 2 * child.ravel(), path.repeat(2), depth))
        return out

    def score_samples(self, x_raw: np.ndarray) -> np.ndarray:
        """sklearn convention: ``-2^(-E[h(x)]/c(sample))`` (lower = more anomalous)."""
        x = (x_raw - self.scaler_mean) / self.scaler_std
        n, d = x.shape
        total = np.zeros(n)
        trees = self._steps()
        # blocks whose arrays stay in the processor's cache while all trees walk them
        for at in range(0, n, WALK_ROWS):
            values = x[at:at + WALK_ROWS].ravel()
            first = np.arange(0, len(values), d)
            for feature, split, child, path, depth in trees:
                node = np.zeros(len(first), dtype=np.int64)
                for _ in range(depth):
                    node += ~(values.take(first + feature.take(node)) < split.take(node))
                    node = child.take(node)
                total[at:at + WALK_ROWS] += path.take(node)
        mean_path = total / self.feature.shape[0]
        c = float(avg_path_length(np.array([self.sample_size]))[0])
        return -np.power(2.0, -mean_path / c)


def _xx_uniform(*cols, seed: int):
    """U[0,1) from the built-in 64-bit xxhash of the columns (cheap, codegen)."""
    h = F.xxhash64(*cols, F.lit(seed))
    return F.pmod(h, F.lit(1 << 31)).cast("double") / F.lit(float(1 << 31))


def tree_samples(train: DataFrame, params: ForestParams, n_rows: int) -> DataFrame:
    """Rows per tree, bounded independently of the baseline size: a hash pool
    of about 1.2 x trees x sample rows, then per tree the ``sample`` rows with
    the smallest per-tree hash among pool rows that pass a per-tree draw."""
    from pyspark.sql import Window
    want = params.trees * params.sample
    p0 = min(1.0, 1.2 * want / max(n_rows, 1))
    pool = train.where(_xx_uniform(F.col("event_id"), seed=params.seed) < F.lit(p0))
    pool_n = max(1.0, min(n_rows, 1.2 * want))
    q = min(1.0, 2.0 * params.sample / pool_n)
    per_tree = pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(params.trees - 1))).alias("tree_id"))
    per_tree = per_tree.withColumn("_h", _xx_uniform(F.col("event_id"), F.col("tree_id"), seed=params.seed + 1)) \
                       .where(F.col("_h") < F.lit(q))
    w = Window.partitionBy("tree_id").orderBy("_h", "event_id")
    return per_tree.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= params.sample) \
                   .drop("_rk", "_h")


def fit_forest(train: DataFrame, feature_cols, params: ForestParams = ForestParams()) -> Forest:
    """Fit on baseline feature rows (needs ``event_id`` and ``feature_cols``)."""
    cols = list(feature_cols)
    stats = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                      *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
                      F.count("*").alias("n")).first()
    mean = np.array([stats[f"m{i}"] for i in range(len(cols))], dtype=np.float64)
    std = np.array([stats[f"s{i}"] for i in range(len(cols))], dtype=np.float64)
    std = np.where(std == 0, 1.0, std)
    n_rows = int(stats["n"])
    max_depth = int(math.ceil(math.log2(max(params.sample, 2))))
    seed = params.seed
    m_b, s_b = mean.copy(), std.copy()

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("event_id")  # arrival order inside a group is not fixed
        x = (pdf[cols].to_numpy(dtype=np.float64) - m_b) / s_b
        tid = int(pdf["tree_id"].iloc[0])
        return pd.DataFrame(grow_tree(x, tid, max_depth, seed), columns=[f.name for f in NODE_SCHEMA])

    samples = tree_samples(train.select("event_id", *cols), params, n_rows)
    nodes = samples.groupBy("tree_id").applyInPandas(build, NODE_SCHEMA).toPandas()
    sample_size = min(params.sample, n_rows)
    forest = Forest.from_nodes(nodes, sample_size, mean, std)
    # contamination offset and threshold from the training scores (Q9), one
    # selection: percentiles are shift-equivariant, so the threshold on the shifted
    # scores is the plain percentile minus the offset
    # written once: the selection reads its rows several times
    scored = materialize(score(train, cols, forest, "_s").select("event_id", "_s"))
    thr_pct = (100.0 - params.threshold_percentile) / 100.0
    p_off, p_thr = percentiles(scored, "_s", {"off": params.contamination, "thr": thr_pct}).first()
    forest.offset = float(p_off)
    forest.threshold = float(p_thr) - forest.offset
    return forest


def score(df: DataFrame, feature_cols, forest: Forest, out: str = "if_score") -> DataFrame:
    """Adds the raw ``score_samples`` column (use ``decision`` for the shifted score)."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(forest)

    @F.pandas_udf(T.DoubleType())
    def _score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in cols])
        return pd.Series(bc.value.score_samples(x))

    return df.withColumn(out, _score(*[F.col(c) for c in feature_cols]))


def decision(df: DataFrame, feature_cols, forest: Forest) -> DataFrame:
    """D3: ``if_score`` = score_samples - offset (rounded 6), ``if_is_anomaly``
    when below the training threshold."""
    s = score(df, feature_cols, forest, "_raw")
    d = F.col("_raw") - F.lit(forest.offset)
    return (s.withColumn("if_decision", d)
             .withColumn("if_score", F.round(d, 6))
             .withColumn("if_is_anomaly", d < F.lit(forest.threshold))
             .drop("_raw"))
