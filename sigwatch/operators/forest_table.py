"""The isolation forest as a table of nodes, grown by built-in columns alone.

Each tree draws its rows by a hash of row and tree; a node's split feature and
split value come from hashes of tree and node, so any engine with md5 grows the
same trees. All trees grow a level at a time: the rows of all samples, dealt out by
tree once, get their node's counts and ranges from a window, then their child.

A row's path lengths are added up as whole numbers of 1/10,000, so neither the
sum nor a comparison with the threshold depends on the order of trees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import hashed_uniform
from .forest import avg_path_length

UNIT = 10_000


def depth_of(sample: int) -> int:
    return math.ceil(math.log2(max(sample, 2)))


def tree_rows(train: DataFrame, cols, trees: int, sample: int) -> DataFrame:
    """(tree, event_id, x0, x1, ...): per tree the ``sample`` rows of least
    hash, from a hash pool whose size depends on the parameters only."""
    n = train.count()
    share = min(1.0, 1.2 * (trees * sample) / n) if n else 1.0
    pool = train.where(hashed_uniform("event_id", ":pool") < F.lit(share))
    drawn = pool.select("event_id", *[F.col(c).alias(f"x{i}") for i, c in enumerate(cols)],
                        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = drawn.withColumn("_h", hashed_uniform(F.concat_ws(":", "event_id", "tree"), ":draw"))
    by = Window.partitionBy("tree").orderBy("_h", "event_id")
    return drawn.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= sample).drop("_r", "_h")


def grow(rows: DataFrame, n_cols: int, max_depth: int) -> DataFrame:
    """The node table: tree, node (root 1, children 2k and 2k + 1), feature
    (-1: leaf), split (a value below it goes to 2k), size, depth."""
    xs = [f"x{i}" for i in range(n_cols)]
    by = Window.partitionBy("tree", "node")
    out = rows.select("tree", "event_id", *xs, F.lit(1).cast("long").alias("node"), F.lit(False).alias("done"))
    kept: list[str] = []
    for depth in range(max_depth + 1):
        seen = out.select("*", F.count(F.lit(1)).over(by).alias("size"),
                          *[F.min(x).over(by).alias(f"lo{i}") for i, x in enumerate(xs)],
                          *[F.max(x).over(by).alias(f"hi{i}") for i, x in enumerate(xs)])
        wide = [F.when(F.col(f"hi{i}") > F.col(f"lo{i}"), 1).otherwise(0) for i in range(n_cols)]
        total = sum(wide[1:], wide[0])
        key = F.concat_ws(":", "tree", "node")
        rank = F.floor(hashed_uniform(key, ":feature") * total)
        feature, before = F.lit(-1), F.lit(0)
        choice = None
        for i in range(n_cols):
            hit = (wide[i] == 1) & (rank == before)
            choice = F.when(hit, i) if choice is None else choice.when(hit, i)
            before = before + wide[i]
        splits = (F.col("size") > 1) & (total > 0) & F.lit(depth < max_depth)
        seen = seen.withColumn("feature", F.when(splits, choice).otherwise(feature))
        low = F.coalesce(*[F.when(F.col("feature") == i, F.col(f"lo{i}")) for i in range(n_cols)])
        high = F.coalesce(*[F.when(F.col("feature") == i, F.col(f"hi{i}")) for i in range(n_cols)])
        seen = seen.withColumn("split", F.coalesce(low + hashed_uniform(key, ":split") * (high - low), F.lit(0.0)))
        own = F.coalesce(*[F.when(F.col("feature") == i, F.col(x)) for i, x in enumerate(xs)])
        step = f"s{depth}"
        node = F.struct("node", "feature", "split", "size", F.lit(depth).alias("depth"))
        out = seen.select(
            "tree", "event_id", *xs, *kept, F.when(~F.col("done"), node).alias(step),
            F.when(F.col("done") | (F.col("feature") < 0), F.col("node"))
             .otherwise(2 * F.col("node") + F.when(own >= F.col("split"), 1).otherwise(0)).alias("node"),
            (F.col("done") | (F.col("feature") < 0)).alias("done"))
        kept.append(step)
    return out.select("tree", F.explode(F.array(*kept)).alias("n")).where("n is not null").select("tree", "n.*") \
              .dropDuplicates(["tree", "node"])


@dataclass
class NodeTable:
    """The forest packed by (tree, node): at most trees x 2^(depth + 1) nodes."""
    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray  # of a walk that ends here, in 1/UNIT
    sample: int

    @staticmethod
    def packed(nodes: pd.DataFrame, trees: int, max_depth: int, sample: int) -> "NodeTable":
        width = 2 ** (max_depth + 1)
        feature, split = np.full((trees, width), -1), np.zeros((trees, width))
        # a child without sample rows is a leaf of size 0
        path = np.tile(UNIT * np.floor(np.log2(np.maximum(np.arange(width), 1))).astype(np.int64), (trees, 1))
        at = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
        feature[at], split[at] = nodes["feature"], nodes["split"]
        path[at] += np.floor(avg_path_length(nodes["size"].to_numpy()) * UNIT + 0.5).astype(np.int64)
        return NodeTable(feature, split, path, sample)

    def path_sums(self, x: np.ndarray) -> np.ndarray:
        """Path lengths over all trees, all rows and trees a level at a time."""
        trees = np.arange(len(self.feature))[None]
        node = np.ones((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[trees, node]
            inner = feature >= 0
            if not inner.any():
                return self.path[trees, node].sum(axis=1)
            right = x[rows, np.maximum(feature, 0)] >= self.split[trees, node]
            node = np.where(inner, 2 * node + right, node)

    def scores(self, sums: np.ndarray) -> np.ndarray:
        """-2^(-mean path / c(sample)), as the forest's ``score_samples``."""
        c = float(avg_path_length(np.array([self.sample]))[0])
        return -np.power(2.0, -(sums / (UNIT * len(self.feature))) / c)


def fit(train: DataFrame, cols, trees: int = 100, sample: int = 128) -> NodeTable:
    rows = tree_rows(train, cols, trees, sample)
    nodes = grow(rows, len(cols), depth_of(sample))
    size = min(sample, train.count())
    return NodeTable.packed(nodes.toPandas(), trees, depth_of(sample), size)


def score(df: DataFrame, cols, table: NodeTable) -> DataFrame:
    """Adds ``path_sum`` (long) and ``raw_score``."""
    shared = df.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([T.StructField("path_sum", T.LongType()), T.StructField("raw_score", T.DoubleType())])

    @F.pandas_udf(schema)
    def walk(*columns: pd.Series) -> pd.DataFrame:
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
        sums = np.concatenate([shared.value.path_sums(x[a:a + 4096]) for a in range(0, len(x), 4096)]) if len(x) \
            else np.empty(0, np.int64)
        return pd.DataFrame({"path_sum": sums, "raw_score": shared.value.scores(sums)})

    return df.withColumn("_walk", walk(*[F.col(c) for c in cols])).select("*", "_walk.path_sum", "_walk.raw_score").drop("_walk")
