"""Quality classifier: histogram gradient-boosted trees over document statistics.

A document becomes a vector of statistics of its whole text (``NAMES``): kinds
of characters, word and line lengths, repetition of words, word pairs and
lines. Labelled rows are binned by quantiles (at most ``BINS`` bins a
statistic); trees grow level by level, a split being chosen from histograms of
gradients and curvatures of the logistic loss. The model is flat: arrays of
split statistic, threshold, first child and value over the nodes of all trees,
so a whole batch walks a level of all trees in one numpy step.

In Spark: one scan turns texts into statistics, kept as a table; texts are not
shuffled. The labelled rows of the training folds are joined by id on the
statistics alone, and the fit takes at most ``SAMPLE`` of them: rows under a
threshold of their id's hash, set from a count, so that map tasks send few
more. The model (some thousand numbers) is broadcast.

Defined results: null, empty and blank texts have statistics of zero and a
score like others. Repeated document rows give one row each. Labels other than
0 and 1 are ignored, several labels of a document count with their mean. With
no usable label every score is 0.5, with labels of one kind it is near that
kind. A null doc_id has no label and is not held out (its checksum is that of
the empty text). Extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, start

#: Most labelled rows that the fit takes.
SAMPLE = 40_000
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.15
#: Least curvature in a leaf, and what is added to it (shrinkage of leaves).
LEAST, RIDGE = 3.0, 1.0

NAMES = ["log_chars", "log_words", "log_lines", "symbols", "digits", "upper", "lower", "other_letters", "stops", "commas",
         "marks", "spaces", "controls", "word_length", "long_words", "distinct_words", "repeated_pairs", "top_word",
         "distinct_lines", "line_words", "short_lines", "byte_entropy", "upper_words", "marked_words"]


def _kinds() -> np.ndarray:
    """0/1 rows over the 256 bytes, one a kind of character."""
    rows = {"symbols": b"#*$%&|<>{}[]\\^~_=+@/", "digits": b"0123456789", "upper": bytes(range(65, 91)),
            "lower": bytes(range(97, 123)), "other_letters": bytes(range(0xC0, 0x100)), "stops": b".",
            "commas": b",;:", "marks": b"!?", "spaces": b" \t\n\r", "controls": bytes(x for x in range(32) if x not in b"\t\n\r")}
    table = np.zeros((len(rows), 256))
    for row, chars in zip(table, rows.values()):
        row[list(chars)] = 1.0
    return table


_KINDS = _kinds()
_UPPER, _MARK = bytes(range(65, 91)), b"#*$%&|<>!?{}[]\\^~_=+@/"


def statistics(raw: bytes | None) -> list[float]:
    """The statistics of one text, in the order of ``NAMES``."""
    if not raw:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    chars = float(len(raw) - counts[0x80:0xC0].sum())
    share = counts[counts > 0] / len(raw)
    entropy = float(-(share * np.log2(share)).sum())
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    kinds = (_KINDS @ counts / max(chars, 1.0)).tolist()
    if not n:
        return [np.log1p(chars), 0.0, 0.0, *kinds, *[0.0] * 8, entropy, 0.0, 0.0]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    sizes = np.fromiter(map(len, words), np.int64, n)
    in_lines = np.array([x.count(b" ") + 1 for x in lines])
    upper = sum(c for w, c in seen.items() if len(w) > 1 and not w.strip(_UPPER + _MARK + b".,") and w[:1].isupper())
    marked = sum(c for w, c in seen.items() if w[-1] in _MARK or w[0] in _MARK)
    return [np.log1p(chars), np.log1p(n), np.log1p(len(lines)), *kinds, float(sizes.mean()),
            float((sizes > 20).mean()), len(seen) / n, 1.0 - pairs / max(n - 1, 1) if n > 1 else 0.0,
            max(seen.values()) / n, len(set(lines)) / len(lines), float(np.log1p(in_lines.mean())),
            float((in_lines < 4).mean()), entropy, upper / n, marked / n]


# ---- the trees ------------------------------------------------------------------

class Forest(NamedTuple):
    """Nodes of all trees in one row of arrays. A node with statistic -1 is a
    leaf; else a value <= threshold goes to ``child``, others to child + 1."""

    prior: float
    roots: np.ndarray
    split: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray


def margins(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Sum of leaf values per row: all rows and trees go down a level at a time."""
    at = np.repeat(forest.roots[None], len(x), axis=0)
    rows = np.arange(len(x))[:, None]
    while len(forest.roots):
        split = forest.split[at]
        inner = split >= 0
        if not inner.any():
            break
        right = x[rows, np.maximum(split, 0)] > forest.threshold[at]
        at = np.where(inner, forest.child[at] + right, at)
    return forest.prior + forest.value[at].sum(axis=1)


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(m, -40.0, 40.0)))


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per statistic the values between which bins change: quantiles, or all
    middles where there are few distinct values."""
    out = []
    for column in x.T:
        known = np.unique(column)
        if len(known) > bins:
            known = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
        out.append((known[1:] + known[:-1]) / 2)
    return out


def best_splits(codes, g, h, node, n_nodes, bins):
    """Per node the best (gain, statistic, bin) from its histograms."""
    n_stats = codes.shape[1]
    key = (node[:, None] * n_stats + np.arange(n_stats)) * bins + codes
    size = n_nodes * n_stats * bins
    of = lambda w: np.bincount(key.ravel(), np.repeat(w, n_stats), size).reshape(n_nodes, n_stats, bins)
    gl, hl = of(g).cumsum(axis=2), of(h).cumsum(axis=2)
    gt, ht = gl[:, :, -1:], hl[:, :, -1:]
    gr, hr = gt - gl, ht - hl
    gain = gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE) - gt * gt / (ht + RIDGE)
    gain[(hl < LEAST) | (hr < LEAST)] = -1.0
    best = gain.reshape(n_nodes, -1).argmax(axis=1)
    return gain.reshape(n_nodes, -1)[np.arange(n_nodes), best], best // bins, best % bins


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
          rate: float = RATE) -> Forest:
    """Boosted trees for labels (or mean labels) between 0 and 1."""
    none = np.empty(0, np.int64)
    if not len(x):
        return Forest(0.0, none, none, np.empty(0), none, np.empty(0))
    mean = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(mean / (1 - mean)))
    cuts = cut_points(x, bins)
    codes = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    margin = np.full(len(x), prior)
    split, threshold, child, value, roots = [], [], [], [], []
    for _ in range(trees):
        p = sigmoid(margin)
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(len(split))
        level, node = [len(split)], np.zeros(len(x), np.int64)  # node: place in the level, -1: in a leaf
        split.append(-1), threshold.append(0.0), child.append(0), value.append(0.0)
        step = np.zeros(len(x))
        for d in range(depth + 1):
            rows = np.flatnonzero(node >= 0)
            if not len(level):
                break
            gs = np.bincount(node[rows], g[rows], len(level))
            hs = np.bincount(node[rows], h[rows], len(level))
            leaf = -rate * gs / (hs + RIDGE)
            gain, stat, cut = best_splits(codes[rows], g[rows], h[rows], node[rows], len(level), bins) \
                if d < depth else (np.full(len(level), -1.0), none, none)
            new, first = [], np.full(len(level), -1)
            for k, at in enumerate(level):
                if gain[k] <= 1e-9:
                    value[at] = float(leaf[k])
                    continue
                first[k] = len(new)
                split[at], threshold[at], child[at] = int(stat[k]), float(cuts[stat[k]][cut[k]]), len(split)
                for _side in range(2):
                    new.append(len(split))
                    split.append(-1), threshold.append(0.0), child.append(0), value.append(0.0)
            ended = rows[first[node[rows]] < 0]
            step[ended] = leaf[node[ended]]
            on = rows[first[node[rows]] >= 0]
            here = node[on]
            node[ended] = -1
            node[on] = first[here] + (codes[on, stat[here]] > cut[here]) if len(on) else here
            level = new
        margin += step
    return Forest(prior, np.array(roots), np.array(split), np.array(threshold), np.array(child), np.array(value))


# ---- on tables ------------------------------------------------------------------

def fold(doc_id: Column) -> Column:
    """Checksum of the id as text, modulo 3: 1 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats`` (doubles in the order of ``NAMES``), one row a document."""
    def scan(batches):
        for batch in batches:
            stats = [statistics(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"])

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, "doc_id long, stats array<double>")


def training_rows(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """stats and label of at most ``sample`` rows outside the held-out fold."""
    known = (labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg(F.col("quality").cast("double")).alias("label")).where(fold(F.col("doc_id")) != 1))
    rows = stats.join(known, "doc_id").select("doc_id", "stats", "label", F.xxhash64("doc_id").alias("key"))
    n = rows.count()
    if n > sample:
        # keys are spread evenly: half as many again as wanted lie under the threshold
        rows = rows.where(F.col("key") < int(-(1 << 63) + (1 << 64) * min(1.0, 1.5 * sample / n + 100 / n)) - 1)
    return rows.orderBy("key", "doc_id", "stats").limit(sample).select("stats", "label")


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    rows = training_rows(stats, labels, sample).toPandas()
    x = np.array(rows["stats"].tolist(), float).reshape(-1, len(NAMES))
    return train(x, rows["label"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, forest: Forest | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    spark = start(docs.sparkSession)
    stats = staged(document_statistics(docs), "statistics")
    shared = spark.sparkContext.broadcast(forest or fit(stats, labels))

    def scan(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            score = sigmoid(margins(shared.value, x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return stats.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "stats").mapInArrow(
        scan, "doc_id long, held_out boolean, score double, predicted int")
