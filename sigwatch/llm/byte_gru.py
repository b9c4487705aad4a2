"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in windows, one recurrent layer in each
direction; every position gets a probability for every language, and a
document's probabilities are the mean over all its letter positions (ASCII
letters and bytes of other scripts). Whole texts are read, none is cut short.

Training is numpy backpropagation through time on a bounded sample: per
language the ``PER_LANGUAGE`` documents of smallest hashed id among the
labelled rows outside the held-out fold, ``WINDOWS`` windows spread evenly over
each. Every language is learned: with more of them each has fewer documents
(``SAMPLE`` in all, but one each at least), and the network has more states and
rounds. Only that sample reaches the driver. Source and id are never inputs.

Defined results: null texts and texts without a letter are ``und`` with score
0; without a labelled row every text is ``und``; rows with a null id are in the
training fold; repeated rows count and return once each; extra columns are
ignored, or kept by ``keep_identified``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import as_batch, start, utf8

PER_LANGUAGE = 600
SAMPLE = 38400
WINDOWS = 6
LENGTH = 64
#: States a direction and training rounds, at least; both grow with the languages.
HIDDEN = 6
ROUNDS, ROUNDS_EACH = 320, 20
BATCH = 128
RATE = 0.012
#: Windows that the network reads side by side, and probabilities held for them.
BLOCK, HELD = 2048, 1 << 23

_LETTER = re.compile(r"[^\W\d_]")
_COUNTS = np.zeros(256, np.float32)
_COUNTS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def windows_of(raw: bytes, length: int = LENGTH) -> np.ndarray:
    """The bytes as rows of ``length``, the last one filled with spaces."""
    n = max(1, -(-len(raw) // length))
    return np.frombuffer(raw.ljust(n * length, b" "), np.uint8).reshape(n, length)


# ---- the network ---------------------------------------------------------------
#
# One direction, with a byte's input weights i (r, z, n) taken from a table:
#   r = s(i_r + U_r h), z = s(i_z + U_z h), n = tanh(i_n + r * (U_n h)), h' = n + z (h - n)
# and s(x) = (1 + tanh x) / 2 (the usual factor 1/2 is part of the weights).
# Arrays are (feature, batch), so that every operation runs along memory.

def states_for(n_labels: int) -> int:
    return max(HIDDEN, int(np.ceil(3 * np.sqrt(n_labels))))


def new_network(n_labels: int, hidden: int = HIDDEN, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = {"out": rng.normal(0, 0.3, (n_labels, 2 * hidden)), "bias": np.zeros((n_labels, 1))}
    for side in "fb":
        net["in_" + side] = rng.normal(0, 0.3, (3 * hidden, 256))
        net["u_" + side] = rng.normal(0, 0.3, (3 * hidden, hidden))
    return {k: v.astype(np.float32) for k, v in net.items()}


def run_side(x: np.ndarray, table: np.ndarray, u: np.ndarray, out: np.ndarray, trace: list | None = None) -> None:
    """Reads x (steps, batch) in its order; out (steps, hidden, batch) gets the
    states. ``trace`` gets what the backward pass needs."""
    steps, batch = x.shape
    size = u.shape[1]
    h = np.zeros((size, batch), u.dtype)
    i, a = np.empty((3 * size, batch), u.dtype), np.empty((3 * size, batch), u.dtype)
    gates, new = np.empty((2 * size, batch), u.dtype), np.empty((size, batch), u.dtype)
    r, z = gates[:size], gates[size:]
    for t in range(steps):
        table.take(x[t], axis=1, out=i, mode="clip")
        np.matmul(u, h, out=a)
        np.add(i[:2 * size], a[:2 * size], out=gates)
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        np.multiply(r, a[2 * size:], out=new)
        new += i[2 * size:]
        np.tanh(new, out=new)
        if trace is not None:
            trace.append((h.copy(), r.copy(), z.copy(), new.copy(), a[2 * size:].copy()))
        h -= new
        h *= z
        h += new
        out[t] = h


def run(net: dict, x: np.ndarray, traces: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States (steps, 2 hidden, batch) and label probabilities (steps, label,
    batch) of every position."""
    size = net["u_f"].shape[1]
    states = np.empty((len(x), 2 * size, x.shape[1]), net["u_f"].dtype)
    traces = traces or {"f": None, "b": None}
    run_side(x, net["in_f"], net["u_f"], states[:, :size], traces["f"])
    run_side(x[::-1], net["in_b"], net["u_b"], states[::-1, size:], traces["b"])
    p = np.matmul(net["out"], states)
    p += net["bias"]
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return states, p


def gradients(net: dict, x: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients by backpropagation through time: the mean cross
    entropy of the document's label over the letter positions."""
    size = net["u_f"].shape[1]
    traces: dict[str, list] = {"f": [], "b": []}
    states, p = run(net, x, traces)
    weight = _COUNTS[x]
    weight = weight / max(1.0, float(weight.sum()))
    right = np.zeros((p.shape[1], p.shape[2]), p.dtype)
    right[labels, np.arange(len(labels))] = 1
    loss = float(-(np.log((p * right).sum(axis=1) + 1e-9) * weight).sum())
    d = (p - right) * weight[:, None, :].astype(p.dtype)
    grads = {"out": np.einsum("tkb,thb->kh", d, states, optimize=True), "bias": d.sum(axis=(0, 2))[:, None]}
    above = np.matmul(net["out"].T, d)
    for side, order, part in (("f", x, above[:, :size]), ("b", x[::-1], above[::-1, size:])):
        u, trace = net["u_" + side], traces[side]
        du, dinput = np.zeros_like(u), np.empty((3 * size, *order.shape), u.dtype)
        back = np.zeros((size, x.shape[1]), u.dtype)
        for t in range(len(order) - 1, -1, -1):
            h, r, z, n, an = trace[t]
            g = part[t] + back
            dn = g * (1 - z) * (1 - n * n)
            dz = g * (h - n) * 2 * z * (1 - z)
            dr = dn * an * 2 * r * (1 - r)
            da = np.concatenate([dr, dz, dn * r])
            du += da @ h.T
            back = g * z + u.T @ da
            da[2 * size:] = dn
            dinput[:, t] = da
        flat = order.ravel()
        grads["in_" + side] = np.stack([np.bincount(flat, row.ravel(), 256) for row in dinput]).astype(u.dtype)
        grads["u_" + side] = du
    return loss, grads


def train(x: np.ndarray, labels: np.ndarray, n_labels: int, rounds: int | None = None, batch: int = BATCH,
          rate: float = RATE, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam over random batches, languages drawn evenly; x is (windows, length)."""
    rounds = rounds or max(ROUNDS, ROUNDS_EACH * n_labels)
    net = new_network(n_labels, states_for(n_labels), seed)
    rng = np.random.default_rng(seed)
    by_label = [np.flatnonzero(labels == k) for k in range(n_labels)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    for step in range(1, rounds + 1):
        drawn = rng.integers(0, n_labels, batch)
        pick = np.array([by_label[k][rng.integers(len(by_label[k]))] for k in drawn])
        _, grads = gradients(net, np.ascontiguousarray(x[pick].T), labels[pick])
        scale = rate * min(1.0, 2.0 * (1 - (step - 1) / rounds))
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            net[k] -= scale * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def pooled(net: dict, raws: list[bytes], block: int = BLOCK) -> np.ndarray:
    """Mean label probabilities of each text over its letter positions (zeros
    where there is none)."""
    block = max(1, min(block, HELD // (LENGTH * len(net["out"]))))
    counts = [max(1, -(-len(r) // LENGTH)) for r in raws]
    x = np.concatenate([windows_of(r) for r in raws])
    sums = np.empty((len(x), len(net["out"])), np.float64)
    weights = np.empty(len(x), np.float64)
    for a in range(0, len(x), block):
        part = np.ascontiguousarray(x[a:a + block].T)
        _, p = run(net, part)
        w = _COUNTS[part]
        sums[a:a + block] = np.einsum("tkb,tb->bk", p, w)
        weights[a:a + block] = w.sum(axis=0)
    first = np.cumsum([0] + counts[:-1])
    return np.add.reduceat(sums, first) / np.maximum(np.add.reduceat(weights, first), 1.0)[:, None]


# ---- on tables ------------------------------------------------------------------

def training_windows(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels of the sample."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row a language, as in the model
    names = sorted(r["lang"] for r in counts)
    if not names:
        return [], np.empty((0, LENGTH), np.uint8), np.empty(0, np.int64)
    each = min(PER_LANGUAGE, max(1, SAMPLE // len(names)))
    # the smallest hashes are ranked: only as many rows as make sure of them reach a language's task
    cuts = [(r["lang"], -2 ** 63 + min(2 ** 64 - 1, 2 ** 64 * (3 * each + 60) // r["n"])) for r in counts]
    cuts = docs.sparkSession.createDataFrame(cuts, "_of string, cut long")
    hashed = F.xxhash64("doc_id")
    usable = usable.join(F.broadcast(cuts), F.col("lang") == F.col("_of")).where(hashed <= F.col("cut")).select("doc_id", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "doc_id"))
    chosen = (usable.withColumn("r", rank).where(F.col("r") <= each)
              .select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct())

    def cut(batches):
        for batch in batches:
            rows = []
            for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                x = windows_of(utf8(text))
                at = np.unique(np.linspace(0, len(x) - 1, WINDOWS).astype(int))
                rows.append((doc_id, lang, x[at].tobytes()))
            yield as_batch(rows, [("doc_id", pa.int64()), ("lang", pa.string()), ("x", pa.binary())])

    # at most SAMPLE ids, or one for each language: a bounded broadcast
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                          F.col("text").cast("string").alias("text"))
              .join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")))
              .select("doc_id", "lang", "text"))
    rows = sorted(sample.mapInArrow(cut, "doc_id long, lang string, x binary").collect(),
                  key=lambda r: (r["lang"], r["doc_id"] is not None, r["doc_id"], bytes(r["x"])))
    x = [np.frombuffer(bytes(r["x"]), np.uint8).reshape(-1, LENGTH) for r in rows]
    labels = [np.full(len(w), names.index(r["lang"])) for r, w in zip(rows, x)]
    return names, np.concatenate(x), np.concatenate(labels)


def fit(docs: DataFrame) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Learned languages and network."""
    start(docs.sparkSession)
    names, x, labels = training_windows(docs)
    present = sorted(set(labels.tolist()))
    if not present:
        return [], None
    names = [names[k] for k in present]
    return names, train(x, np.searchsorted(present, labels), len(names))


def judged(model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text."""
    names, net = model
    known = [k for k, t in enumerate(texts) if net is not None and t and _LETTER.search(t)]
    out = [("und", 0.0)] * len(texts)
    if known:
        p = pooled(net, [utf8(texts[k]) for k in known])
        for k, row in zip(known, p):
            best = int(row.argmax())
            out[k] = (names[best], float(min(1.0, row[best])))
    return out


def identify(docs: DataFrame, model=None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared = start(docs.sparkSession).sparkContext.broadcast(model or fit(docs))

    def scan(batches):
        for batch in batches:
            found = judged(shared.value, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                     F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.3, model=None) -> DataFrame:
    """The documents whose language is known with at least this score, all
    columns. Without any labelled document nothing can be learned, and all
    documents stay."""
    spark = start(docs.sparkSession)
    model = model or fit(docs)
    if model[1] is None:
        return docs
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def scan(batches):
        for batch in batches:
            found = judged(shared.value, batch.column(at).to_pylist())
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
