"""Ordered per-key fold over sorted partitions (``mapInPandas``, ``mapInArrow``).

Rows are hash-partitioned by the key and sorted inside each partition, so a
task sees every key's rows contiguously and in order. The fold keeps only one
key's state at a time and streams Arrow batches, so memory is bounded by the
state (not by the size of a key). Parallelism is the number of keys.
"""

from __future__ import annotations

import warnings
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _concat(frames: list[pd.DataFrame]) -> pd.DataFrame:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)
        return pd.concat(frames, ignore_index=True)


def _ordered(df: DataFrame, key_cols: list[str], order_cols: list[str], num_partitions: int | None) -> DataFrame:
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[F.col(k) for k in key_cols]) \
             .sortWithinPartitions(*[F.col(k) for k in key_cols], *[F.col(o) for o in order_cols])


def ordered_fold(df: DataFrame, key_cols: list[str], order_cols: list[str],
                 step_factory: Callable, out_schema: T.StructType,
                 num_partitions: int | None = None) -> DataFrame:
    """Apply ``step_factory(key_tuple, first_row) -> step`` per key, where
    ``step(pdf) -> pdf`` consumes consecutive rows of that key in order and
    returns the output rows (it may keep state between calls). An optional
    ``step.finish() -> pdf`` is called once after the key's last row."""
    parted = _ordered(df, key_cols, order_cols, num_partitions)
    names = [f.name for f in out_schema.fields]

    def finish(step, outs):
        fin = getattr(step, "finish", None) if step is not None else None
        if fin is not None:
            res = fin()
            if res is not None and len(res):
                outs.append(res)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur_key = None
        step = None
        for pdf in batches:
            if pdf.empty:
                continue
            keys = pdf[key_cols].astype(object).where(pdf[key_cols].notna(), None)
            tuples = list(keys.itertuples(index=False, name=None))
            # split the batch at key changes
            starts = [0] + [i for i in range(1, len(tuples)) if tuples[i] != tuples[i - 1]]
            bounds = starts + [len(tuples)]
            outs = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                k = tuples[a]
                if k != cur_key or step is None:
                    finish(step, outs)
                    cur_key = k
                    step = step_factory(k, pdf.iloc[a])
                res = step(pdf.iloc[a:b])
                if res is not None and len(res):
                    outs.append(res)
            if outs:
                yield _concat(outs)[names]
        tail = []
        finish(step, tail)
        if tail:
            yield _concat(tail)[names]

    return parted.mapInPandas(run, out_schema)


def _bounds(batch: pa.RecordBatch, key_cols: list[str]) -> list[int]:
    """Places at which the key changes, with both ends (nulls are one key)."""
    change = np.zeros(batch.num_rows, dtype=bool)
    for k in key_cols:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    return [0, *np.flatnonzero(change).tolist(), batch.num_rows]


def ordered_arrow_fold(df: DataFrame, key_cols: list[str], order_cols: list[str], step_factory: Callable,
                       out_schema: T.StructType, num_partitions: int | None = None) -> DataFrame:
    """``ordered_fold`` over Arrow batches: ``step_factory(key_tuple, first_rows)``
    and ``step(rows)`` take record batches, ``step`` and ``step.finish()`` return
    lists of Arrow arrays in the order of ``out_schema`` (or None). Columns that a
    step only hands on are never turned into Python values."""
    parted = _ordered(df, key_cols, order_cols, num_partitions)
    names = [f.name for f in out_schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = step = None
        for batch in batches:
            if not batch.num_rows:
                continue
            outs = []
            bounds = _bounds(batch, key_cols)
            for a, b in zip(bounds[:-1], bounds[1:]):
                rows = batch.slice(a, b - a)
                k = tuple(rows.column(c)[0].as_py() for c in key_cols)
                if step is None or k != key:
                    if step is not None and hasattr(step, "finish"):
                        outs.append(step.finish())
                    key, step = k, step_factory(k, rows)
                outs.append(step(rows))
            yield from _joined(outs)
        if step is not None and hasattr(step, "finish"):
            yield from _joined([step.finish()])

    def _joined(outs: list) -> Iterator[pa.RecordBatch]:
        outs = [o for o in outs if o is not None and len(o[0])]
        if outs:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) if len(c) > 1 else c[0] for c in zip(*outs)], names=names)

    return parted.mapInArrow(run, out_schema)
