"""State that the streaming engine keeps: one chart per series, one last alert
per alert key (``applyInPandasWithState``).

A micro-batch reads and writes the state of the series it holds rows of, and
of those whose waiting rows become due; others are not touched.

* T2: a series' state is its chart (window, CUSUMs, fitted limits).
* T3: rows wait in the state until the watermark (largest event time less the
  hold) has passed them, so a series is scored in event-time order. An
  event-time timer wakes a series whose waiting rows are due though no row of
  it arrives.
* T5: an id that repeats in its series is dropped while its row waits or for
  ``remember`` seconds of event time behind the watermark. Rows without an id
  are all kept. So the state is bounded by the hold and that time.
* T4: the cooldown's state is the time of the last alert.

The engine drops rows behind the watermark from an operator with event-time
timers. Late rows must be scored here, so the watermark is carried by a branch
of its own (``_clock``) that holds no rows, and the rows have no watermark
column. They are marked ``late`` if a later row of their series has been scored.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.chart_fold import RESULTS, SeriesFold
from ..operators.charts import CHART_FIELDS
from ..schema import ChartParams

ROW_FIELDS = [("event_id", T.StringType()), ("ts", T.TimestampType()), ("service", T.StringType()),
              ("metric_name", T.StringType()), ("value", T.DoubleType()), ("label", T.BooleanType()),
              ("label_type", T.StringType())]
ROW = [n for n, _ in ROW_FIELDS]

#: Rows of the control table: fitted state of each series, and the end of the stream.
CONTROL = T.StructType([T.StructField(n, t) for n, t in ROW_FIELDS if n in ("service", "metric_name")] + [
    T.StructField("win", T.ArrayType(T.DoubleType())), T.StructField("fit_mean", T.DoubleType()),
    T.StructField("fit_std", T.DoubleType()), T.StructField("until", T.TimestampType())])

CHARTED = T.StructType([T.StructField(n, t) for n, t in ROW_FIELDS] + [T.StructField(n, t) for n, t in CHART_FIELDS]
                       + [T.StructField("late", T.BooleanType())])

STATE = T.StructType([
    T.StructField("win", T.ArrayType(T.DoubleType())), T.StructField("cpos", T.DoubleType()),
    T.StructField("cneg", T.DoubleType()), T.StructField("fit_mean", T.DoubleType()), T.StructField("fit_std", T.DoubleType()),
    T.StructField("last_us", T.LongType()), T.StructField("waiting", T.BinaryType()),
    T.StructField("seen_id", T.ArrayType(T.StringType())), T.StructField("seen_us", T.ArrayType(T.LongType()))])

_NEVER = -(1 << 62)


def _pack(rows: pd.DataFrame) -> bytes | None:
    if rows.empty:
        return None
    sink = io.BytesIO()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue()


def _unpack(packed) -> pd.DataFrame | None:
    return None if not packed else pa.ipc.open_stream(bytes(packed)).read_all().to_pandas()


def _micros(ts: pd.Series) -> np.ndarray:
    """Event times in microseconds; rows without one are before all others."""
    out = pd.to_datetime(ts).to_numpy().astype("datetime64[us]")
    return np.where(np.isnat(out), _NEVER, out.astype(np.int64))


def _new_rows(frame: pd.DataFrame, waiting: pd.DataFrame | None, seen: dict[str, int]) -> pd.DataFrame:
    """The rows whose id is neither waiting nor remembered, once each."""
    ids = frame["event_id"]
    known = ids.isin(list(seen))
    if waiting is not None:
        known |= ids.isin(waiting["event_id"].dropna())
    return frame[ids.isna() | ~(known | ids.duplicated())]


class _Series:
    """A series between two calls."""

    def __init__(self, params: ChartParams, state: GroupState):
        win, cpos, cneg, mean, std, last, waiting, ids, times = state.get if state.exists else (
            None, 0.0, 0.0, None, None, _NEVER, None, None, None)
        self.params = params
        self.fold = SeriesFold(params, mean, std, win or (), cpos, cneg)
        self.last, self.waiting = last, _unpack(waiting)
        self.seen = dict(zip(ids or (), times or ()))

    def fitted(self, row) -> None:
        """Start from the baseline: its last values and fitted limits."""
        win = row["win"]
        self.fold = SeriesFold(self.params, row["fit_mean"], row["fit_std"], () if win is None else win)

    def score(self, rows: pd.DataFrame, us: np.ndarray) -> pd.DataFrame:
        late = (us < self.last) & (us != _NEVER)
        out = rows.assign(**self.fold.fold(rows["value"].to_numpy(dtype=np.float64)), late=late)
        self.last = max(self.last, int(us.max()))
        self.seen.update((i, int(u)) for i, u in zip(rows["event_id"], us) if i is not None and i == i)
        return out

    def stored(self, waiting: pd.DataFrame, oldest: int) -> tuple:
        kept = [(i, u) for i, u in self.seen.items() if u >= oldest]
        fit = self.fold.fit or (None, None)
        return (self.fold.window.tolist(), *self.fold.cusum, *fit, self.last, _pack(waiting),
                [i for i, _ in kept], [u for _, u in kept])


def chart_states(rows: DataFrame, control: DataFrame, params: ChartParams = ChartParams(),
                 hold_seconds: float | None = None, remember_seconds: float = 3600.0) -> DataFrame:
    """Streaming rows (``ROW``) with their chart columns and ``late``, in
    event-time order per series. ``control`` is a stream of ``CONTROL`` rows.
    Without a hold, rows are scored as they arrive."""
    key = list(params.series_key)
    none = {n: F.lit(None).cast(t).alias(n) for n, t in ROW_FIELDS}
    empty = [F.lit(None).cast(CONTROL[n].dataType).alias(n) for n in ("win", "fit_mean", "fit_std")]
    no_clock = F.lit(None).cast("timestamp").alias("_clock")
    delay = f"{int(round(1000 * (hold_seconds or 0.0)))} milliseconds"
    # no partition has a negative id: the branch moves the watermark and gives no rows
    clock = (rows.select(F.col("ts").alias("_clock")).unionByName(control.select(F.col("until").alias("_clock")))
             .withWatermark("_clock", delay).where(F.spark_partition_id() < 0)
             .select(F.lit("c").alias("_kind"), *none.values(), *empty, "_clock"))
    events = rows.select(F.lit("e").alias("_kind"), *ROW, *empty, no_clock)
    fitted = control.where("until is null").select(
        F.lit("f").alias("_kind"), *[F.col(n) if n in key else c for n, c in none.items()], "win", "fit_mean", "fit_std",
        no_clock)
    held, remember = hold_seconds is not None, int(1e6 * remember_seconds)

    def step(_key, frames, state: GroupState):
        series, parts = _Series(params, state), []
        for frame in frames:
            for _, row in frame[frame["_kind"] == "f"].iterrows():
                series.fitted(row)
            parts.append(frame.loc[frame["_kind"] == "e", ROW])
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=ROW)
        rows = _new_rows(rows, series.waiting, series.seen)
        both = [x for x in (series.waiting, rows) if x is not None and len(x)]
        waiting = pd.concat(both, ignore_index=True) if both else rows
        now = state.getCurrentWatermarkMs() * 1000
        if len(waiting):
            us = _micros(waiting["ts"])
            order = waiting.assign(_us=us).sort_values(["_us", "event_id"], kind="stable", na_position="first").index
            waiting, us = waiting.loc[order].reset_index(drop=True), us[order.to_numpy()]
            due = int(np.searchsorted(us, now, "right")) if held else len(us)
            if due:
                yield series.score(waiting.iloc[:due], us[:due])[[f.name for f in CHARTED]]
            waiting, us = waiting.iloc[due:].reset_index(drop=True), us[due:]
        state.update(series.stored(waiting, now - remember))
        if len(waiting):
            # due once the watermark is past this millisecond
            state.setTimeoutTimestamp(max(now // 1000, -(-int(us[0]) // 1000) - 1))

    return clock.unionByName(events).unionByName(fitted).groupBy(*key).applyInPandasWithState(
        step, CHARTED, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def cooldown_states(anomalies: DataFrame, key: list[str], cooldown_sec: float) -> DataFrame:
    """Streaming anomalies (``key``..., ts, event_id, payload) with ``fired``:
    an anomaly fires if no alert of its key fired within the cooldown before
    it. Rows of a micro-batch are taken in event-time order."""
    gap = int(round(1e6 * cooldown_sec))
    schema = T.StructType([T.StructField("payload", T.StringType()), T.StructField("fired", T.BooleanType())])

    def step(_key, frames, state: GroupState):
        rows = pd.concat(list(frames), ignore_index=True)
        us = rows["_us"].fillna(_NEVER).astype("int64").to_numpy()
        order = rows.assign(_us=us).sort_values(["_us", "event_id"], kind="stable", na_position="first").index.to_numpy()
        us = us[order]
        last = state.get[0] if state.exists else _NEVER
        fired = np.zeros(len(us), bool)
        at = 0
        while at < len(us):
            if gap > 0 and last != _NEVER:
                at = max(at, int(np.searchsorted(us, last + gap)))
                if at >= len(us):
                    break
            fired[at] = True
            last, at = max(last, int(us[at])), at + 1
        state.update((last,))
        yield pd.DataFrame({"payload": rows["payload"].to_numpy()[order], "fired": fired})

    rows = anomalies.select(*key, F.unix_micros("ts").alias("_us"), "event_id", "payload")
    return rows.groupBy(*key).applyInPandasWithState(step, schema, "last_us long", "append", GroupStateTimeout.NoTimeout)


assert [n for n, _ in CHART_FIELDS] == list(RESULTS)
