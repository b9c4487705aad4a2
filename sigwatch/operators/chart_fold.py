"""The adaptive chart of one series, folded row by row over plain floats.

A flag comes every ten rows or so in skewed data, too often for closed forms over
runs of rows: their fixed cost per run is tens of rows' worth. So a row costs a
few float operations: the window's sum and sum of squares are kept about a value
of the window and move with the rows that join and leave it. They are taken anew
every ``BLOCK`` rows, and wherever the deviation is so small against what the sums
have held that their rounding could show.

Results are rounded for whole blocks at once.

Rows whose value is null, NaN or infinite have null results, are not flagged
and leave the state alone.
"""

from __future__ import annotations

from math import sqrt

import numpy as np

from ..schema import ChartParams

BLOCK = 4096
TINY = 1e-8
#: A sum of squares below this share of its peak is taken anew.
DOUBTFUL = 1e-6

RESULTS = ("z_score", "cusum_pos", "cusum_neg", "control_mean", "control_std", "upper_limit", "lower_limit",
           "cc_is_anomaly", "rule_triggered", "cc_confidence")
RULES = np.array(["", "3sigma", "cusum_up", "cusum_down"], dtype=object)


def clamped_sum(start: float, steps: np.ndarray) -> np.ndarray:
    total = start + np.cumsum(steps)
    return total - np.minimum(0.0, np.minimum.accumulate(total))


def rounded(values: np.ndarray, places: int) -> np.ndarray:
    """Python's ``round`` of many values. Away from ties and below 2^52 scaled,
    the nearest multiple divided once is the same double; the rest is rounded one by one."""
    scale = 10.0 ** places
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = values * scale
        whole = np.rint(scaled)
        out = whole / scale
        # the product is off by half an ulp at most: far less than this below 1e11
        sure = (np.abs(np.abs(scaled - whole) - 0.5) > 1e-4) & (np.abs(scaled) < 1e11)
    for k in np.flatnonzero(~sure).tolist():
        out[k] = round(float(values[k]), places)
    return out


def _ratio(a: float, b: float) -> float:
    """a / b as floats divide: a fitted deviation may be zero."""
    if b:
        return a / b
    return float("nan") if a == 0 or a != a else (float("inf") if a > 0 else float("-inf"))


class SeriesFold:
    """State between rows: window of values, two CUSUMs, fitted limits."""

    def __init__(self, params: ChartParams, fit_mean=None, fit_std=None, window=(), cpos: float = 0.0, cneg: float = 0.0):
        self.p = params
        known = fit_mean is not None and np.isfinite(fit_mean) and fit_std is not None and np.isfinite(fit_std)
        self.fit = (float(fit_mean), float(fit_std)) if known else None
        values = np.asarray(window, dtype=np.float64)
        self.window = values[np.isfinite(values)][-params.window:]
        self.cusum = (float(cpos or 0.0), float(cneg or 0.0))

    def warm(self, values: np.ndarray) -> None:
        """Baseline values: they fill the window and are not judged."""
        self.window = np.concatenate([self.window, values[np.isfinite(values)]])[-self.p.window:]

    def _window_rows(self) -> float:
        """Rows that the window must hold before limits are taken from it."""
        if self.fit is None:
            return 1
        return max(1, self.p.min_window) if self.p.adaptive else float("inf")

    def limits(self) -> tuple[float, float]:
        """Mean and deviation in front of the next row."""
        held = len(self.window)
        if held < self._window_rows():
            return self.fit or (0.0, 1.0)
        centre, total, squares = _about(self.window)
        shift = total / held
        return centre + shift, sqrt(max(squares / held - shift * shift, 0.0)) + TINY

    def judge(self, values: np.ndarray) -> tuple[np.ndarray, ...]:
        """z, CUSUMs (before a reset), mean, deviation and rule of finite values, in order."""
        blocks = [self._block(values[at:at + BLOCK]) for at in range(0, len(values), BLOCK)]
        return tuple(np.concatenate(x) for x in zip(*blocks)) if blocks else (*[np.empty(0)] * 5, np.empty(0, dtype=np.int64))

    def _block(self, values: np.ndarray) -> tuple:
        p = self.p
        k, h, sigma, adaptive, size, needed = p.cusum_k, p.cusum_h, p.sigma, p.adaptive, p.window, self._window_rows()
        window, first = self.window.tolist(), 0
        held = len(window)
        centre, total, squares = _about(self.window) if held else (0.0, 0.0, 0.0)
        peak = squares
        up, down = self.cusum
        mean, std = self.fit or (0.0, 1.0)
        moved = True
        zs, ups, downs, means, stds, rules = [], [], [], [], [], []
        for x in values.tolist():
            if moved and held >= needed:
                shift = total / held
                spread = squares / held - shift * shift
                if spread * held < DOUBTFUL * peak and peak > 1e-20 * held:
                    centre, total, squares = _about(np.array(window[first:]))
                    peak = squares
                    shift = total / held
                    spread = squares / held - shift * shift
                mean = centre + shift
                std = (0.0 if spread <= 0.0 else sqrt(spread)) + TINY
            moved = False
            z = (x - mean) / std if std else _ratio(x - mean, std)
            up += z - k
            if up < 0.0:
                up = 0.0
            down -= z + k
            if down < 0.0:
                down = 0.0
            rule = 1 if z > sigma or z < -sigma else 2 if up > h else 3 if down > h else 0
            zs.append(z)
            ups.append(up)
            downs.append(down)
            means.append(mean)
            stds.append(std)
            rules.append(rule)
            if rule > 1:
                up = down = 0.0
            if rule == 0 or not adaptive:
                if held == 0:
                    centre = x
                y = x - centre
                window.append(x)
                total += y
                squares += y * y
                if held == size:
                    y = window[first] - centre
                    first += 1
                    total -= y
                    squares -= y * y
                else:
                    held += 1
                if squares > peak:
                    peak = squares
                moved = True
        self.window = np.array(window[first:], dtype=np.float64)
        self.cusum = (up, down)
        return (*[np.array(x, dtype=np.float64) for x in (zs, ups, downs, means, stds)], np.array(rules, dtype=np.int64))

    def columns(self, values: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which values are finite, and the result columns of those, in order."""
        p = self.p
        finite = np.isfinite(values)
        z, up, down, mean, std, rule = self.judge(values[finite])
        sure = np.maximum(np.minimum(np.abs(z) / (2 * p.sigma), 1.0),
                          np.minimum(np.maximum(up, down) / (2 * p.cusum_h), 1.0))
        shown = np.where(rule > 1, 0.0, 1.0)  # an alarm reports the CUSUMs after their reset
        # the mean of 2-decimal data can sit on a tie of the fourth place:
        # settle its last bits at eight places first
        columns = [rounded(z, 4), rounded(up * shown, 4), rounded(down * shown, 4), rounded(rounded(mean, 8), 4),
                   rounded(std, 4), rounded(mean + p.sigma * std, 4), rounded(mean - p.sigma * std, 4), rule > 0,
                   RULES[rule], rounded(sure, 4)]
        return finite, dict(zip(RESULTS, columns))

    def fold(self, values: np.ndarray) -> dict[str, list]:
        """Judge rows in order; one list per result column."""
        finite, found = self.columns(values)
        columns = [x.tolist() for x in found.values()]
        if not finite.all():
            places = np.flatnonzero(finite).tolist()
            blanks = [None] * 7 + [False, "", None]
            for k, (column, blank) in enumerate(zip(columns, blanks)):
                full = [blank] * len(finite)
                for place, v in zip(places, column):
                    full[place] = v
                columns[k] = full
        return dict(zip(RESULTS, columns))


def _about(window: np.ndarray) -> tuple[float, float, float]:
    """A value of the window near its mean; sum and sum of squares about it."""
    centre = window[np.abs(window - window.mean()).argmin()]
    about = window - centre
    return float(centre), float(about.sum()), float(about @ about)
