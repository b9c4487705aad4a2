"""Scalar column helpers (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SEVERITY_CUTS

TWO_POW_32 = 4294967296.0


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hashed_uniform(key, salt: str) -> Column:
    """Deterministic U[0,1) from md5(key || salt); same double in DuckDB:
    ``(('0x'||substr(md5(key||salt),1,8))::BIGINT)/4294967296.0``."""
    h = F.conv(F.substring(F.md5(F.concat(c(key).cast("string"), F.lit(salt))), 1, 8), 16, 10)
    return h.cast("bigint") / F.lit(TWO_POW_32)


def hashed_normal(key, salt: str) -> Column:
    """N(0,1) by Box-Muller over two hashed uniforms (open interval for the log)."""
    h1 = F.conv(F.substring(F.md5(F.concat(c(key).cast("string"), F.lit(salt + "a"))), 1, 8), 16, 10)
    u1 = (h1.cast("bigint") + F.lit(0.5)) / F.lit(TWO_POW_32)
    u2 = hashed_uniform(key, salt + "b")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def epoch_ms(ts="ts") -> Column:
    """Timestamp -> epoch milliseconds as double (the reference's ``timestamp``)."""
    return F.unix_micros(c(ts)) / F.lit(1000.0)


def epoch_sec(ts="ts") -> Column:
    return F.unix_micros(c(ts)) / F.lit(1_000_000.0)


def log_magnitude(v="value") -> Column:
    return F.log1p(F.abs(c(v)))


def scaled_square(v="value") -> Column:
    return c(v) * c(v) / F.lit(1e6)


def severity(conf, is_anomaly=None) -> Column:
    """Severity label of an already rounded confidence; ``Normal`` when not anomalous."""
    conf = c(conf)
    expr = None
    for label, cut in SEVERITY_CUTS:
        cond = conf >= F.lit(cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit("Low"))
    if is_anomaly is not None:
        expr = F.when(c(is_anomaly), expr).otherwise(F.lit("Normal"))
    return expr


def iso_utc(ts="ts") -> Column:
    return F.date_format(c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def alert_id(event_id="event_id") -> Column:
    """``ALT-`` + first 8 characters of the event id."""
    return F.concat(F.lit("ALT-"), F.substring(c(event_id), 1, 8))


def derived_event_id(ts="ts", service="service", metric="metric_name", host="host") -> Column:
    """16 hex chars of md5 over the natural key (replay safe)."""
    return F.substring(F.md5(F.concat_ws("-", F.unix_micros(c(ts)).cast("string"), c(service),
                                        c(metric), c(host))), 1, 16)


def clip01(x) -> Column:
    return F.least(F.greatest(c(x), F.lit(0.0)), F.lit(1.0))


def percent2(x) -> Column:
    """Python ``{:.2%}``."""
    return F.concat(F.format_string("%.2f", c(x) * F.lit(100.0)), F.lit("%"))


def fround(x, k: int = 4) -> Column:
    """Round half up as ``floor(x * 10^k + 0.5) / 10^k`` -- plain IEEE steps,
    so every engine gives the same double (Spark's ``round`` goes through the
    JVM's decimal string of the double, which is not always the shortest)."""
    p = float(10 ** k)
    return (F.floor(c(x) * F.lit(p) + F.lit(0.5)) / F.lit(p)).cast("double")
