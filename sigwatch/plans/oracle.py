"""DuckDB oracle SQL for the query catalogue (same tables, same semantics).

Every query starts from the same adapter and fault overlay as the Spark side
(``sources.events.adapt_events`` and ``operators.inject``)."""

from __future__ import annotations

from ..operators.inject import LEAK_LABEL_MARGIN, scenario_plan
from .data import RUN, cut_literal


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({float(v)!r} AS DOUBLE)" if isinstance(v, float) else str(v)


def scenario_values() -> str:
    rows = []
    for s in scenario_plan(RUN.origin):
        rows.append("(" + ", ".join(_lit(x) for x in (s.priority, s.name, s.start_s, s.end_s,
                                                       s.metric_name, s.service, s.base_mean)) + ")")
    return ("sc(priority, name, start_s, end_s, metric_name, service, base_mean) AS (VALUES "
            + ", ".join(rows) + ")")


def _u(salt: str, key: str = "event_id") -> str:
    return (f"(CAST(('0x' || substr(md5({key} || '{salt}'), 1, 8)) AS BIGINT)::DOUBLE "
            f"/ CAST(4294967296.0 AS DOUBLE))")


def _z(salt: str, key: str = "event_id") -> str:
    u1 = (f"((CAST(('0x' || substr(md5({key} || '{salt}a'), 1, 8)) AS BIGINT)::DOUBLE + 0.5::DOUBLE)"
          f" / CAST(4294967296.0 AS DOUBLE))")
    u2 = _u(salt + "b", key)
    return f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos((2.0::DOUBLE * pi()) * {u2}))"


EV = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts,
         'svc-' || CAST(user_id % 5 AS VARCHAR) AS service,
         event_type AS metric_name, CAST(value AS DOUBLE) AS value, 'u' AS unit,
         'host-' || CAST(user_id % 10 AS VARCHAR) AS host,
         'r' || CAST(user_id % 3 AS VARCHAR) AS region,
         CAST(epoch_us(ts) AS DOUBLE) / 1000000.0::DOUBLE AS t_s
  FROM events)"""


def labelled_ctes() -> str:
    """CTEs ``ev``, ``sc``, ``scm`` (matched), ``lev`` (labelled events),
    ``base`` (baseline) and ``strm`` (stream)."""
    m = LEAK_LABEL_MARGIN
    cut = cut_literal(RUN)
    return f"""WITH {EV},
{scenario_values()},
scm0 AS (
  SELECT ev.event_id, sc.name AS sc_name, sc.base_mean,
         CASE WHEN sc.end_s > sc.start_s THEN (ev.t_s - sc.start_s) / (sc.end_s - sc.start_s)
              ELSE 0.0::DOUBLE END AS progress,
         row_number() OVER (PARTITION BY ev.event_id ORDER BY sc.priority) AS rk
  FROM ev JOIN sc ON sc.metric_name = ev.metric_name AND sc.start_s <= ev.t_s
       AND ev.t_s <= sc.end_s AND (sc.service IS NULL OR sc.service = ev.service)),
scm AS (SELECT event_id, sc_name, base_mean, progress FROM scm0 WHERE rk = 1),
nv AS (
  SELECT ev.*, scm.sc_name, scm.base_mean,
    CASE scm.sc_name
      WHEN 'pipeline_failure' THEN round(scm.base_mean * (10 + 10 * scm.progress) + 20 * {_z('-n', 'ev.event_id')}, 2)
      WHEN 'memory_leak' THEN round(scm.base_mean + 40 * scm.progress + {_z('-n', 'ev.event_id')}, 2)
      WHEN 'traffic_spike' THEN round(scm.base_mean * (5 + 3 * {_u('-u', 'ev.event_id')}), 1)
      WHEN 'error_storm' THEN round(0.30::DOUBLE + 0.30::DOUBLE * {_u('-u', 'ev.event_id')}, 4)
      WHEN 'network_degradation' THEN round(scm.base_mean * (0.02::DOUBLE + 0.06::DOUBLE * {_u('-u', 'ev.event_id')}), 1)
      ELSE ev.value END AS new_value
  FROM ev LEFT JOIN scm ON scm.event_id = ev.event_id),
lab AS (
  SELECT nv.*, CASE WHEN sc_name = 'memory_leak' THEN new_value > base_mean + {m!r}::DOUBLE
                    WHEN sc_name IN ('pipeline_failure','traffic_spike','error_storm','network_degradation') THEN TRUE
                    ELSE FALSE END AS lab
  FROM nv),
lev AS (
  SELECT event_id, ts, service, metric_name, new_value AS value, unit, host, region,
         lab AS is_anomaly, CASE WHEN lab THEN sc_name END AS anomaly_type,
         t_s, CAST(epoch_us(ts) AS DOUBLE) / 1000.0::DOUBLE AS timestamp
  FROM lab),
base AS (SELECT * FROM lev WHERE ts < TIMESTAMP '{cut}' AND NOT is_anomaly),
strm AS (SELECT * FROM lev WHERE ts >= TIMESTAMP '{cut}')"""
