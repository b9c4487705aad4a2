"""Oracle SQL (DuckDB) per catalogue query."""

from __future__ import annotations

from .data import RUN, cut_literal
from .oracle import EV, labelled_ctes

L = labelled_ctes()

SQL: dict[str, str] = {}

SQL["breach_summary"] = L + """,
st AS (SELECT metric_name, avg(value) AS fit_mean, stddev_pop(value) + 1e-8::DOUBLE AS fit_std
       FROM base GROUP BY metric_name),
sh AS (SELECT s.service, s.metric_name, (s.value - st.fit_mean) / st.fit_std AS z
       FROM strm s LEFT JOIN st USING (metric_name)),
g AS (SELECT service, metric_name, count(*) AS events,
             count(*) FILTER (WHERE coalesce(abs(z) > 3.0, FALSE)) AS breaches,
             max(CASE WHEN abs(z) > 3.0 THEN round(least(abs(z) / 6.0, 1.0), 4) END) AS worst,
             round(max(abs(z)), 4) AS max_abs_z
      FROM sh GROUP BY service, metric_name)
SELECT service, metric_name, events, breaches, round(breaches / events, 4) AS breach_rate, max_abs_z,
       CASE WHEN worst IS NULL THEN 'Normal' WHEN worst >= 0.85 THEN 'Critical' WHEN worst >= 0.65 THEN 'High'
            WHEN worst >= 0.40 THEN 'Medium' ELSE 'Low' END AS worst_severity
FROM g"""

SQL["metric_baseline_stats"] = L + """
SELECT metric_name, count(value) AS n, round(avg(value), 4) AS fit_mean,
       round(stddev_pop(value) + 1e-8::DOUBLE, 4) AS fit_std
FROM base GROUP BY metric_name"""

SQL["percentile_thresholds"] = L + """
SELECT metric_name, round(quantile_cont(value, 0.02), 4) AS p02,
       round(quantile_cont(value, 0.975), 4) AS p975
FROM base GROUP BY metric_name"""

SQL["dataset_summary"] = L + """
SELECT count(*) AS total_events, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       count(*) FILTER (WHERE NOT is_anomaly) AS normal,
       round(avg(CAST(is_anomaly AS INTEGER)), 4) AS anomaly_rate,
       array_to_string(list_sort(list_distinct(list(anomaly_type) FILTER (WHERE anomaly_type IS NOT NULL))), ',') AS anomaly_types,
       count(DISTINCT metric_name) AS metrics, count(DISTINCT service) AS services
FROM lev"""

SQL["baseline_split"] = L + """
SELECT event_id, CASE WHEN ts >= TIMESTAMP '""" + cut_literal(RUN) + """' THEN 'stream'
                      WHEN NOT is_anomaly THEN 'baseline' ELSE 'excluded' END AS part
FROM lev"""

SQL["distinct_metrics"] = L + """
SELECT DISTINCT 'metric' AS kind, metric_name AS name FROM lev
UNION ALL
SELECT DISTINCT 'anomaly_type' AS kind, anomaly_type AS name FROM lev WHERE anomaly_type IS NOT NULL"""

SQL["append_batches"] = L + """
SELECT event_id, metric_name, value, 'baseline' AS part FROM base
UNION ALL
SELECT event_id, metric_name, value, 'stream' AS part FROM strm"""

SQL["metric_slice"] = L + """
SELECT event_id, timestamp, value, is_anomaly FROM strm WHERE metric_name = 'view'
ORDER BY ts, event_id LIMIT 800"""

SQL["event_defaults"] = "WITH " + EV + """,
api AS (
  SELECT CASE WHEN CAST(event_id AS BIGINT) % 97 = 0 THEN NULL ELSE event_id END AS event_id,
         CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN NULL ELSE host END AS host,
         CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN NULL ELSE region END AS region
  FROM ev)
SELECT event_id, coalesce(host, 'unknown') AS host, coalesce(region, 'us-east-1') AS region,
       event_id IS NOT NULL AS accepted
FROM api"""

SQL["derived_event_id"] = "WITH " + EV + """
SELECT event_id, substr(md5(CAST(epoch_us(ts) AS VARCHAR) || '-' || service || '-' || metric_name || '-' || host), 1, 16) AS derived_id
FROM ev"""

SQL["scenario_match"] = L + """
SELECT event_id, sc_name AS scenario, round(progress, 6) AS progress FROM scm"""

for _n in ("pipeline_failure", "memory_leak", "traffic_spike", "error_storm", "network_degradation"):
    SQL[f"inject_{_n}"] = L + f"""
SELECT lev.event_id, lev.value, lev.is_anomaly, lev.anomaly_type
FROM lev JOIN scm ON scm.event_id = lev.event_id WHERE scm.sc_name = '{_n}'"""

SQL["shewhart_flags"] = L + """,
st AS (SELECT metric_name, avg(value) AS fit_mean, stddev_pop(value) + 1e-8::DOUBLE AS fit_std
       FROM base GROUP BY metric_name)
SELECT s.event_id, s.metric_name, round((s.value - st.fit_mean) / st.fit_std, 4) AS z_score,
       round(st.fit_mean + 3.0 * st.fit_std, 4) AS upper_limit,
       round(st.fit_mean - 3.0 * st.fit_std, 4) AS lower_limit,
       coalesce(abs((s.value - st.fit_mean) / st.fit_std) > 3.0, FALSE) AS is_anomaly
FROM strm s LEFT JOIN st USING (metric_name)"""

_REF = """,
rn AS (SELECT *, row_number() OVER (PARTITION BY service, metric_name ORDER BY ts, event_id) AS rn FROM strm),
lim AS (SELECT service, metric_name, avg(value) AS ref_mean, stddev_pop(value) + {eps} AS ref_std
        FROM rn WHERE rn <= 100 GROUP BY service, metric_name),
lim2 AS (SELECT *, ref_mean + 3.0 * ref_std AS ucl, ref_mean - 3.0 * ref_std AS lcl FROM lim)"""

SQL["reference_limits"] = L + _REF.format(eps="0.0::DOUBLE") + """
SELECT service, metric_name, round(ref_mean, 4) AS ref_mean, round(ref_std, 4) AS ref_std,
       round(ucl, 4) AS ucl, round(lcl, 4) AS lcl FROM lim2"""

SQL["limit_violations"] = L + _REF.format(eps="0.0::DOUBLE") + """
SELECT s.event_id, s.service, s.metric_name, s.value,
       CASE WHEN s.value > l.ucl THEN 'above' ELSE 'below' END AS side
FROM strm s JOIN lim2 l USING (service, metric_name)
WHERE s.value > l.ucl OR s.value < l.lcl"""

_CUSUM = """,
z AS (SELECT r.event_id, r.service, r.metric_name, r.rn, r.ts,
             (r.value - l.ref_mean) / l.ref_std AS z
      FROM rn r JOIN lim2 l USING (service, metric_name)),
d AS (SELECT *, z - 0.5 AS dp, -z - 0.5 AS dn FROM z),
s AS (SELECT *, sum(dp) OVER w AS sp, sum(dn) OVER w AS sn FROM d
      WINDOW w AS (PARTITION BY service, metric_name ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, sp - min(sp) OVER w AS cusum_pos, sn - min(sn) OVER w AS cusum_neg FROM s
      WINDOW w AS (PARTITION BY service, metric_name ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

SQL["cusum_scan"] = L + _REF.format(eps="1e-8::DOUBLE") + _CUSUM + """
SELECT event_id, service, metric_name, round(z, 4) AS z, round(cusum_pos, 4) AS cusum_pos,
       round(cusum_neg, 4) AS cusum_neg FROM c"""

SQL["label_zones"] = L + """,
o AS (SELECT *, coalesce(lag(is_anomaly) OVER w, FALSE) AS prev FROM strm
      WINDOW w AS (PARTITION BY service, metric_name ORDER BY ts, event_id)),
i AS (SELECT *, sum(CASE WHEN is_anomaly AND NOT prev THEN 1 ELSE 0 END) OVER
                (PARTITION BY service, metric_name ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM o)
SELECT service, metric_name, arg_min(event_id, ts) AS first_event_id, arg_max(event_id, ts) AS last_event_id,
       count(*) AS n_rows
FROM i WHERE is_anomaly GROUP BY service, metric_name, island"""

SQL["control_chart_series"] = L + """,
head AS (SELECT * FROM strm WHERE metric_name = 'purchase' ORDER BY ts, event_id LIMIT 600),
rn AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS rn FROM head),
lim AS (SELECT avg(value) AS ref_mean, stddev_pop(value) + 1e-8::DOUBLE AS ref_std FROM rn WHERE rn <= 100),
l2 AS (SELECT *, ref_mean + 3.0 * ref_std AS ucl, ref_mean - 3.0 * ref_std AS lcl FROM lim),
z AS (SELECT r.*, l2.ucl, l2.lcl, (r.value - l2.ref_mean) / l2.ref_std AS z FROM rn r, l2),
d AS (SELECT *, z - 0.5 AS dp, -z - 0.5 AS dn FROM z),
s AS (SELECT *, sum(dp) OVER w AS sp, sum(dn) OVER w AS sn FROM d
      WINDOW w AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, sp - min(sp) OVER w AS cusum_pos, sn - min(sn) OVER w AS cusum_neg FROM s
      WINDOW w AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT rn AS idx, event_id, value, is_anomaly, round(ucl, 4) AS ucl, round(lcl, 4) AS lcl,
       round(cusum_pos, 4) AS cusum_pos, round(cusum_neg, 4) AS cusum_neg,
       (value > ucl OR value < lcl) AS violation
FROM c"""

# ------------------------------------------------------------------ features

_IDX = """,
si AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_idx FROM strm),
sb AS (SELECT *, row_idx // 500 AS batch_key FROM si),
bi AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_idx FROM base),
bb AS (SELECT *, row_idx // 500 AS batch_key FROM bi)"""

SQL["micro_batch_index"] = L + _IDX + """
SELECT event_id, row_idx, batch_key FROM sb"""


def _ffeat(src: str, part: str = "PARTITION BY batch_key") -> str:
    return f"""SELECT *, value AS f_value, ln(1 + abs(value)) AS f_log,
       coalesce(value - lag(value) OVER ({part} ORDER BY ts, event_id), 0.0) AS f_diff,
       value / (avg(value) OVER ({part} ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) + 1e-8::DOUBLE) AS f_roll_ratio,
       value * value / 1e6::DOUBLE AS f_sq
FROM {src}"""


SQL["forest_features"] = L + _IDX + f""",
ff AS ({_ffeat('sb')})
SELECT event_id, batch_key, round(f_value, 4) AS f_value, round(f_log, 4) AS f_log, round(f_diff, 4) AS f_diff FROM ff"""

SQL["forest_scaler"] = L + _IDX + f""",
ff AS ({_ffeat('bi', '')})
SELECT """ + ", ".join(
    f"round(avg({c}), 4) AS {c}_mean, round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END, 4) AS {c}_std"
    for c in ("f_value", "f_log", "f_diff")) + " FROM ff"

_MI = """,
mi AS (SELECT metric_name, row_number() OVER (ORDER BY metric_name) - 1 AS m_pos FROM (SELECT DISTINCT metric_name FROM base)),
mn AS (SELECT count(*) AS m_count FROM mi)"""

_AE_COLS = ("f_value", "f_log", "f_sq", "f_diff", "f_roll_ratio", "f_metric")

SQL["autoencoder_features"] = L + _IDX + _MI + f""",
ff AS ({_ffeat('sb')}),
fa AS (SELECT ff.*, coalesce(mi.m_pos, 0) / (SELECT m_count FROM mn)::DOUBLE AS f_metric
       FROM ff LEFT JOIN mi USING (metric_name))
SELECT event_id, """ + ", ".join(f"round({c}, 4) AS {c}" for c in _AE_COLS) + " FROM fa"

SQL["autoencoder_scaler"] = L + _IDX + _MI + f""",
ff AS ({_ffeat('bi', '')}),
fa AS (SELECT ff.*, coalesce(mi.m_pos, 0) / (SELECT m_count FROM mn)::DOUBLE AS f_metric
       FROM ff LEFT JOIN mi USING (metric_name))
SELECT """ + ", ".join(f"round(avg({c}), 4) AS {c}_mean, round(stddev_pop({c}), 4) AS {c}_std"
                      for c in _AE_COLS) + " FROM fa"

SQL["batch_minmax_confidence"] = L + _IDX + """,
w AS (SELECT *, min(value) OVER (PARTITION BY batch_key) AS lo, max(value) OVER (PARTITION BY batch_key) AS hi FROM sb)
SELECT event_id, batch_key, round(CASE WHEN hi > lo THEN 1.0 - (value - lo) / (hi - lo) ELSE 0.0 END, 4) AS confidence FROM w"""


# ------------------------------------------------------------------ adaptive charts (recursive CTE)

def xr(expr: str, k: int = 4) -> str:
    """Correctly rounded ``round(expr, k)`` (DuckDB's own round works on the
    scaled double and differs from Python/Spark on near-ties)."""
    return f"CAST(round(CAST(printf('%.20f', ({expr})::DOUBLE) AS DECIMAL(38,20)), {k}) AS DOUBLE)"


def sr(expr: str, k: int = 4) -> str:
    """Same steps as ``functions.columns.fround``: floor(x * 10^k + 0.5) / 10^k."""
    p = float(10 ** k)
    return f"CAST(floor(({expr})::DOUBLE * {p!r}::DOUBLE + 0.5::DOUBLE) / {p!r}::DOUBLE AS DOUBLE)"


def chart_cte(name="cc", key=("metric_name",), adaptive=True, baseline_where="TRUE", window=500,
              min_window=30, sigma=3.0, k=0.5, h=5.0, src="strm") -> str:
    """CTEs ending in ``{name}``: the adaptive chart fold as a recursive CTE
    (needs ``WITH RECURSIVE``)."""
    kc = ", ".join(key)
    kj = " AND ".join(f"s.{c} IS NOT DISTINCT FROM f.{c}" for c in key)
    adapt = "TRUE" if adaptive else "FALSE"
    p = name + "_"
    return f""",
{p}b2 AS (SELECT * FROM base WHERE {baseline_where}),
{p}fit AS (SELECT {kc}, avg(value) AS fit_mean, stddev_pop(value) + 1e-8::DOUBLE AS fit_std FROM {p}b2 GROUP BY {kc}),
{p}warm AS (SELECT * FROM (SELECT event_id, ts, {kc}, value,
           row_number() OVER (PARTITION BY {kc} ORDER BY ts DESC, event_id DESC) AS rk FROM {p}b2) WHERE rk <= {window}),
{p}seq0 AS (SELECT event_id, ts, {kc}, value, 0 AS phase FROM {p}warm
         UNION ALL SELECT event_id, ts, {kc}, value, 1 AS phase FROM {src}),
{p}seq AS (SELECT q.*, ft.fit_mean, ft.fit_std,
               row_number() OVER (PARTITION BY {", ".join("q." + c for c in key)} ORDER BY phase, ts, event_id) AS rn
        FROM {p}seq0 q LEFT JOIN {p}fit ft USING ({kc})),
{p}fold AS (
  SELECT {kc}, 0::BIGINT AS rn, []::DOUBLE[] AS win, 0.0::DOUBLE AS cp, 0.0::DOUBLE AS cn,
         NULL::VARCHAR AS event_id, 0 AS phase, NULL::DOUBLE AS z, NULL::DOUBLE AS mean, NULL::DOUBLE AS sd,
         NULL::DOUBLE AS cp_out, NULL::DOUBLE AS cn_out, NULL::VARCHAR AS rule, NULL::DOUBLE AS conf
  FROM (SELECT DISTINCT {kc} FROM {p}seq)
  UNION ALL
  SELECT {", ".join("s." + c for c in key)}, s.rn,
         CASE WHEN s.phase = 0 OR x.rule = '' OR NOT {adapt}
              THEN (CASE WHEN len(list_append(f.win, s.value)) > {window}
                         THEN list_append(f.win, s.value)[len(list_append(f.win, s.value)) - {window - 1}:]
                         ELSE list_append(f.win, s.value) END)
              ELSE f.win END,
         CASE WHEN s.phase = 0 THEN f.cp WHEN x.rule IN ('cusum_up', 'cusum_down') THEN 0.0 ELSE x.cp1 END,
         CASE WHEN s.phase = 0 THEN f.cn WHEN x.rule IN ('cusum_up', 'cusum_down') THEN 0.0 ELSE x.cn1 END,
         s.event_id, s.phase, x.z, x.mean, x.sd,
         CASE WHEN x.rule IN ('cusum_up', 'cusum_down') THEN 0.0 ELSE x.cp1 END,
         CASE WHEN x.rule IN ('cusum_up', 'cusum_down') THEN 0.0 ELSE x.cn1 END,
         x.rule,
         {xr(f"greatest(least(abs(x.z) / {2 * sigma}, 1.0), least(greatest(x.cp1, x.cn1) / {2 * h}, 1.0))")}
  FROM {p}fold f JOIN {p}seq s ON s.rn = f.rn + 1 AND {kj},
  LATERAL (
    SELECT mean, sd, z, cp1, cn1,
           CASE WHEN abs(z) > {sigma} THEN '3sigma' WHEN cp1 > {h} THEN 'cusum_up'
                WHEN cn1 > {h} THEN 'cusum_down' ELSE '' END AS rule
    FROM (SELECT mean, sd, (s.value - mean) / sd AS z,
                 greatest(0.0, f.cp + ((s.value - mean) / sd - {k})) AS cp1,
                 greatest(0.0, f.cn + (-((s.value - mean) / sd) - {k})) AS cn1
          FROM (SELECT
            CASE WHEN {adapt} AND len(f.win) >= {min_window} THEN list_aggregate(f.win, 'fsum') / len(f.win)
                 WHEN s.fit_mean IS NOT NULL THEN s.fit_mean
                 WHEN len(f.win) > 0 THEN list_aggregate(f.win, 'fsum') / len(f.win) ELSE 0.0 END AS mean,
            CASE WHEN {adapt} AND len(f.win) >= {min_window} THEN list_stddev_pop(f.win) + 1e-8::DOUBLE
                 WHEN s.fit_mean IS NOT NULL THEN s.fit_std
                 WHEN len(f.win) > 0 THEN list_stddev_pop(f.win) + 1e-8::DOUBLE ELSE 1.0 END AS sd))
  ) x
),
{name} AS (
SELECT event_id, {kc}, {xr('z')} AS z_score, {xr('cp_out')} AS cusum_pos, {xr('cn_out')} AS cusum_neg,
       {xr('round(mean, 8)')} AS control_mean, {xr('sd')} AS control_std,
       {xr(f'mean + {sigma} * sd')} AS upper_limit, {xr(f'mean - {sigma} * sd')} AS lower_limit,
       rule <> '' AS cc_is_anomaly, rule AS rule_triggered, conf AS cc_confidence
FROM {p}fold WHERE phase = 1)"""


LR = L.replace("WITH ", "WITH RECURSIVE ", 1)


def chart_rcte(**kw) -> str:
    return LR + chart_cte("cc", **kw) + "\nSELECT * FROM cc"


SQL["adaptive_control_chart"] = chart_rcte()
SQL["fixed_control_chart"] = chart_rcte(adaptive=False)
SQL["series_control_chart"] = chart_rcte(key=("service", "metric_name"))
SQL["unseen_series"] = chart_rcte(key=("service", "metric_name"), baseline_where="service <> 'svc-4'")


# ------------------------------------------------------------------ fusion, alerts, evaluation

TRIO = LR + """,
st AS (SELECT metric_name, avg(value) AS fit_mean, stddev_pop(value) + 1e-8::DOUBLE AS fit_std
       FROM base GROUP BY metric_name),
s0 AS (SELECT event_id, ts, t_s, service, metric_name, value, is_anomaly AS label, anomaly_type AS label_type FROM strm),
shz AS (SELECT s0.*, (s0.value - st.fit_mean) / st.fit_std AS z FROM s0 LEFT JOIN st USING (metric_name)),
sh AS (SELECT event_id, ts, t_s, service, metric_name, value, label, label_type,
              coalesce(abs(z) > 3.0, FALSE) AS sh_vote, """ + sr("least(abs(z) / 6.0, 1.0)") + """ AS sh_conf FROM shz)""" + \
    _REF.format(eps="1e-8::DOUBLE") + _CUSUM + """,
cu AS (SELECT event_id, (cusum_pos > 5.0 OR cusum_neg > 5.0) AS cu_vote,
              """ + sr("least(greatest(cusum_pos, cusum_neg) / 10.0, 1.0)") + """ AS cu_conf FROM c)""" + \
    chart_cte("cc") + """,
tri AS (SELECT sh.*, cu.cu_vote, cu.cu_conf, cc.cc_is_anomaly, cc.cc_confidence
        FROM sh JOIN cu USING (event_id) JOIN cc USING (event_id)),
tw AS (SELECT tri.*,
         coalesce(sh_conf, 0.0) * 0.35 + coalesce(cu_conf, 0.0) * 0.35 + coalesce(cc_confidence, 0.0) * 0.30 AS wconf,
         CAST(coalesce(sh_vote, FALSE) AS INTEGER) + CAST(coalesce(cu_vote, FALSE) AS INTEGER)
           + CAST(coalesce(cc_is_anomaly, FALSE) AS INTEGER) AS n_votes
       FROM tri)"""


def _sev(c: str, flag: str) -> str:
    return (f"CASE WHEN NOT {flag} THEN 'Normal' WHEN {c} >= 0.85 THEN 'Critical' WHEN {c} >= 0.65 THEN 'High' "
            f"WHEN {c} >= 0.40 THEN 'Medium' ELSE 'Low' END")


def fused_cte(strategy: str) -> str:
    confs = "coalesce(sh_conf, 0.0), coalesce(cu_conf, 0.0), coalesce(cc_confidence, 0.0)"
    flag, conf = {
        "majority_vote": ("n_votes >= 2", "CASE WHEN n_votes >= 2 THEN wconf ELSE wconf * 0.5 END"),
        "any": ("n_votes >= 1", f"greatest({confs})"),
        "all": ("n_votes = 3", f"least({confs})"),
        "weighted": ("wconf > 0.5", "wconf"),
    }[strategy]
    return f""",
fz0 AS (SELECT tw.*, {flag} AS is_anomaly, {sr(conf)} AS ensemble_confidence FROM tw),
fz AS (SELECT fz0.*, {_sev('ensemble_confidence', 'is_anomaly')} AS severity FROM fz0)"""


for _s in ("majority_vote", "any", "all", "weighted"):
    SQL[f"fuse_{_s}"] = TRIO + fused_cte(_s) + """
SELECT event_id, is_anomaly, ensemble_confidence, severity, n_votes FROM fz"""

FZ = TRIO + fused_cte("majority_vote")

COOL = """,
an AS (SELECT event_id, service, metric_name, t_s,
              row_number() OVER (PARTITION BY service, metric_name ORDER BY ts, event_id) AS rn
       FROM fz WHERE is_anomaly),
cd AS (
  SELECT service, metric_name, 0::BIGINT AS rn, NULL::DOUBLE AS last, NULL::VARCHAR AS event_id, FALSE AS fired
  FROM (SELECT DISTINCT service, metric_name FROM an)
  UNION ALL
  SELECT a.service, a.metric_name, a.rn,
         CASE WHEN c.last IS NULL OR NOT (a.t_s - c.last < 86400.0) THEN a.t_s ELSE c.last END,
         a.event_id, c.last IS NULL OR NOT (a.t_s - c.last < 86400.0)
  FROM cd c JOIN an a ON a.service = c.service AND a.metric_name = c.metric_name AND a.rn = c.rn + 1),
fired AS (SELECT fz.* FROM fz JOIN (SELECT event_id FROM cd WHERE fired) USING (event_id)),
voted AS (SELECT event_id, '[' || array_to_string(list_filter([CASE WHEN sh_vote THEN '''Shewhart''' END,
              CASE WHEN cu_vote THEN '''Cusum''' END, CASE WHEN cc_is_anomaly THEN '''ControlCharts''' END],
              lambda x: x IS NOT NULL), ', ') || ']' AS dets FROM fired),
al AS (
  SELECT 'ALT-' || substr(f.event_id, 1, 8) AS alert_id, strftime(f.ts, '%Y-%m-%dT%H:%M:%SZ') AS triggered_at,
         f.severity, f.service, f.metric_name, f.value, f.ensemble_confidence AS confidence,
         CASE WHEN f.severity IN ('Critical', 'High') THEN 'pagerduty' WHEN f.severity IN ('Medium') THEN 'slack' ELSE 'log' END AS channel,
         '[' || upper(f.severity) || '] Anomaly detected on ' || f.service || ' | metric=' || f.metric_name
           || ' | value=' || printf('%.4f', f.value) || ' | confidence=' || printf('%.2f', f.ensemble_confidence * 100.0) || '%'
           || ' | detectors=' || v.dets AS message,
         f.event_id, FALSE AS acknowledged, f.ts
  FROM fired f JOIN voted v USING (event_id))"""

ALERTS = FZ + COOL

SQL["alert_cooldown"] = ALERTS + """
SELECT event_id, service, metric_name FROM fired"""

SQL["alert_pipeline"] = ALERTS + """
SELECT event_id, service, metric_name, value, is_anomaly, ensemble_confidence, severity,
       strftime(ts, '%Y-%m-%d') AS date,
       CASE WHEN severity IN ('Critical', 'High') THEN 'pagerduty' WHEN severity IN ('Medium') THEN 'slack' ELSE 'log' END AS channel
FROM fired"""

SQL["alert_rows"] = ALERTS + """
SELECT alert_id, triggered_at, severity, service, metric_name, value, confidence, channel, message, event_id, acknowledged FROM al"""

SQL["pagerduty_payload"] = ALERTS + """
SELECT 'SIMULATED_PD_ROUTING_KEY' AS routing_key, 'trigger' AS event_action, alert_id AS dedup_key, message AS summary,
       lower(severity) AS severity, service AS source, triggered_at AS timestamp, metric_name AS metric, value, confidence
FROM al WHERE channel = 'pagerduty'"""

SQL["slack_payload"] = ALERTS + """,
mk AS (SELECT al.*, CASE severity WHEN 'Critical' THEN chr(128308) WHEN 'High' THEN chr(128992) WHEN 'Medium' THEN chr(128993) ELSE chr(9898) END AS m FROM al)
SELECT alert_id, m || ' *Anomaly Alert — ' || severity || '*' AS text,
       m || ' *' || severity || ' Anomaly* on `' || service || '`' || chr(10) || '*Metric:* `' || metric_name || '` | *Value:* `'
         || printf('%.4f', value) || '`' || chr(10) || '*Confidence:* `' || printf('%.2f', confidence * 100.0) || '%`' || chr(10)
         || '*Time:* `' || triggered_at || '`' AS block1,
       '*Message:* ' || message AS block2
FROM mk WHERE channel = 'slack'"""

SQL["alert_summary"] = ALERTS + """
SELECT 'total' AS dimension, 'all' AS key, count(*) AS alerts FROM al
UNION ALL SELECT 'severity', severity, count(*) FROM al GROUP BY severity
UNION ALL SELECT 'channel', channel, count(*) FROM al GROUP BY channel
UNION ALL SELECT 'service', service, count(*) FROM al GROUP BY service"""

SQL["recent_alerts"] = ALERTS + """
SELECT alert_id, triggered_at, severity, channel, event_id FROM al ORDER BY ts DESC, event_id DESC LIMIT 20"""

SQL["severity_share"] = ALERTS + """,
g AS (SELECT severity, count(*) AS alerts FROM al GROUP BY severity)
SELECT severity, alerts, """ + sr("alerts * 100.0 / sum(alerts) OVER ()", 2) + """ AS share_pct FROM g"""

LONG = FZ + """,
lng AS (
  SELECT event_id, ts, t_s, label, label_type, 'Shewhart' AS method, coalesce(sh_vote, FALSE) AS pred, sh_conf AS conf FROM fz
  UNION ALL SELECT event_id, ts, t_s, label, label_type, 'Cusum', coalesce(cu_vote, FALSE), cu_conf FROM fz
  UNION ALL SELECT event_id, ts, t_s, label, label_type, 'ControlCharts', coalesce(cc_is_anomaly, FALSE), cc_confidence FROM fz
  UNION ALL SELECT event_id, ts, t_s, label, label_type, 'Ensemble', coalesce(is_anomaly, FALSE), ensemble_confidence FROM fz),
cm AS (
  SELECT method, count(*) AS total_events,
         count(*) FILTER (WHERE pred AND label) AS true_positives,
         count(*) FILTER (WHERE pred AND NOT label) AS false_positives,
         count(*) FILTER (WHERE NOT pred AND NOT label) AS true_negatives,
         count(*) FILTER (WHERE NOT pred AND label) AS false_negatives,
         avg(CASE WHEN label THEN conf END) AS ca, avg(CASE WHEN NOT label THEN conf END) AS cn
  FROM lng GROUP BY method),
cr AS (
  SELECT cm.*,
    CASE WHEN true_positives + false_positives > 0 THEN true_positives / (true_positives + false_positives) ELSE 0.0 END AS p,
    CASE WHEN true_positives + false_negatives > 0 THEN true_positives / (true_positives + false_negatives) ELSE 0.0 END AS r
  FROM cm),
rep AS (
  SELECT method, total_events, true_positives, false_positives, true_negatives, false_negatives,
         """ + sr("p") + """ AS precision, """ + sr("r") + """ AS recall,
         """ + sr("CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END") + """ AS f1,
         """ + sr("CASE WHEN total_events > 0 THEN (true_positives + true_negatives) / total_events ELSE 0.0 END") + """ AS accuracy,
         """ + sr("CASE WHEN false_positives + true_negatives > 0 THEN false_positives / (false_positives + true_negatives) ELSE 0.0 END") + """ AS false_positive_rate,
         """ + sr("coalesce(ca, 0.0)") + """ AS avg_confidence_anomaly, """ + sr("coalesce(cn, 0.0)") + """ AS avg_confidence_normal
  FROM cr),
lag AS (
  SELECT method, label_type AS scenario,
         """ + sr("min(CASE WHEN pred THEN t_s END) - min(t_s)", 2) + """ AS lag_sec
  FROM lng WHERE label_type IS NOT NULL GROUP BY method, label_type)"""

SQL["confusion"] = LONG + """
SELECT method, total_events, true_positives, false_positives, true_negatives, false_negatives FROM rep"""

SQL["quality_metrics"] = LONG + """
SELECT method, precision, recall, f1, accuracy, false_positive_rate FROM rep"""

SQL["confidence_by_label"] = LONG + """
SELECT method, avg_confidence_anomaly, avg_confidence_normal FROM rep"""

SQL["detector_report"] = LONG + """
SELECT * FROM rep"""

SQL["per_type_recall"] = LONG + """,
pt AS (SELECT method, label_type AS anomaly_type, count(*) AS count,
              count(*) FILTER (WHERE pred AND label) AS detected,
              count(*) FILTER (WHERE NOT pred AND label) AS fn
       FROM lng WHERE label_type IS NOT NULL GROUP BY method, label_type)
SELECT method, anomaly_type, count, detected,
       """ + sr("CASE WHEN detected + fn > 0 THEN detected / (detected + fn) ELSE 0.0 END") + """ AS recall FROM pt"""

SQL["detection_lag"] = LONG + """
SELECT method, scenario, lag_sec FROM lag"""

SQL["lag_sla"] = LONG + """
SELECT method, scenario, lag_sec,
       CASE WHEN lag_sec IS NULL THEN 'not_detected' WHEN lag_sec > 5 THEN 'slow' WHEN lag_sec > 2 THEN 'medium' ELSE 'fast' END AS band,
       lag_sec <= 4.0 AS within_sla
FROM lag"""

SQL["kpi_row"] = LONG + COOL.replace("fired AS (", "fired0 AS (").split(",\nvoted AS")[0].replace(",\nan AS", ",\nan AS", 1) + """
SELECT (SELECT count(*) FROM fz) AS events, (SELECT count(*) FILTER (WHERE is_anomaly) FROM fz) AS anomalies_detected,
       r.precision, r.recall, r.f1,
       (SELECT count(*) FROM fired0) AS alerts_fired,
       (SELECT """ + sr("coalesce(avg(lag_sec), 0.0)", 2) + """ FROM lag WHERE method = 'Ensemble') AS avg_lag_sec
FROM rep r WHERE r.method = 'Ensemble'"""

SQL["confidence_histogram"] = FZ + """,
hb AS (SELECT is_anomaly AS flagged, CAST(least(floor(ensemble_confidence * 29), 28) AS INTEGER) AS bin
       FROM fz WHERE ensemble_confidence BETWEEN 0.0 AND 1.0),
hg AS (SELECT flagged, bin, count(*) AS n FROM hb GROUP BY flagged, bin)
SELECT flagged, bin, n, """ + sr("n / (sum(n) OVER (PARTITION BY flagged) * (1.0 / 29))") + """ AS density FROM hg"""

SQL["timeline_rows"] = FZ + """,
hd AS (SELECT * FROM fz WHERE metric_name = 'view' ORDER BY ts, event_id LIMIT 800)
SELECT row_number() OVER (ORDER BY ts, event_id) AS idx, event_id, value, label, is_anomaly, ensemble_confidence FROM hd"""

SQL["bucket_kpi"] = FZ + """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, service, count(*) AS events,
       count(*) FILTER (WHERE is_anomaly) AS flagged, count(*) FILTER (WHERE label) AS labelled
FROM fz GROUP BY 1, 2"""


SQL["prediction_alignment"] = FZ + """,
pr AS (SELECT event_id, is_anomaly AS pred FROM fz),
tr AS (SELECT event_id, is_anomaly AS truth FROM strm),
j AS (SELECT pr.pred, tr.truth FROM pr FULL OUTER JOIN tr ON pr.event_id = tr.event_id)
SELECT count(*) FILTER (WHERE pred IS NOT NULL AND truth IS NOT NULL) AS matched,
       count(*) FILTER (WHERE truth IS NULL) AS predictions_without_label,
       count(*) FILTER (WHERE pred IS NULL) AS labels_without_prediction,
       count(*) FILTER (WHERE pred AND truth) AS true_positives
FROM j"""

SQL["service_counters"] = ALERTS + """
SELECT fz.service, count(*) AS requests, count(*) FILTER (WHERE fz.is_anomaly) AS anomalies_detected,
       count(fired.event_id) AS alerts_fired
FROM fz LEFT JOIN (SELECT event_id FROM fired) fired USING (event_id)
GROUP BY fz.service"""

SQL["lag_summary"] = LONG + """
SELECT method, """ + sr("coalesce(avg(lag_sec), 0.0)", 2) + """ AS avg_lag_sec, count(lag_sec) AS detected_scenarios,
       """ + sr("coalesce(avg(lag_sec), 0.0)", 2) + """ <= 4.0 AS within_sla
FROM lag GROUP BY method"""


# ------------------------------------------------------------------ node table

def _u(key: str, salt: str) -> str:
    return f"(CAST(('0x' || substr(md5({key} || '{salt}'), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE)"


def forest_table_sql(trees: int, sample: int, depth: int, share: float) -> str:
    """Grow and walk the node table, one pair of CTEs a level."""
    out = [L + _IDX + f""",
bf AS ({_ffeat('bi', '')}), sf AS ({_ffeat('sb')}),
pool AS (SELECT event_id, f_value AS x0, f_log AS x1, f_diff AS x2 FROM bf
         WHERE {_u('event_id', ':pool')} < least(1.0::DOUBLE, 1.2::DOUBLE * {trees * sample} / (SELECT count(*) FROM bf))),
dr AS (SELECT pool.*, t.tree, row_number() OVER (PARTITION BY t.tree ORDER BY {_u("event_id || ':' || t.tree", ':draw')}, event_id) AS r
       FROM pool, (SELECT unnest(range({trees})) AS tree) t),
l0 AS (SELECT tree, event_id, x0, x1, x2, 1::BIGINT AS node FROM dr WHERE r <= {sample})"""]
    key = "tree || ':' || node"
    for d in range(depth + 1):
        lohi = ", ".join(f"min(x{i}) OVER w AS lo{i}, max(x{i}) OVER w AS hi{i}" for i in range(3))
        out.append(f""",
a{d} AS (SELECT *, count(*) OVER w AS size, {lohi} FROM l{d} WINDOW w AS (PARTITION BY tree, node)),
b{d} AS (SELECT *, (hi0 > lo0)::INT AS g0, (hi1 > lo1)::INT AS g1, (hi2 > lo2)::INT AS g2 FROM a{d}),
c{d} AS (SELECT *, floor({_u(key, ':feature')} * (g0 + g1 + g2))::INT AS k FROM b{d}),
f{d} AS (SELECT *, CASE WHEN NOT (size > 1 AND g0 + g1 + g2 > 0 AND {str(d < depth).upper()}) THEN -1
                        WHEN g0 = 1 AND k = 0 THEN 0 WHEN g1 = 1 AND k = g0 THEN 1 ELSE 2 END AS feature FROM c{d}),
p{d} AS (SELECT *, CASE feature WHEN 0 THEN lo0 + {_u(key, ':split')} * (hi0 - lo0) WHEN 1 THEN lo1 + {_u(key, ':split')} * (hi1 - lo1)
                        WHEN 2 THEN lo2 + {_u(key, ':split')} * (hi2 - lo2) ELSE 0.0::DOUBLE END AS split,
                CASE feature WHEN 0 THEN x0 WHEN 1 THEN x1 WHEN 2 THEN x2 END AS own FROM f{d}),
n{d} AS (SELECT DISTINCT tree, node, feature, split, size FROM p{d}),
l{d + 1} AS (SELECT tree, event_id, x0, x1, x2, 2 * node + (own >= split)::INT AS node FROM p{d} WHERE feature >= 0)""")
    out.append(f""",
ev0 AS (SELECT 'b' AS part, event_id, f_value AS x0, f_log AS x1, f_diff AS x2 FROM bf
        UNION ALL SELECT 's', event_id, f_value, f_log, f_diff FROM sf),
w0 AS (SELECT ev0.*, t.tree, 1::BIGINT AS node FROM ev0, (SELECT unnest(range({trees})) AS tree) t)""")
    for d in range(depth + 1):
        out.append(f""",
j{d} AS (SELECT w{d}.*, n.feature, n.split, n.size FROM w{d} LEFT JOIN n{d} n USING (tree, node)),
w{d + 1} AS (SELECT part, event_id, x0, x1, x2, tree,
                    2 * node + ((CASE feature WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) >= split)::INT AS node
             FROM j{d} WHERE feature >= 0)""")
    c = "(CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329::DOUBLE) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)"
    leaf = c.format(n="coalesce(size, 0)::DOUBLE")
    ends = " UNION ALL ".join(
        f"SELECT part, event_id, {10_000 * d} + floor({leaf} * 10000 + 0.5)::BIGINT AS path FROM j{d} WHERE coalesce(feature, -1) < 0"
        for d in range(depth + 1))
    size = f"least({sample}, (SELECT count(*) FROM bf))::DOUBLE"
    out.append(f""",
ends AS ({ends}),
sums AS (SELECT part, event_id, sum(path)::BIGINT AS path_sum FROM ends GROUP BY 1, 2),
lim AS (SELECT quantile_cont(path_sum::DOUBLE, {share}) AS cut FROM sums WHERE part = 'b')
SELECT event_id, path_sum, round(-pow(2.0::DOUBLE, -(path_sum / {10_000 * trees}.0::DOUBLE) / {c.format(n=size)}), 6) AS score,
       path_sum < (SELECT cut FROM lim) AS flagged
FROM sums WHERE part = 's'""")
    return "".join(out)


SQL["forest_table_scores"] = forest_table_sql(100, 128, 7, 0.02)

SQL["quantile_sketch"] = L + """
SELECT metric_name, count(value) AS n, TRUE AS p02_within, TRUE AS p975_within FROM base GROUP BY metric_name"""

SQL["fuse_joined"] = SQL["fuse_majority_vote"]

SQL["alert_audit_summary"] = SQL["alert_summary"] + """
UNION ALL SELECT 'audit', 'records', count(*) FROM fired
UNION ALL SELECT 'audit', 'partitions', count(DISTINCT strftime(ts, '%Y-%m-%d') || '/' || service) FROM fired"""

SQL["timeline_slice"] = L + """,
hd AS (SELECT * FROM strm WHERE metric_name = 'view' ORDER BY ts, event_id LIMIT 800),
rn AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY ts, event_id) AS rn,
              sum(CASE WHEN is_anomaly THEN 0 ELSE 1 END) OVER (PARTITION BY service ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM hd),
lim AS (SELECT service, avg(value) AS m, stddev_pop(value) + 1e-8::DOUBLE AS sd FROM rn WHERE rn <= 100 GROUP BY service)
SELECT event_id, rn.service, value, is_anomaly, round(m + 3.0 * sd, 4) AS ucl, round(m - 3.0 * sd, 4) AS lcl,
       CASE WHEN value > m + 3.0 * sd THEN 'above' WHEN value < m - 3.0 * sd THEN 'below' ELSE '' END AS side,
       CASE WHEN is_anomaly THEN island::BIGINT END AS zone
FROM rn JOIN lim ON lim.service = rn.service"""
