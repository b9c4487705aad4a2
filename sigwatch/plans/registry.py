"""Names of the catalogue queries and their oracles."""

from __future__ import annotations

from . import catalog as C
from .sql import SQL

QUERIES = {
    "breach_summary": C.breach_summary,
    "metric_baseline_stats": C.metric_baseline_stats,
    "percentile_thresholds": C.percentile_thresholds,
    "dataset_summary": C.dataset_summary,
    "baseline_split": C.baseline_split,
    "distinct_metrics": C.distinct_metrics,
    "append_batches": C.append_batches,
    "metric_slice": C.metric_slice,
    "event_defaults": C.event_defaults,
    "derived_event_id": C.derived_event_id_q,
    "scenario_match": C.scenario_match,
    **{f"inject_{n}": C.inject_scenario(n) for n in C.SCENARIO_NAMES},
    "shewhart_flags": C.shewhart_flags,
    "reference_limits": C.reference_limits_q,
    "limit_violations": C.limit_violations_q,
    "cusum_scan": C.cusum_scan_q,
    "label_zones": C.label_zones_q,
    "control_chart_series": C.control_chart_series,
    "micro_batch_index": C.micro_batch_index,
    "forest_features": C.forest_features_q,
    "forest_scaler": C.forest_scaler_q,
    "autoencoder_features": C.autoencoder_features_q,
    "autoencoder_scaler": C.autoencoder_scaler_q,
    "batch_minmax_confidence": C.batch_minmax_confidence_q,
    "adaptive_control_chart": C.adaptive_control_chart,
    "fixed_control_chart": C.fixed_control_chart,
    "series_control_chart": C.series_control_chart,
    "unseen_series": C.unseen_series,
    **{f"fuse_{s}": C._fuse_q(s) for s in ("majority_vote", "any", "all", "weighted")},
    "alert_cooldown": C.alert_cooldown,
    "alert_pipeline": C.alert_pipeline,
    "alert_rows": C.alert_rows_q,
    "pagerduty_payload": C.pagerduty_payload,
    "slack_payload": C.slack_payload,
    "alert_summary": C.alert_summary_q,
    "recent_alerts": C.recent_alerts_q,
    "severity_share": C.severity_share_q,
    "confusion": C.confusion_q,
    "quality_metrics": C.quality_metrics,
    "confidence_by_label": C.confidence_by_label,
    "per_type_recall": C.per_type_recall,
    "detector_report": C.detector_report,
    "detection_lag": C.detection_lag_q,
    "lag_sla": C.lag_sla_q,
    "kpi_row": C.kpi_row,
    "confidence_histogram": C.confidence_histogram_q,
    "timeline_rows": C.timeline_rows,
    "bucket_kpi": C.bucket_kpi,
    "forest_scores": C.forest_scores,
    "autoencoder_scores": C.autoencoder_scores,
    "autoencoder_loss": C.autoencoder_loss,
    "ensemble_scores": C.ensemble_scores,
    "single_event": C.single_event,
    "ensemble_report": C.ensemble_report,
    "prediction_alignment": C.prediction_alignment,
    "service_counters": C.service_counters,
    "lag_summary": C.lag_summary,
    "forest_table_scores": C.forest_table_scores,
    "quantile_sketch": C.quantile_sketch,
    "fuse_joined": C.fuse_joined,
    "alert_audit_summary": C.alert_audit_summary,
    "timeline_slice": C.timeline_slice,
}

ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}
