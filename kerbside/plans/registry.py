"""All registered queries by name: callables of (spark, sf_dir)."""

from kerbside.plans import batch, models, streams

QUERIES = {
    "bronze_ingest": streams.bronze_ingest,
    "silver_from_bronze": streams.silver_from_bronze,
    "silver_traffic": streams.silver_query("traffic"),
    "silver_pollution": streams.silver_query("pollution"),
    "silver_replayed": streams.silver_replayed,
    "parse_rejects": batch.parse_rejects,
    "parse_faults": batch.parse_faults,
    "reject_stream": streams.reject_stream,
    "unified_events": batch.unified_events,
    "kpi_1m": batch.kpi_query("1 minute"),
    "kpi_1h": batch.kpi_query("1 hour"),
    "kpi_stream_1m": streams.kpi_stream_query("1 minute"),
    "kpi_stream_1h": streams.kpi_stream_query("1 hour"),
    "kpi_stream_two_watermarks": streams.kpi_stream_two_watermarks,
    "kpi_stream_idle": streams.kpi_stream_idle,
    "kpi_stream_late": streams.kpi_stream_late,
    "kpi_stream_carried": streams.kpi_stream_carried,
    "alert_summary": batch.alert_summary,
    "training_pairs": batch.training_pairs,
    "model_coefficients": models.model_coefficients,
    "model_incremental": models.model_incremental,
    "model_window_coefficients": models.model_window_coefficients,
    "kpi_predicted": models.kpi_predicted,
    "kpi_predicted_high": models.kpi_predicted_high,
    "serving_latest": models.serving_latest,
    "district_series": models.district_series,
    "gold_serving": models.gold_serving,
    "gold_two_runs": models.gold_two_runs,
    "gold_new_checkpoint": models.gold_new_checkpoint,
    "serving_folded": models.serving_folded,
    "gold_retrained": models.gold_retrained,
    "gold_reloaded": models.gold_reloaded,
    "gold_crashed": models.gold_crashed,
    "late_corrected": models.late_corrected,
    "gaps_served": models.gaps_served,
    "history_sql": streams.history_sql,
    "history_packed": streams.history_packed,
}
