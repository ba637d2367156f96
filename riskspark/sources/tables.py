"""Keyed-table scans (S6-S10): projections and time bounds Catalyst pushes into Parquet."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column lists read by the detection job (the rest of each table is pruned).
SYSTEM_SCAN_COLS = ["_id", "timestamp", "sourceip", "port_service", "logtype",
                    "http_status_code", "is_security_event", "headers_http_request_method",
                    "sap_app_env", "macro_region", "_score", "event_description"]
LLM_SCAN_COLS = ["_id", "timestamp", "logtype", "llm_model_id", "llm_cost_usd",
                 "llm_response_time_ms", "llm_total_tokens", "llm_status", "llm_finish_reason",
                 "sap_llm_response_size", "sap_app_env", "macro_region", "_score"]


def _ts_lit(ts) -> F.Column:
    return F.lit(ts).cast("timestamp_ntz") if isinstance(ts, str) else ts


def _prune(table: DataFrame, lower) -> DataFrame:
    """Date-partitioned tables (``dt``): add the partition predicate so the
    scan skips whole days (PartitionFilters), not just row groups."""
    if "dt" in table.columns:
        return table.where(F.col("dt") >= F.to_date(_ts_lit(lower)))
    return table


def scan_since(table: DataFrame, since, cols: list[str] | None = None,
               ts_col: str = "timestamp") -> DataFrame:
    """Rows with ts >= since (inclusive lower bound), listed columns only."""
    df = _prune(table, since).where(F.col(ts_col) >= _ts_lit(since))
    return df.select(*[c for c in (cols or table.columns) if c in table.columns])


def scan_after(table: DataFrame, last, cols: list[str] | None = None,
               ts_col: str = "timestamp") -> DataFrame:
    """Catch-up rows strictly after the last scored instant."""
    df = _prune(table, last).where(F.col(ts_col) > _ts_lit(last))
    return df.select(*[c for c in (cols or table.columns) if c in table.columns])


def hours_before(now, hours: float) -> F.Column:
    return _ts_lit(now) - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")


def scan_recent_anomalies(anomalies: DataFrame, now, hours: float) -> DataFrame:
    """Anomalies detected in the last ``hours``, worst (lowest score) first."""
    return (anomalies.where(F.col("detected_at") >= hours_before(now, hours))
            .orderBy(F.col("anomaly_score").asc()))


def scan_pipeline(heartbeats: DataFrame, pipeline_id: str) -> DataFrame:
    """Heartbeat rows of one pipeline."""
    return heartbeats.where(F.col("pipeline_id") == F.lit(pipeline_id))
