"""Table schemas and ``align_to`` (P10)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SYSTEM_LOGS_DDL = (
    "_id string, timestamp timestamp_ntz, sourceip string, port_service string, "
    "event_description string, status string, logtype string, region_id string, "
    "region_name string, region_code string, macro_region string, _score decimal(10,4), "
    "headers_http_request_method string, sap_app_env string, http_status_code int, "
    "is_security_event int")
_LLM_LOGS_DDL = (
    "_id string, timestamp timestamp_ntz, port_service string, event_description string, "
    "status string, logtype string, region_id string, region_name string, region_code string, "
    "macro_region string, sap_llm_response_time decimal(12,4), sap_llm_response_size decimal(14,2), "
    "llm_cost_usd decimal(10,6), _score decimal(10,4), headers_http_request_method string, "
    "llm_model_id string, sap_app_env string, llm_finish_reason string, llm_temperature decimal(5,2), "
    "llm_response_time_ms decimal(12,4), llm_total_tokens int, llm_status string, llm_prompt string")
_RAW_RECORD_DDL = (
    "_id string, `@timestamp` string, client_ip string, headers_http_host string, "
    "headers_http_request_method string, sap_function_message string, sap_function_log_type string, "
    "region_id string, region_name string, region_code string, macro_region string, "
    "sap_app_env string, http_status_code string, _score string, sap_llm_response_time string, "
    "sap_llm_response_size string, llm_cost_usd string, llm_response_time_ms string, "
    "llm_total_tokens string, llm_temperature string, llm_model_id string, "
    "llm_finish_reason string, llm_status string, llm_prompt string")
_MANIFEST_DDL = (
    "window_start string, window_end string, total_pages int, total_records bigint")
_HEARTBEAT_DDL = (
    "pipeline_id string, sent_at timestamp_ntz, pipeline_host string, cycle int, status string, "
    "last_window_start string, uptime_min decimal(10,2)")
_ALERT_LOG_DDL = (
    "alert_id string, sent_at timestamp, bucket_start string, anomaly_type string, "
    "attack_category string, severity string, status string, http_status int, "
    "message_sent string, api_response string")


_DDL = {n: globals()[f"_{n}_DDL"] for n in
        ("SYSTEM_LOGS", "LLM_LOGS", "RAW_RECORD", "MANIFEST", "HEARTBEAT", "ALERT_LOG")}
_CACHE: dict = {}


def __getattr__(name: str) -> StructType:
    """Schemas are parsed from DDL on first use (parsing needs a running session)."""
    if name in _DDL:
        if name not in _CACHE:
            _CACHE[name] = StructType.fromDDL(_DDL[name])
        return _CACHE[name]
    raise AttributeError(name)


def align_to(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """P10: project onto a table's columns; missing -> null; values cast to the column type.

    Numbers go through ``try_cast`` via double where the target is integral,
    so '429.0' becomes 429 and junk becomes null instead of failing.  ``keep`` carries
    extra columns through.
    """
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f"`{f.name}`")
            t = f.dataType.simpleString()
            src = df.schema[f.name].dataType.simpleString()
            if t in ("int", "bigint", "smallint", "tinyint") and src not in ("int", "bigint", "boolean"):
                c = F.round(c.try_cast("double"), 0).try_cast(t)
            elif t in ("int",) and src == "boolean":
                c = c.cast("int")
            else:
                c = c.try_cast(f.dataType) if src != t else c
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols, *[F.col(k) for k in keep])
