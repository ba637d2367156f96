"""Record preparation: flatten, type, split, flag, clean."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import (bucket_start, col_or_null, empty_to_null, to_double,
                                 utc_timestamp)

# Pass-through string fields with "" default, in output order positions.
NUMERIC_FIELDS = ["http_status_code", "llm_cost_usd", "llm_response_time_ms",
                  "llm_total_tokens", "sap_llm_response_time", "sap_llm_response_size"]

# Flat log table: name -> type (order of the flattened record).
FLAT_COLUMNS = [
    ("_id", "string"), ("timestamp", "timestamp_ntz"), ("sourceip", "string"),
    ("port_service", "string"), ("event_description", "string"), ("status", "string"),
    ("logtype", "string"), ("region_id", "string"), ("region_name", "string"),
    ("region_code", "string"), ("macro_region", "string"),
    ("sap_llm_response_time", "double"), ("sap_llm_response_size", "double"),
    ("llm_cost_usd", "double"), ("_score", "double"),
    ("headers_http_request_method", "string"), ("llm_model_id", "string"),
    ("sap_app_env", "string"), ("llm_finish_reason", "string"), ("llm_temperature", "double"),
    ("http_status_code", "double"), ("llm_response_time_ms", "double"),
    ("llm_total_tokens", "double"), ("llm_status", "string"), ("llm_prompt", "string"),
]
FLAT_NAMES = [n for n, _ in FLAT_COLUMNS]

# Export projection: the same flattening minus _score, untyped (text) values.
EXPORT_NAMES = [n for n in FLAT_NAMES if n != "_score"]


def _text(df: DataFrame, name: str, default: str = "") -> Column:
    """Field as text; absent or null -> default (decision: JSON null == absent)."""
    return F.coalesce(col_or_null(df, name).cast("string"), F.lit(default))


def _port_service(df: DataFrame) -> Column:
    method = _text(df, "headers_http_request_method")
    host = _text(df, "headers_http_host")
    return (F.when((F.length(method) > 0) | (F.length(host) > 0),
                   F.concat(method, F.lit(" "), host))
            .otherwise(F.lit("N/A")))


def _status(df: DataFrame) -> Column:
    """First truthy of llm_status, http status code, log type ('' last default)."""
    http_text = col_or_null(df, "http_status_code").cast("string")
    http_text = F.when(http_text.try_cast("double") == 0, F.lit(None)).otherwise(http_text)
    return F.coalesce(empty_to_null(col_or_null(df, "llm_status").cast("string")),
                      empty_to_null(http_text),
                      _text(df, "sap_function_log_type"))


def flatten(raw: DataFrame, timestamp_field: str = "@timestamp",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename, default, derive port_service/status, type timestamp and numbers.

    ``keep`` carries extra input columns through (e.g. a delivery sequence).
    """
    cols = {
        "_id": _text(raw, "_id"),
        "timestamp": utc_timestamp(raw, timestamp_field),
        "sourceip": _text(raw, "client_ip", "N/A"),
        "port_service": _port_service(raw),
        "event_description": _text(raw, "sap_function_message"),
        "status": _status(raw),
        "logtype": _text(raw, "sap_function_log_type", "UNKNOWN"),
        "_score": to_double(col_or_null(raw, "_score")),
        "llm_temperature": to_double(col_or_null(raw, "llm_temperature")),
    }
    for name in NUMERIC_FIELDS:
        cols[name] = to_double(col_or_null(raw, name))
    out = []
    for name, _ in FLAT_COLUMNS:
        c = cols.get(name)
        if c is None:
            c = _text(raw, name)
        out.append(c.alias(name))
    return raw.select(*out, *[F.col(k) for k in keep])


def export_projection(raw: DataFrame, timestamp_field: str = "@timestamp") -> DataFrame:
    """The export flattening (24 columns, no _score, no coercion).

    Text fields take their "" default; numeric fields keep whatever type and
    value they arrived with (an export snapshot, not a typed table).
    """
    cols = {
        "_id": _text(raw, "_id"),
        "timestamp": _text(raw, timestamp_field),
        "sourceip": _text(raw, "client_ip", "N/A"),
        "port_service": _port_service(raw),
        "event_description": _text(raw, "sap_function_message"),
        "status": _status(raw),
        "logtype": _text(raw, "sap_function_log_type", "UNKNOWN"),
    }
    out = []
    for n in EXPORT_NAMES:
        if n in cols:
            c = cols[n]
        elif n in raw.columns and raw.schema[n].dataType.simpleString() != "string":
            c = F.col(n)
        else:
            c = _text(raw, n)
        out.append(c.alias(n))
    return raw.select(*out)


def _null_out(df: DataFrame, names: list[str]) -> DataFrame:
    present = [n for n in names if n in df.columns]
    if not present:
        return df
    return df.withColumns({n: F.lit(None).cast(df.schema[n].dataType) for n in present})


def split_system(flat: DataFrame, drop_llm_columns: bool = True) -> DataFrame:
    """F1 + P7 (+P8): system rows, LLM-only columns nulled (then dropped)."""
    df = _null_out(flat.where(F.col("logtype").isin(C.SYSTEM_LOG_TYPES)), C.LLM_ONLY_COLS)
    if drop_llm_columns:
        df = drop_matching(df, "llm")
    return df


def split_llm(flat: DataFrame, drop_system_columns: bool = True) -> DataFrame:
    """F1 + P7 (+P8): LLM rows, system-only columns nulled (then dropped)."""
    df = _null_out(flat.where(F.col("logtype").isin(C.LLM_LOG_TYPES)), C.SYSTEM_ONLY_COLS)
    if drop_system_columns:
        df = drop_if_present(df, ["sourceip", "http_status_code"])
    return df


def split_by_type(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_system(flat), split_llm(flat)


def split_by_prefix(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """LLM = log type starts with 'LLM'; everything else (unknown too) is system.

    Export variant: the LLM side loses ``sourceip``, the system side every
    column whose name contains 'llm'.
    """
    is_llm = F.coalesce(F.col("logtype").startswith("LLM"), F.lit(False))
    llm = drop_if_present(records.where(is_llm), ["sourceip"])
    system = drop_matching(records.where(~is_llm), "llm")
    return llm, system


def drop_matching(df: DataFrame, fragment: str) -> DataFrame:
    """Drop every column whose lower-cased name contains ``fragment``."""
    return df.drop(*[c for c in df.columns if fragment in c.lower()])


def drop_if_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def flag_security(system: DataFrame) -> DataFrame:
    """SECURITY, or ERROR with HTTP status >= 400 (missing status -> false)."""
    lt = F.col("logtype")
    cond = (lt == "SECURITY") | ((lt == "ERROR") & F.coalesce(F.col("http_status_code") >= 400,
                                                              F.lit(False)))
    return system.withColumn("is_security_event", F.coalesce(cond, F.lit(False)))


def truthy_flag(df: DataFrame, name: str) -> Column:
    """P11 boolean normalisation on the typed value.

    Boolean true, number 1 or the exact text 'true' -> 1; everything else
    (false, 0, null, text 'True', text '1') -> 0.
    """
    c = F.col(name)
    dtype = df.schema[name].dataType.simpleString()
    if dtype == "boolean":
        hit = c
    elif dtype == "string":
        hit = c == F.lit("true")
    else:
        hit = c.cast("double") == F.lit(1.0)
    return F.when(F.coalesce(hit, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def clean_system(system: DataFrame, bucket: str | None = None) -> DataFrame:
    """F4 + P11 (+P13): valid system types, numeric status, 0/1 flag, score default."""
    df = system.where(F.col("logtype").isin(C.SYSTEM_LOG_TYPES)).withColumns({
        "http_status_code": to_double(F.col("http_status_code")),
        "is_security_event": truthy_flag(system, "is_security_event"),
        "_score": F.coalesce(to_double(F.col("_score")), F.lit(C.DEFAULT_SCORE)),
    })
    if bucket:
        df = df.withColumn("bucket", bucket_start(F.col("timestamp"), bucket))
    return df


def clean_llm(llm: DataFrame, bucket: str | None = None) -> DataFrame:
    """F4 + P12 (+P13): valid LLM types, numeric fields, score default."""
    upd = {c: to_double(F.col(c)) for c in
           ["llm_response_time_ms", "llm_cost_usd", "llm_total_tokens", "sap_llm_response_size"]
           if c in llm.columns}
    upd["_score"] = F.coalesce(to_double(F.col("_score")), F.lit(C.DEFAULT_SCORE))
    df = llm.where(F.col("logtype").isin(C.LLM_LOG_TYPES)).withColumns(upd)
    if bucket:
        df = df.withColumn("bucket", bucket_start(F.col("timestamp"), bucket))
    return df


def prepared_logs(raw: DataFrame, timestamp_field: str = "@timestamp"
                  ) -> tuple[DataFrame, DataFrame]:
    """Raw records -> (system logs with security flag, LLM logs), as the ETL step keeps them."""
    flat = flatten(raw, timestamp_field)
    system, llm = split_by_type(flat)
    return flag_security(system), llm
