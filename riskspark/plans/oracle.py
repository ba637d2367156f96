"""Independent DuckDB SQL for every checked query.

Each oracle is plain SQL over the driver's registered tables (``events``);
CTE fragments are shared so the chain reads like the engine's stages.  The
engine side never runs this text: it is the reference answer.
"""
from __future__ import annotations

from .. import constants as C
from ..sources.fixture import FIXED_NOW, oracle_batches_cte, oracle_raw_logs_cte

SYS_TYPES = ", ".join(f"'{t}'" for t in C.SYSTEM_LOG_TYPES)
LLM_TYPES = ", ".join(f"'{t}'" for t in C.LLM_LOG_TYPES)


def bucket_sql(col: str, bucket: str) -> str:
    n, unit = bucket.split()
    unit = unit.rstrip("s")
    return f"time_bucket(INTERVAL '{n} {unit}', {col})"


def round6(expr: str, alias: str, digits: int = 6) -> str:
    """Same arithmetic as the engine's ``present``: floor(x * 10^d + 0.5) / 10^d."""
    x = f"CAST({expr} AS DOUBLE)"
    m = 10 ** digits
    return (f"CASE WHEN abs({x}) < 1e9 THEN floor({x} * {m}.0 + 0.5) / {m}.0 ELSE {x} END + 0.0 "
            f"AS {alias}")


def half_even(x: str, d: int) -> str:
    """SQL twin of functions.columns.half_even (same IEEE steps)."""
    m = 10 ** d
    y = f"(CAST({x} AS DOUBLE) * {m}.0)"
    f = f"floor({y})"
    r = (f"CASE WHEN {y} - {f} > 0.5 THEN {f} + 1 WHEN {y} - {f} < 0.5 THEN {f} "
         f"WHEN {f} - 2.0 * floor({f} / 2.0) = 0 THEN {f} ELSE {f} + 1 END")
    return f"(CASE WHEN abs({y}) < 1e15 THEN ({r}) / {m}.0 ELSE CAST({x} AS DOUBLE) END)"


FLAT_SELECT = """
  SELECT
    coalesce(CAST(_id AS VARCHAR), '') AS _id,
    {ts} AS "timestamp",
    coalesce(client_ip, 'N/A') AS sourceip,
    CASE WHEN length(coalesce(headers_http_request_method, '')) > 0 OR length(coalesce(headers_http_host, '')) > 0
         THEN coalesce(headers_http_request_method, '') || ' ' || coalesce(headers_http_host, '') ELSE 'N/A' END AS port_service,
    '' AS event_description,
    coalesce(nullif(llm_status, ''),
             nullif(CASE WHEN TRY_CAST(http_status_code AS DOUBLE) = 0 THEN NULL ELSE CAST(http_status_code AS VARCHAR) END, ''),
             coalesce(sap_function_log_type, '')) AS status,
    coalesce(sap_function_log_type, 'UNKNOWN') AS logtype,
    '' AS region_id, '' AS region_name, '' AS region_code,
    coalesce(macro_region, '') AS macro_region,
    CAST(NULL AS DOUBLE) AS sap_llm_response_time,
    CAST(NULL AS DOUBLE) AS sap_llm_response_size,
    TRY_CAST(llm_cost_usd AS DOUBLE) AS llm_cost_usd,
    TRY_CAST(_score AS DOUBLE) AS _score,
    coalesce(headers_http_request_method, '') AS headers_http_request_method,
    coalesce(llm_model_id, '') AS llm_model_id,
    coalesce(sap_app_env, '') AS sap_app_env,
    coalesce(llm_finish_reason, '') AS llm_finish_reason,
    CAST(NULL AS DOUBLE) AS llm_temperature,
    TRY_CAST(http_status_code AS DOUBLE) AS http_status_code,
    TRY_CAST(llm_response_time_ms AS DOUBLE) AS llm_response_time_ms,
    TRY_CAST(llm_total_tokens AS DOUBLE) AS llm_total_tokens,
    coalesce(llm_status, '') AS llm_status,
    '' AS llm_prompt
  FROM {src}"""

SYS_COLS = ("_id, \"timestamp\", sourceip, port_service, event_description, status, logtype, "
            "region_id, region_name, region_code, macro_region, _score, "
            "headers_http_request_method, sap_app_env, http_status_code")
LLM_COLS = ("_id, \"timestamp\", port_service, event_description, status, logtype, region_id, "
            "region_name, region_code, macro_region, sap_llm_response_time, sap_llm_response_size, "
            "llm_cost_usd, _score, headers_http_request_method, llm_model_id, sap_app_env, "
            "llm_finish_reason, llm_temperature, llm_response_time_ms, llm_total_tokens, "
            "llm_status, llm_prompt")


def flat_cte(src: str = "raw_logs", ts: str = "event_ts") -> str:
    return "flat AS (" + FLAT_SELECT.format(src=src, ts=ts) + ")"


def logs_ctes(src: str = "raw_logs") -> str:
    """raw_logs -> flat -> sys (flagged) / llm, as the ETL keeps them."""
    return ",\n".join([
        flat_cte(src),
        f"sys AS (SELECT {SYS_COLS}, (logtype = 'SECURITY' OR (logtype = 'ERROR' AND "
        f"coalesce(http_status_code >= 400, false))) AS is_security_event "
        f"FROM flat WHERE logtype IN ({SYS_TYPES}))",
        f"llm AS (SELECT {LLM_COLS} FROM flat WHERE logtype IN ({LLM_TYPES}))",
    ])


def clean_ctes(bucket: str) -> str:
    return ",\n".join([
        f"sysc AS (SELECT *, CASE WHEN is_security_event THEN 1 ELSE 0 END AS sec, "
        f"coalesce(_score, {C.DEFAULT_SCORE}) AS score, {bucket_sql(chr(34) + 'timestamp' + chr(34), bucket)} AS bucket "
        f"FROM sys WHERE logtype IN ({SYS_TYPES}))",
        f"llmc AS (SELECT *, coalesce(_score, {C.DEFAULT_SCORE}) AS score, "
        f"{bucket_sql(chr(34) + 'timestamp' + chr(34), bucket)} AS bucket "
        f"FROM llm WHERE logtype IN ({LLM_TYPES}))",
    ])


def _rate(cond: str, src_n: str = "count(*)") -> str:
    return f"CAST(count_if(coalesce({cond}, false)) AS DOUBLE) / {src_n}"


def features_ctes(bucket: str, keys: tuple[str, ...] = ()) -> str:
    """sysf, llmf, features (J1 + A21) over sysc/llmc."""
    k = "".join(f"{x}, " for x in keys)
    g = k + "bucket"

    def top(col: str, name: str, src: str) -> str:
        return (f"{name} AS (SELECT {g}, max(c) AS top, count(*) AS nd FROM (SELECT {g}, {col}, count(*) AS c "
                f"FROM {src} WHERE bucket IS NOT NULL AND {col} IS NOT NULL GROUP BY {g}, {col}) GROUP BY {g})")

    ent = (f"ent AS (SELECT {g}, CASE WHEN count(*) > 1 THEN -sum(p * ln(p + 1e-10)) ELSE 0.0 END AS e "
           f"FROM (SELECT {g}, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY {g}) AS p "
           f"FROM sysc WHERE bucket IS NOT NULL AND headers_http_request_method IS NOT NULL "
           f"GROUP BY {g}, headers_http_request_method) GROUP BY {g})")
    sysmain = f"""sysm AS (SELECT {g},
      CAST(count(*) AS DOUBLE) AS n_sys_requests,
      {_rate('http_status_code >= 400')} AS error_rate,
      {_rate('http_status_code >= 400 AND http_status_code < 500')} AS client_error_rate,
      {_rate('http_status_code >= 500')} AS server_error_rate,
      {_rate('http_status_code = 429')} AS rate_limit_rate,
      {_rate('http_status_code = 408')} AS timeout_http_rate,
      {_rate("logtype = 'ERROR'")} AS pct_error_logtype,
      {_rate("logtype = 'WARNING'")} AS pct_warning_logtype,
      {_rate("logtype = 'SECURITY'")} AS pct_security_logtype,
      {_rate("logtype = 'AUDIT'")} AS pct_audit_logtype,
      {_rate('sec = 1')} AS security_event_rate,
      CAST(sum(sec) AS DOUBLE) AS n_security_events,
      {_rate("headers_http_request_method = 'POST'")} AS pct_post,
      {_rate("headers_http_request_method = 'DELETE'")} AS pct_delete,
      CAST(sum(CAST(score AS DECIMAL(28,10))) AS DOUBLE) / count(score) AS avg_score, CAST(min(score) AS DOUBLE) AS min_score,
      {_rate('score < 0.3')} AS pct_low_score,
      {_rate("sap_app_env = 'production'")} AS pct_production
      FROM sysc WHERE bucket IS NOT NULL GROUP BY {g})"""
    jk = " AND ".join(f"sysm.{x} = {{t}}.{x}" for x in (*keys, "bucket"))

    def on(t: str) -> str:
        return jk.format(t=t)

    sysf = f"""sysf AS (SELECT sysm.*,
      CAST(coalesce(ip.nd, 0) AS DOUBLE) AS n_unique_ips,
      CAST(coalesce(ip.top, 0) AS DOUBLE) / n_sys_requests AS top_ip_share,
      CAST(coalesce(lt.nd, 0) AS DOUBLE) AS n_unique_logtypes,
      coalesce(ent.e, 0.0) AS method_entropy,
      CAST(coalesce(svc.nd, 0) AS DOUBLE) AS n_unique_services,
      CAST(coalesce(reg.nd, 0) AS DOUBLE) AS n_unique_regions,
      CAST(coalesce(reg.top, 0) AS DOUBLE) / n_sys_requests AS top_region_share,
      CAST(coalesce(env.nd, 0) AS DOUBLE) AS n_unique_envs
      FROM sysm LEFT JOIN ip ON {on('ip')} LEFT JOIN lt ON {on('lt')} LEFT JOIN ent ON {on('ent')}
      LEFT JOIN svc ON {on('svc')} LEFT JOIN reg ON {on('reg')} LEFT JOIN env ON {on('env')})"""
    jl = " AND ".join(f"llmm.{x} = {{t}}.{x}" for x in (*keys, "bucket"))
    llmf = f"""llmm AS (SELECT {g},
      CAST(count(*) AS DOUBLE) AS n_llm_requests,
      {_rate("logtype = 'LLM_ERROR'")} AS llm_error_rate,
      {_rate("logtype = 'LLM_TIMEOUT'")} AS llm_timeout_rate,
      coalesce(CAST(sum(CAST(llm_response_time_ms AS DECIMAL(28,6))) AS DOUBLE) / count(llm_response_time_ms), 0.0) AS avg_llm_latency,
      coalesce(quantile_cont(llm_response_time_ms, 0.95), 0.0) AS p95_llm_latency,
      coalesce(max(llm_response_time_ms), 0.0) AS max_llm_latency,
      {_rate('llm_response_time_ms > 20000')} AS pct_slow_llm,
      coalesce(CAST(sum(CAST(llm_cost_usd AS DECIMAL(28,10))) AS DOUBLE) / count(llm_cost_usd), 0.0) AS avg_llm_cost,
      coalesce(CAST(sum(CAST(llm_cost_usd AS DECIMAL(28,10))) AS DOUBLE), 0.0) AS total_llm_cost,
      coalesce(max(llm_cost_usd), 0.0) AS max_llm_cost,
      coalesce(avg(llm_total_tokens), 0.0) AS avg_tokens,
      coalesce(max(llm_total_tokens), 0.0) AS max_tokens,
      CAST(count(DISTINCT llm_model_id) AS DOUBLE) AS n_unique_models,
      {_rate("llm_finish_reason = 'content_filter'")} AS pct_content_filter,
      CAST(sum(CAST(score AS DECIMAL(28,10))) AS DOUBLE) / count(score) AS avg_llm_score
      FROM llmc WHERE bucket IS NOT NULL GROUP BY {g}),
    llmf AS (SELECT * FROM llmm)"""
    del jl
    sys_names = [f for f in C.SYSTEM_FEATURES]
    llm_names = [f for f in C.LLM_FEATURES]
    keysel = "".join(f"coalesce(sysf.{x}, llmf.{x}) AS {x}, " for x in keys)
    fill = ",\n      ".join([f"coalesce(sysf.{f}, 0.0) AS {f}" for f in sys_names] +
                            [f"coalesce(llmf.{f}, 0.0) AS {f}" for f in llm_names])
    fon = " AND ".join(f"sysf.{x} = llmf.{x}" for x in (*keys, "bucket"))
    feats = f"""fj AS (SELECT {keysel}coalesce(sysf.bucket, llmf.bucket) AS bucket,
      {fill}
      FROM sysf FULL OUTER JOIN llmf ON {fon}),
    features AS (SELECT *, n_llm_requests / (n_sys_requests + 1.0) AS llm_to_sys_ratio,
      n_sys_requests + n_llm_requests AS total_requests FROM fj)"""
    return ",\n".join([
        top("sourceip", "ip", "sysc"), top("logtype", "lt", "sysc"), ent,
        top("port_service", "svc", "sysc"), top("macro_region", "reg", "sysc"),
        top("sap_app_env", "env", "sysc"), sysmain, sysf, llmf, feats])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def base_ctes(bucket: str, keys: tuple[str, ...] = ()) -> str:
    return with_(oracle_raw_logs_cte(), logs_ctes(), clean_ctes(bucket), features_ctes(bucket, keys))


def select_rounded(cols: list[str], doubles: set[str], src: str, where: str = "") -> str:
    parts = [round6(c, c) if c in doubles else c for c in cols]
    return f"SELECT {', '.join(parts)} FROM {src} {where}"


__all__ = ["FIXED_NOW", "oracle_batches_cte", "oracle_raw_logs_cte"]
