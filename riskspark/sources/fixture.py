"""Raw log records derived from the ``events`` table.

The driver data has no log table, so raw log records (the fields a paged JSON
log feed carries) are derived row by row from ``events``: one record per
event, ten per event inside a planted traffic flood.  The derivation is a pure
projection plus an ``explode`` (no join), so it scales with ``events`` and is
pushed into the same scan stage.

``DERIVE_SQL`` is the portable text of the same derivation used by the DuckDB
oracle; :func:`raw_logs` is the DataFrame form used by the engine.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: planted incident windows (UTC wall-clock, [start, end)).
INCIDENTS = [
    ("flood", "2024-01-10 13:00:00", "2024-01-10 17:00:00"),
    ("security", "2024-01-15 02:00:00", "2024-01-15 04:00:00"),
    ("filter", "2024-01-20 20:00:00", "2024-01-20 22:00:00"),
    ("cost", "2024-01-25 09:00:00", "2024-01-25 10:00:00"),
]
FLOOD_REPLICAS = 10
# Fixed "now" for time-relative predicates in the fixtures.
FIXED_NOW = "2024-01-31 00:00:00"

DERIVE_SQL = """
WITH rep AS (
  SELECT e.*, r.i AS rep FROM {events} e
  JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) AS r(i)
    ON r.i = 0 OR (e.ts >= TIMESTAMP '2024-01-10 13:00:00' AND e.ts < TIMESTAMP '2024-01-10 17:00:00')
), h AS (
  SELECT *, (event_id * 7919 + user_id * 104729 + rep * 31) % 1000 AS h,
    CASE WHEN ts >= TIMESTAMP '2024-01-10 13:00:00' AND ts < TIMESTAMP '2024-01-10 17:00:00' THEN 'flood'
         WHEN ts >= TIMESTAMP '2024-01-15 02:00:00' AND ts < TIMESTAMP '2024-01-15 04:00:00' THEN 'security'
         WHEN ts >= TIMESTAMP '2024-01-20 20:00:00' AND ts < TIMESTAMP '2024-01-20 22:00:00' THEN 'filter'
         WHEN ts >= TIMESTAMP '2024-01-25 09:00:00' AND ts < TIMESTAMP '2024-01-25 10:00:00' THEN 'cost'
         ELSE 'none' END AS incident FROM rep
), t AS (
  SELECT *, CASE
     WHEN h % 97 = 0 THEN 'UNKNOWN'
     WHEN event_type = 'purchase' AND h % 10 < 8 THEN 'LLM_REQUEST'
     WHEN event_type = 'purchase' AND h % 10 = 8 THEN 'LLM_ERROR'
     WHEN event_type = 'purchase' THEN 'LLM_TIMEOUT'
     WHEN incident = 'security' THEN 'SECURITY'
     WHEN event_type = 'error' AND h % 4 = 0 THEN 'SECURITY'
     WHEN event_type = 'error' THEN 'ERROR'
     WHEN event_type = 'signup' AND h % 2 = 0 THEN 'AUDIT'
     WHEN event_type = 'click' AND h % 5 = 0 THEN 'WARNING'
     WHEN event_type = 'view' AND h % 3 = 0 THEN 'PERF'
     WHEN event_type = 'view' AND h % 3 = 1 THEN 'DEBUG'
     ELSE 'INFO' END AS logtype FROM h
)
SELECT concat('log-', event_id, '-', rep) AS _id, ts AS event_ts, logtype AS sap_function_log_type,
  CASE WHEN h % 50 = 1 THEN NULL WHEN incident = 'flood' THEN '10.9.9.9' ELSE concat('10.0.', user_id % 7, '.', user_id % 250) END AS client_ip,
  CASE h % 12 WHEN 0 THEN '' ELSE concat('svc-', h % 12) END AS headers_http_host,
  CASE WHEN h % 10 < 6 THEN 'GET' WHEN h % 10 < 8 THEN 'POST' WHEN h % 10 = 8 THEN 'PUT' ELSE 'DELETE' END AS headers_http_request_method,
  CASE WHEN logtype LIKE 'LLM%' OR h % 20 = 19 THEN NULL WHEN incident = 'flood' THEN '429'
       WHEN h % 20 < 12 THEN '200' WHEN h % 20 = 12 THEN '400' WHEN h % 20 = 13 THEN '401' WHEN h % 20 = 14 THEN '404'
       WHEN h % 20 = 15 THEN '408' WHEN h % 20 = 16 THEN '429' WHEN h % 20 = 17 THEN '500' ELSE 'n/a' END AS http_status_code,
  CASE WHEN h % 40 = 7 THEN NULL ELSE CAST((h % 100) / 100.0 AS DOUBLE) END AS _score,
  CASE h % 4 WHEN 0 THEN 'AMER' WHEN 1 THEN 'EMEA' WHEN 2 THEN 'APAC' ELSE 'LATAM' END AS macro_region,
  CASE WHEN h % 5 < 3 THEN 'production' WHEN h % 5 = 3 THEN 'staging' ELSE 'dev' END AS sap_app_env,
  CASE WHEN logtype LIKE 'LLM%' THEN concat('model-', h % 3) END AS llm_model_id,
  CASE WHEN logtype LIKE 'LLM%' THEN CAST(CASE WHEN incident = 'cost' THEN value ELSE value / 1000 END AS DOUBLE) END AS llm_cost_usd,
  CASE WHEN logtype LIKE 'LLM%' AND h % 30 <> 3 THEN value * 100 END AS llm_response_time_ms,
  CASE WHEN logtype LIKE 'LLM%' THEN CAST(floor(value * 10) AS BIGINT) END AS llm_total_tokens,
  CASE WHEN logtype = 'LLM_REQUEST' THEN 'success' WHEN logtype = 'LLM_ERROR' THEN 'error' WHEN logtype = 'LLM_TIMEOUT' THEN 'timeout' END AS llm_status,
  CASE WHEN logtype LIKE 'LLM%' THEN CASE WHEN incident = 'filter' OR h % 13 = 0 THEN 'content_filter' WHEN h % 7 = 0 THEN 'length' ELSE 'stop' END END AS llm_finish_reason
FROM t
"""

# Second, overlapping delivery used by merge/dedup fixtures: every record whose
# _id matches 'log-%0-0' arrives again with a changed score.
SECOND_BATCH_SQL = """
SELECT _id, event_ts, sap_function_log_type, client_ip, headers_http_host, headers_http_request_method,
  http_status_code, coalesce(1.0 - _score, 0.99) AS _score, macro_region, sap_app_env, llm_model_id,
  llm_cost_usd, llm_response_time_ms, llm_total_tokens, llm_status, llm_finish_reason
FROM raw_logs WHERE _id LIKE 'log-%0-0'
"""


def oracle_raw_logs_cte() -> str:
    """DuckDB CTE text: ``raw_logs`` over the registered ``events`` view."""
    return "raw_logs AS (" + DERIVE_SQL.replace("{events}", "events") + ")"


def oracle_batches_cte() -> str:
    """DuckDB CTE text: ``raw_batches`` = first delivery (1) + overlap (2)."""
    return (oracle_raw_logs_cte() + ",\nraw_batches AS (SELECT *, 1 AS batch_seq FROM raw_logs "
            "UNION ALL SELECT *, 2 AS batch_seq FROM (" + SECOND_BATCH_SQL + "))")


def _between(ts: Column, start: str, end: str) -> Column:
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))


def derive_raw_logs(events: DataFrame) -> DataFrame:
    """Raw log records from an ``events`` DataFrame (DataFrame form of DERIVE_SQL)."""
    ts = F.col("ts")
    flood = _between(ts, INCIDENTS[0][1], INCIDENTS[0][2])
    rep = F.explode(F.when(flood, F.sequence(F.lit(0), F.lit(FLOOD_REPLICAS - 1)))
                    .otherwise(F.array(F.lit(0)))).alias("rep")
    incident = F.lit("none")
    for name, start, end in reversed(INCIDENTS):
        incident = F.when(_between(ts, start, end), F.lit(name)).otherwise(incident)

    base = events.select("event_id", "ts", "user_id", "event_type", "value", rep)
    h = (F.col("event_id") * 7919 + F.col("user_id") * 104729 + F.col("rep") * 31) % 1000
    base = base.withColumn("h", h).withColumn("incident", incident)

    hh, et, inc = F.col("h"), F.col("event_type"), F.col("incident")
    logtype = (F.when(hh % 97 == 0, "UNKNOWN")
               .when((et == "purchase") & (hh % 10 < 8), "LLM_REQUEST")
               .when((et == "purchase") & (hh % 10 == 8), "LLM_ERROR")
               .when(et == "purchase", "LLM_TIMEOUT")
               .when(inc == "security", "SECURITY")
               .when((et == "error") & (hh % 4 == 0), "SECURITY")
               .when(et == "error", "ERROR")
               .when((et == "signup") & (hh % 2 == 0), "AUDIT")
               .when((et == "click") & (hh % 5 == 0), "WARNING")
               .when((et == "view") & (hh % 3 == 0), "PERF")
               .when((et == "view") & (hh % 3 == 1), "DEBUG")
               .otherwise("INFO"))
    base = base.withColumn("logtype", logtype)
    lt, v, uid = F.col("logtype"), F.col("value"), F.col("user_id")
    is_llm = lt.startswith("LLM")
    m20 = hh % 20
    return base.select(
        F.concat(F.lit("log-"), F.col("event_id").cast("string"), F.lit("-"),
                 F.col("rep").cast("string")).alias("_id"),
        F.col("ts").alias("event_ts"),
        lt.alias("sap_function_log_type"),
        F.when(hh % 50 == 1, F.lit(None).cast("string"))
         .when(inc == "flood", "10.9.9.9")
         .otherwise(F.concat(F.lit("10.0."), (uid % 7).cast("string"), F.lit("."),
                             (uid % 250).cast("string"))).alias("client_ip"),
        F.when(hh % 12 == 0, "").otherwise(F.concat(F.lit("svc-"), (hh % 12).cast("string")))
         .alias("headers_http_host"),
        F.when(hh % 10 < 6, "GET").when(hh % 10 < 8, "POST").when(hh % 10 == 8, "PUT")
         .otherwise("DELETE").alias("headers_http_request_method"),
        F.when(is_llm | (m20 == 19), F.lit(None).cast("string"))
         .when(inc == "flood", "429")
         .when(m20 < 12, "200").when(m20 == 12, "400").when(m20 == 13, "401")
         .when(m20 == 14, "404").when(m20 == 15, "408").when(m20 == 16, "429")
         .when(m20 == 17, "500").otherwise("n/a").alias("http_status_code"),
        F.when(hh % 40 == 7, F.lit(None).cast("double"))
         .otherwise((hh % 100).cast("double") / F.lit(100.0)).alias("_score"),
        F.when(hh % 4 == 0, "AMER").when(hh % 4 == 1, "EMEA").when(hh % 4 == 2, "APAC")
         .otherwise("LATAM").alias("macro_region"),
        F.when(hh % 5 < 3, "production").when(hh % 5 == 3, "staging").otherwise("dev")
         .alias("sap_app_env"),
        F.when(is_llm, F.concat(F.lit("model-"), (hh % 3).cast("string"))).alias("llm_model_id"),
        F.when(is_llm, F.when(inc == "cost", v).otherwise(v / 1000)).alias("llm_cost_usd"),
        F.when(is_llm & (hh % 30 != 3), v * 100).alias("llm_response_time_ms"),
        F.when(is_llm, F.floor(v * 10).cast("bigint")).alias("llm_total_tokens"),
        F.when(lt == "LLM_REQUEST", "success").when(lt == "LLM_ERROR", "error")
         .when(lt == "LLM_TIMEOUT", "timeout").alias("llm_status"),
        F.when(is_llm, F.when((inc == "filter") | (hh % 13 == 0), "content_filter")
               .when(hh % 7 == 0, "length").otherwise("stop")).alias("llm_finish_reason"),
    )


def second_batch(raw: DataFrame) -> DataFrame:
    """The overlapping second delivery (DataFrame form of SECOND_BATCH_SQL)."""
    return (raw.where(F.col("_id").like("log-%0-0"))
            .withColumn("_score", F.coalesce(F.lit(1.0) - F.col("_score"), F.lit(0.99))))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log records for a scale-factor directory."""
    return derive_raw_logs(read_table(spark, sf_dir, "events"))


def raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivery (batch_seq 1) plus the overlapping second one (batch_seq 2)."""
    raw = raw_logs(spark, sf_dir)
    return (raw.withColumn("batch_seq", F.lit(1))
            .unionByName(second_batch(raw).withColumn("batch_seq", F.lit(2))))
