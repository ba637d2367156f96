"""Registered queries, steps 1-2: preparation and per-bucket features."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import features as FT
from ..operators import prepare as PR
from ..operators import spans as SP
from ..sources import tables as TB
from ..sources.fixture import FIXED_NOW, raw_logs
from . import oracle as O
from .common import QUERY_BUCKET, TS_FIELD, cleaned, flat_logs, logs, present

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


B = QUERY_BUCKET
RAW = O.oracle_raw_logs_cte()
LOGS = O.with_(RAW, O.logs_ctes())
CLEAN = O.with_(RAW, O.logs_ctes(), O.clean_ctes(B))
FEATS = O.base_ctes(B)
FLAT_DOUBLES = {n for n, t in PR.FLAT_COLUMNS if t == "double"}


# ---- step 1: preparation ---------------------------------------------------
@register("q_flatten", O.with_(RAW, O.flat_cte()) +
          O.select_rounded(PR.FLAT_NAMES, FLAT_DOUBLES, "flat"))
def q_flatten(spark, sf_dir):
    """The flat typed record table."""
    return present(PR.lower_columns(flat_logs(spark, sf_dir)))


@register("q_port_service", O.with_(RAW, O.flat_cte()) +
          "SELECT port_service, count(*) AS n_rows FROM flat GROUP BY port_service")
def q_port_service(spark, sf_dir):
    """port_service values and their row counts."""
    return flat_logs(spark, sf_dir).groupBy("port_service").agg(F.count(F.lit(1)).alias("n_rows"))


@register("q_status_fallthrough", O.with_(RAW, O.flat_cte()) +
          "SELECT status, logtype, count(*) AS n_rows FROM flat GROUP BY status, logtype")
def q_status_fallthrough(spark, sf_dir):
    """status = llm_status, else HTTP code, else log type."""
    return (flat_logs(spark, sf_dir).groupBy("status", "logtype")
            .agg(F.count(F.lit(1)).alias("n_rows")))


SYS_NAMES = [c.strip().strip('"') for c in O.SYS_COLS.split(",")]
LLM_NAMES = [c.strip().strip('"') for c in O.LLM_COLS.split(",")]


@register("q_split_system", LOGS + O.select_rounded(
    SYS_NAMES, FLAT_DOUBLES, "(SELECT " + O.SYS_COLS + " FROM sys)"))
def q_split_system(spark, sf_dir):
    """System rows, LLM columns nulled and dropped."""
    return present(PR.split_system(flat_logs(spark, sf_dir)))


@register("q_split_llm", LOGS + O.select_rounded(LLM_NAMES, FLAT_DOUBLES, "llm"))
def q_split_llm(spark, sf_dir):
    """LLM rows, system-only columns nulled and dropped."""
    return present(PR.split_llm(flat_logs(spark, sf_dir)))


@register("q_split_prefix", O.with_(RAW, O.flat_cte()) + """
SELECT CASE WHEN logtype LIKE 'LLM%' THEN 'llm' ELSE 'system' END AS side, logtype,
       count(*) AS n_rows,
       CASE WHEN logtype LIKE 'LLM%' THEN 24 ELSE 15 END AS n_columns
FROM flat GROUP BY 1, 2, 4""")
def q_split_prefix(spark, sf_dir):
    """F2 + P8: prefix split of the export projection (unknown types go to system)."""
    flat = flat_logs(spark, sf_dir)
    llm, system = PR.split_by_prefix(flat)

    def side(df, name):
        return df.groupBy("logtype").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("side"), "logtype", "n_rows",
            F.lit(len(df.columns)).alias("n_columns"))
    return side(llm, "llm").unionByName(side(system, "system"))


@register("q_security_flag", LOGS +
          "SELECT logtype, http_status_code, is_security_event, count(*) AS n_rows "
          "FROM sys GROUP BY ALL")
def q_security_flag(spark, sf_dir):
    """SECURITY, or ERROR with status >= 400."""
    system, _ = logs(spark, sf_dir)
    return present(system.groupBy("logtype", "http_status_code", "is_security_event")
                   .agg(F.count(F.lit(1)).alias("n_rows")))


@register("q_clean_system", CLEAN + O.select_rounded(
    ["_id", "bucket", "http_status_code", "is_security_event", "_score"],
    {"http_status_code", "_score"},
    "(SELECT _id, bucket, http_status_code, sec AS is_security_event, score AS _score FROM sysc)"))
def q_clean_system(spark, sf_dir):
    """Valid system rows, numeric status, 0/1 flag, score default, bucket."""
    sysc, _ = cleaned(spark, sf_dir)
    return present(sysc.select("_id", "bucket", "http_status_code", "is_security_event", "_score"))


LLM_CLEAN_COLS = ["_id", "bucket", "llm_response_time_ms", "llm_cost_usd", "llm_total_tokens",
                  "sap_llm_response_size", "_score"]


@register("q_clean_llm", CLEAN + O.select_rounded(
    LLM_CLEAN_COLS, set(LLM_CLEAN_COLS[2:]),
    "(SELECT _id, bucket, llm_response_time_ms, llm_cost_usd, llm_total_tokens, "
    "sap_llm_response_size, score AS _score FROM llmc)"))
def q_clean_llm(spark, sf_dir):
    """Valid LLM rows, numeric fields, score default, bucket."""
    _, llmc = cleaned(spark, sf_dir)
    return present(llmc.select(*LLM_CLEAN_COLS))


EXPORT_SQL = O.with_(RAW) + """
SELECT coalesce(_id, '') AS _id, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
  coalesce(client_ip, 'N/A') AS sourceip,
  CASE WHEN length(coalesce(headers_http_request_method, '')) > 0 OR length(coalesce(headers_http_host, '')) > 0
       THEN coalesce(headers_http_request_method, '') || ' ' || coalesce(headers_http_host, '') ELSE 'N/A' END AS port_service,
  '' AS event_description,
  coalesce(nullif(llm_status, ''), nullif(http_status_code, ''), coalesce(sap_function_log_type, '')) AS status,
  coalesce(sap_function_log_type, 'UNKNOWN') AS logtype,
  '' AS region_id, '' AS region_name, '' AS region_code, coalesce(macro_region, '') AS macro_region,
  '' AS sap_llm_response_time, '' AS sap_llm_response_size,
  {COST},
  coalesce(headers_http_request_method, '') AS headers_http_request_method,
  coalesce(llm_model_id, '') AS llm_model_id, coalesce(sap_app_env, '') AS sap_app_env,
  coalesce(llm_finish_reason, '') AS llm_finish_reason, '' AS llm_temperature,
  coalesce(http_status_code, '') AS http_status_code,
  {LAT},
  llm_total_tokens, coalesce(llm_status, '') AS llm_status, '' AS llm_prompt
FROM raw_logs""".replace("{COST}", O.round6("llm_cost_usd", "llm_cost_usd")).replace(
    "{LAT}", O.round6("llm_response_time_ms", "llm_response_time_ms"))


@register("q_export_projection", EXPORT_SQL)
def q_export_projection(spark, sf_dir):
    """The export flattening (24 columns, no _score, values not coerced)."""
    raw = raw_logs(spark, sf_dir).withColumn(
        TS_FIELD, F.date_format(F.col(TS_FIELD), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return present(PR.export_projection(raw, TS_FIELD))


CSV_TEXT = ["_id", "sourceip", "port_service", "event_description", "status", "logtype",
            "region_id", "region_name", "region_code", "macro_region",
            "headers_http_request_method", "sap_app_env"]


@register("q_csv_roundtrip", O.with_(RAW, O.flat_cte()) + "SELECT " + ", ".join(
    [f"nullif({c}, '') AS {c}" for c in CSV_TEXT] + ['"timestamp"'] +
    [O.round6(c, c) for c in ["_score", "http_status_code"]]) +
    " FROM flat WHERE logtype NOT LIKE 'LLM%'")
def q_csv_roundtrip(spark, sf_dir):
    """S5 + K5: system-side export written as CSV with header, read back with a schema.

    As with any CSV reader, an empty text field reads back as null.
    """
    from ..sinks.files import export_csv, read_csv
    from ..session import shared_dir
    import uuid
    flat = flat_logs(spark, sf_dir)
    _, system = PR.split_by_prefix(flat)
    path = shared_dir(spark, f"csv-roundtrip/{uuid.uuid4().hex}")
    export_csv(system, path)
    return present(read_csv(spark, path, system.schema))


# ---- step 2: features --------------------------------------------------------
def _feature_query(name, cols, side):
    src = {"sys": "sysf", "llm": "llmf", "all": "features"}[side]
    sql = FEATS + O.select_rounded(["bucket", *cols], set(cols), src)

    def fn(spark, sf_dir):
        system, llm = logs(spark, sf_dir)
        if side == "sys":
            df = FT.system_features(system, B)
        elif side == "llm":
            df = FT.llm_features(llm, B)
        else:
            df = FT.build_features(system, llm, B)
        return present(df.select("bucket", *cols))
    fn.__name__ = name
    fn.__doc__ = f"Features {', '.join(cols)} per {B} bucket."
    register(name, sql)(fn)


_feature_query("q_sys_volume", ["n_sys_requests", "n_unique_ips", "top_ip_share"], "sys")
_feature_query("q_http_rates", ["error_rate", "client_error_rate", "server_error_rate",
                                "rate_limit_rate", "timeout_http_rate"], "sys")
_feature_query("q_logtype_mix", ["pct_error_logtype", "pct_warning_logtype",
                                 "pct_security_logtype", "pct_audit_logtype",
                                 "n_unique_logtypes"], "sys")
_feature_query("q_security_rate", ["security_event_rate", "n_security_events"], "sys")
_feature_query("q_method_entropy", ["method_entropy"], "sys")
_feature_query("q_method_mix", ["pct_post", "pct_delete"], "sys")
_feature_query("q_risk_score", ["avg_score", "min_score", "pct_low_score"], "sys")
_feature_query("q_geo_env", ["n_unique_services", "n_unique_regions", "top_region_share",
                             "pct_production", "n_unique_envs"], "sys")
_feature_query("q_llm_volume", ["n_llm_requests", "llm_error_rate", "llm_timeout_rate"], "llm")
_feature_query("q_llm_latency", ["avg_llm_latency", "p95_llm_latency", "max_llm_latency",
                                 "pct_slow_llm"], "llm")
_feature_query("q_llm_cost", ["avg_llm_cost", "total_llm_cost", "max_llm_cost", "avg_tokens",
                              "max_tokens"], "llm")
_feature_query("q_llm_models", ["n_unique_models", "pct_content_filter", "avg_llm_score"], "llm")
_feature_query("q_features_all", list(C.FEATURE_COLS), "all")


@register("q_features_keyed", O.base_ctes(B, ("sap_app_env",)) + O.select_rounded(
    ["sap_app_env", "bucket", *C.FEATURE_COLS], set(C.FEATURE_COLS), "features"))
def q_features_keyed(spark, sf_dir):
    """J1, A21 keyed by environment: the scale-out shape (one series per key)."""
    system, llm = logs(spark, sf_dir)
    return present(FT.build_features(system, llm, B, keys=["sap_app_env"]))


SPAN_SQL = LOGS + """
, a AS (SELECT min("timestamp") AS min_ts, max("timestamp") AS max_ts, count(*) AS n_rows FROM sys),
b AS (SELECT *, CAST(date_diff('microsecond', min_ts, max_ts) AS DOUBLE) / 3.6e9 AS span_hours FROM a)
SELECT min_ts, max_ts, n_rows, round(span_hours, 6) + 0.0 AS span_hours,
  round(least(span_hours / 24.0 * 100, 100.0), 6) + 0.0 AS pct_ready,
  round(greatest(24.0 - span_hours, 0.0), 6) + 0.0 AS hours_missing,
  coalesce(span_hours >= 24.0, false) AS ready FROM b"""


@register("q_data_span", SPAN_SQL)
def q_data_span(spark, sf_dir):
    """Stored span, progress against 24 h, training gate."""
    system, _ = logs(spark, sf_dir)
    return present(SP.data_span(system))


@register("q_progress_mark", LOGS + 'SELECT max("timestamp") AS progress_mark FROM sys')
def q_progress_mark(spark, sf_dir):
    """MAX(timestamp) of the system table."""
    system, _ = logs(spark, sf_dir)
    return SP.progress_mark(system)


@register("q_two_table_span", LOGS + """
, u AS (SELECT "timestamp" AS ts FROM sys UNION ALL SELECT "timestamp" FROM llm),
a AS (SELECT min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS n_rows FROM u WHERE ts IS NOT NULL)
SELECT min_ts, max_ts, n_rows,
  round(CAST(date_diff('microsecond', min_ts, max_ts) AS DOUBLE) / 3.6e9, 6) + 0.0 AS span_hours FROM a""")
def q_two_table_span(spark, sf_dir):
    """Span over both tables' timestamps."""
    system, llm = logs(spark, sf_dir)
    return present(SP.two_table_span(system, llm))


@register("q_recent_logs", LOGS + O.select_rounded(
    TB.SYSTEM_SCAN_COLS, {"http_status_code", "_score"},
    "sys", f"WHERE \"timestamp\" >= TIMESTAMP '{FIXED_NOW}' - INTERVAL 24 HOUR"))
def q_recent_logs(spark, sf_dir):
    """The last 24 h of system logs before a fixed 'now', scan columns only."""
    system, _ = logs(spark, sf_dir)
    return present(TB.scan_since(system, TB.hours_before(FIXED_NOW, 24), TB.SYSTEM_SCAN_COLS))


# ---- step 1: landed pages and manifests (S1-S4, F12, U4) ----------------------
PAGE_SIZE_EVENTS = 100


def _land(spark, sf_dir):
    """Land the derived records as paged JSON documents and a manifest per 30 min."""
    import uuid
    from ..session import shared_dir
    from ..sinks.files import land_pages
    raw = raw_logs(spark, sf_dir)
    page = (F.floor(F.split("_id", "-").getItem(1).cast("bigint") / PAGE_SIZE_EVENTS) + 1).cast("int")
    recs = raw.withColumnRenamed(TS_FIELD, "@timestamp").withColumn("page", page)
    base = shared_dir(spark, f"landing/{uuid.uuid4().hex}")
    land_pages(recs, f"{base}/pages")
    ws = F.window(F.col("@timestamp"), "30 minutes")
    man = (recs.groupBy(ws.alias("w")).agg(F.count(F.lit(1)).alias("total_records"),
                                           F.count_distinct("page").cast("int").alias("total_pages"))
           .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                   F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                   "total_pages", "total_records"))
    man.write.mode("overwrite").json(f"{base}/manifest")
    return base


PAGE_SQL = O.with_(RAW, "paged AS (SELECT *, CAST(floor(CAST(split_part(_id, '-', 2) AS BIGINT) / "
                   f"{PAGE_SIZE_EVENTS}) + 1 AS INTEGER) AS page FROM raw_logs)",
                   O.flat_cte("paged").replace("FROM paged", ", page FROM paged"))


@register("q_page_scan", PAGE_SQL + O.select_rounded(PR.FLAT_NAMES + ["page"], FLAT_DOUBLES, "flat"))
def q_page_scan(spark, sf_dir):
    """S1, S2 (no cap), U4: records read back from landed page documents, flattened."""
    from ..sources.pages import read_pages
    base = _land(spark, sf_dir)
    recs = read_pages(spark, f"{base}/pages", max_pages=0)
    return present(PR.flatten(recs, "@timestamp", keep=("page",)))


BAD_SQL = PAGE_SQL + """, d AS (SELECT page, page % 7 = 3 AS bad, count(*) AS n FROM flat GROUP BY ALL)
SELECT page, CASE WHEN bad THEN 0 ELSE n END AS n_records, CASE WHEN bad THEN 1 ELSE 0 END AS n_bad FROM d"""


@register("q_bad_pages", BAD_SQL)
def q_bad_pages(spark, sf_dir):
    """Records and malformed documents of every landed page; every seventh page was cut off in transit."""
    from ..sources.pages import bad_pages, page_texts, read_pages
    base = _land(spark, sf_dir)
    cut = F.expr("substring(value, 1, length(value) - 3)")
    (page_texts(spark, f"{base}/pages")
     .select(F.when(F.col("page") % 7 == 3, cut).otherwise(F.col("value")).alias("value")).write.text(f"{base}/cut"))
    good = read_pages(spark, f"{base}/cut", strict=False).select("page", F.lit(1).alias("n_records"), F.lit(0).alias("n_bad"))
    bad = bad_pages(spark, f"{base}/cut").select("page", F.lit(0).alias("n_records"), F.lit(1).alias("n_bad"))
    return good.unionByName(bad).groupBy("page").agg(F.sum("n_records").alias("n_records"), F.sum("n_bad").alias("n_bad"))


MANIFEST_SQL = O.with_(RAW, """m AS (SELECT time_bucket(INTERVAL '30 minute', event_ts) AS ws,
  count(*) AS total_records, CAST(count(DISTINCT floor(CAST(split_part(_id, '-', 2) AS BIGINT) / 100)) AS INTEGER) AS total_pages
  FROM raw_logs GROUP BY 1)""") + """
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(ws + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, total_pages, total_records,
  total_records AS scanned, true AS complete, true AS changed FROM m"""


@register("q_manifest_reconcile", MANIFEST_SQL)
def q_manifest_reconcile(spark, sf_dir):
    """Manifest totals vs records scanned per window; window change flag."""
    from ..sources.pages import read_manifest, read_pages, reconcile
    base = _land(spark, sf_dir)
    recs = PR.flatten(read_pages(spark, f"{base}/pages"), "@timestamp")
    return reconcile(read_manifest(spark, f"{base}/manifest"), recs)
