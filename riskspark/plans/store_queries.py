"""Registered queries, step 4: keyed tables, anomaly records, audit, liveness."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import audit as AU
from ..operators import liveness as LV
from ..operators import merge as MG
from ..operators import prepare as PR
from ..operators import spans as SP
from ..operators.logsets import ids_in_bucket, top_value_per_bucket
from .. import schemas
from ..schemas import align_to
from ..sinks import keyindex
from ..sources import tables as TB
from ..sources.fixture import FIXED_NOW, raw_batches, read_table
from . import oracle as O
from .common import QUERY_BUCKET, TS_FIELD, cleaned, logs, present
from .detect import with_bucket_context, z_chain
from .detect_queries import CHAIN, MSG, THRESHOLD
from .records import anomaly_records

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
R6 = O.round6
HE = O.half_even

# ---- keyed merge -------------------------------------------------------------
BATCHES = O.with_(O.oracle_batches_cte(), "flatb AS (" + O.FLAT_SELECT.format(
    src="raw_batches", ts="event_ts").replace("FROM raw_batches", ", batch_seq FROM raw_batches") + ")")


def flat_batches(spark, sf_dir):
    """Flattened records of both deliveries, with their ``batch_seq``."""
    return PR.flatten(raw_batches(spark, sf_dir), TS_FIELD, keep=("batch_seq",))


@register("q_dedup_keep_last", BATCHES + ", d AS (SELECT *, row_number() OVER (PARTITION BY _id "
          "ORDER BY batch_seq DESC) AS rn FROM flatb) SELECT _id, batch_seq, " + R6("_score", "_score") +
          " FROM d WHERE rn = 1")
def q_dedup_keep_last(spark, sf_dir):
    """One row per _id, the latest delivery wins."""
    fb = flat_batches(spark, sf_dir)
    return present(MG.dedup_keep_last(fb, "_id", ("batch_seq",)).select("_id", "batch_seq", "_score"))


def _sys_table(flat):
    system = PR.flag_security(PR.split_system(flat))
    return align_to(system, schemas.SYSTEM_LOGS)


UPSERT_SQL = BATCHES + f""",
s AS (SELECT *, (logtype = 'SECURITY' OR (logtype = 'ERROR' AND coalesce(http_status_code >= 400, false)))
      AS sec FROM flatb WHERE logtype IN ({O.SYS_TYPES})),
d AS (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY batch_seq DESC) AS rn FROM s)
SELECT _id, "timestamp", logtype, CAST(_score AS DECIMAL(10,4)) AS _score,
  CASE WHEN sec THEN 1 ELSE 0 END AS is_security_event,
  CAST(round(http_status_code) AS INTEGER) AS http_status_code FROM d WHERE rn = 1"""


@register("q_upsert_snapshot", UPSERT_SQL)
def q_upsert_snapshot(spark, sf_dir):
    """System table after upserting the overlapping second delivery."""
    fb = flat_batches(spark, sf_dir)
    old = _sys_table(fb.where("batch_seq = 1").drop("batch_seq"))
    new = _sys_table(fb.where("batch_seq = 2").drop("batch_seq"))
    snap = MG.upsert(old, new, "_id")
    return snap.select("_id", "timestamp", "logtype", "_score", "is_security_event",
                       "http_status_code")


def _delivered(spark, sf_dir):
    """The system table after both deliveries were upserted; its path."""
    import uuid
    from ..session import shared_dir
    from ..sinks.tables import merge_into
    table = f"{shared_dir(spark, f'delivered/{uuid.uuid4().hex}')}/system_logs"
    fb = flat_batches(spark, sf_dir)
    for seq in (1, 2):
        merge_into(spark, table, _sys_table(fb.where(F.col("batch_seq") == seq).drop("batch_seq")))
    return table


KEPT_SQL = UPSERT_SQL.rsplit("SELECT _id,", 1)[0].rstrip() + """,
kept AS (SELECT * FROM d WHERE rn = 1)"""


@register("q_zones", KEPT_SQL + """ SELECT CAST("timestamp" AS DATE) AS dt, count(*) AS n_rows,
  min("timestamp") AS min_ts, max("timestamp") AS max_ts FROM kept GROUP BY 1""")
def q_zones(spark, sf_dir):
    """What the upsert keeps of every day, after two overlapping deliveries."""
    return keyindex.zones(spark, _delivered(spark, sf_dir)).select("dt", "n_rows", "min_ts", "max_ts")


@register("q_zone_span", KEPT_SQL + f""",
z AS (SELECT min("timestamp") AS min_ts, max("timestamp") AS max_ts, count(*) AS n_rows FROM kept),
zz AS (SELECT *, CAST(date_diff('microsecond', min_ts, max_ts) AS DOUBLE) / 3.6e9 AS hours FROM z)
SELECT min_ts, max_ts, n_rows, {R6('hours', 'span_hours')}, {R6(f'least(hours / {float(C.MIN_TRAINING_HOURS)} * 100, 100.0)', 'pct_ready')},
  {R6(f'greatest({float(C.MIN_TRAINING_HOURS)} - hours, 0.0)', 'hours_missing')},
  coalesce(hours >= {float(C.MIN_TRAINING_HOURS)}, false) AS ready FROM zz""")
def q_zone_span(spark, sf_dir):
    """The training gate from the zones, without a scan of rows."""
    return present(SP.zone_span(keyindex.zones(spark, _delivered(spark, sf_dir))))


@register("q_key_days", KEPT_SQL + """ SELECT CAST("timestamp" AS DATE) AS dt, count(*) AS n_keys FROM kept GROUP BY 1""")
def q_key_days(spark, sf_dir):
    """K1: keys that the index finds in every day: each delivered key is looked up, and is in one day."""
    table = _delivered(spark, sf_dir)
    keys = _sys_table(flat_batches(spark, sf_dir).drop("batch_seq")).select("_id").distinct()
    n_bits = keyindex.bits(spark, table)
    found = keyindex.entries(spark, table, n_bits, keyindex.buckets_of(keys, "_id", n_bits))
    return (keys.select(keyindex.digest("_id").alias("h")).join(found, "h")
            .groupBy("dt").agg(F.count(F.lit(1)).alias("n_keys")))


NEWROWS_SQL = BATCHES + """,
ex AS (SELECT DISTINCT _id FROM flatb WHERE batch_seq = 1 AND "timestamp" < TIMESTAMP '2024-01-15 00:00:00'),
nw AS (SELECT DISTINCT _id FROM flatb WHERE batch_seq = 2 OR "timestamp" >= TIMESTAMP '2024-01-15 00:00:00')
SELECT CAST(count(*) AS BIGINT) AS new_rows FROM nw WHERE _id NOT IN (SELECT _id FROM ex)"""


@register("q_new_row_count", NEWROWS_SQL)
def q_new_row_count(spark, sf_dir):
    """K4: rows the next delivery adds to what is stored (window 2 + the overlap)."""
    fb = flat_batches(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    existing = fb.where((F.col("batch_seq") == 1) & (F.col("timestamp") < cut))
    new = fb.where((F.col("batch_seq") == 2) | (F.col("timestamp") >= cut))
    return MG.new_row_count(existing, new)


LOADS = O.with_(O.oracle_raw_logs_cte(), O.logs_ctes())


@register("q_load_system", LOADS + """SELECT _id, "timestamp", sourceip, port_service, event_description,
  status, logtype, region_id, region_name, region_code, macro_region, CAST(_score AS DECIMAL(10,4)) AS _score,
  headers_http_request_method, sap_app_env, CAST(round(http_status_code) AS INTEGER) AS http_status_code,
  CASE WHEN is_security_event THEN 1 ELSE 0 END AS is_security_event FROM sys""")
def q_load_system(spark, sf_dir):
    """K2, P10: system rows typed and aligned to the SYSTEM_LOGS columns."""
    system, _ = logs(spark, sf_dir)
    return align_to(system, schemas.SYSTEM_LOGS)


@register("q_load_llm", LOADS + """SELECT _id, "timestamp", port_service, event_description, status, logtype,
  region_id, region_name, region_code, macro_region, CAST(sap_llm_response_time AS DECIMAL(12,4)) AS sap_llm_response_time,
  CAST(sap_llm_response_size AS DECIMAL(14,2)) AS sap_llm_response_size, CAST(llm_cost_usd AS DECIMAL(10,6)) AS llm_cost_usd,
  CAST(_score AS DECIMAL(10,4)) AS _score, headers_http_request_method, llm_model_id, sap_app_env, llm_finish_reason,
  CAST(llm_temperature AS DECIMAL(5,2)) AS llm_temperature, CAST(llm_response_time_ms AS DECIMAL(12,4)) AS llm_response_time_ms,
  CAST(round(llm_total_tokens) AS INTEGER) AS llm_total_tokens, llm_status, llm_prompt FROM llm""")
def q_load_llm(spark, sf_dir):
    """K3, P10: LLM rows typed and aligned to the LLM_LOGS columns."""
    _, llm = logs(spark, sf_dir)
    return align_to(llm, schemas.LLM_LOGS)


LAST_SCORED = "2024-01-20 00:00:00"
FRESH_FROM = "2024-01-25 00:00:00"


@register("q_catchup", LOADS + f""",
fresh AS (SELECT "timestamp" AS ts FROM sys WHERE "timestamp" >= TIMESTAMP '{FRESH_FROM}'
          UNION ALL SELECT "timestamp" FROM llm WHERE "timestamp" >= TIMESTAMP '{FRESH_FROM}'),
g AS (SELECT min(ts) AS fresh_min FROM fresh WHERE ts IS NOT NULL),
gg AS (SELECT fresh_min, CAST(date_diff('microsecond', TIMESTAMP '{LAST_SCORED}', fresh_min) AS DOUBLE) / 3.6e9 AS gap FROM g)
SELECT TIMESTAMP '{LAST_SCORED}' AS last_scored_until, fresh_min, {R6('gap', 'gap_hours')},
  coalesce(gap > 0.6, false) AS catch_up,
  (SELECT count(*) FROM sys WHERE "timestamp" > TIMESTAMP '{LAST_SCORED}') AS n_sys_rows,
  (SELECT count(*) FROM llm WHERE "timestamp" > TIMESTAMP '{LAST_SCORED}') AS n_llm_rows FROM gg""")
def q_catchup(spark, sf_dir):
    """Gap since the last scored instant; rows a catch-up re-reads."""
    system, llm = logs(spark, sf_dir)
    fresh_s = TB.scan_since(system, FRESH_FROM, ["timestamp"])
    fresh_l = TB.scan_since(llm, FRESH_FROM, ["timestamp"])
    gap = SP.catchup_gap(fresh_s, fresh_l, LAST_SCORED)
    ns = TB.scan_after(system, LAST_SCORED, ["_id"]).agg(F.count(F.lit(1)).alias("n_sys_rows"))
    nl = TB.scan_after(llm, LAST_SCORED, ["_id"]).agg(F.count(F.lit(1)).alias("n_llm_rows"))
    from ..operators.classify import join_per_key
    out = join_per_key(join_per_key(gap, ns, []), nl, [])
    return present(out)


# ---- anomaly records and evidence ----------------------------------------------
IDS_SQL = """,
sysids AS (SELECT bucket, 'system' AS side, _id, row_number() OVER (PARTITION BY bucket ORDER BY "timestamp", _id) AS rank
           FROM sysc WHERE bucket IN (SELECT bucket FROM flagged) AND _id IS NOT NULL),
llmids AS (SELECT bucket, 'llm' AS side, _id, row_number() OVER (PARTITION BY bucket ORDER BY "timestamp", _id) AS rank
           FROM llmc WHERE bucket IN (SELECT bucket FROM flagged) AND _id IS NOT NULL),
ids AS (SELECT * FROM sysids WHERE rank <= 50 UNION ALL SELECT * FROM llmids WHERE rank <= 50)
"""


@register("q_anomaly_features", CHAIN + "SELECT f.bucket, " + R6("coalesce(x.n_sys_requests, 0.0)", "n_requests") +
          ", " + R6("coalesce(x.error_rate, 0.0)", "error_rate") + ", " +
          R6("coalesce(x.n_unique_ips, 0.0)", "n_unique_ips") +
          " FROM flagged f LEFT JOIN features x USING (bucket)")
def q_anomaly_features(spark, sf_dir):
    """Each anomaly's feature row values (0 when absent)."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    a = with_bucket_context(ch.flagged(), ch.features, [])
    return present(a.select("bucket", "n_requests", "error_rate", "n_unique_ips"))


@register("q_top_ip", MSG + "SELECT bucket, top_ip FROM topip")
def q_top_ip(spark, sf_dir):
    """Most frequent source IP of each anomalous bucket (ties: smallest)."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    sysc, _ = cleaned(spark, sf_dir, B)
    return top_value_per_bucket(sysc, "sourceip", [], ch.flagged()).withColumnRenamed(
        "value", "top_ip")


@register("q_bucket_log_ids", CHAIN + IDS_SQL + "SELECT bucket, side, rank, _id FROM ids")
def q_bucket_log_ids(spark, sf_dir):
    """First 50 system and LLM log ids of each anomalous bucket."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    sysc, llmc = cleaned(spark, sf_dir, B)
    out = None
    for side, df in (("system", sysc), ("llm", llmc)):
        ids = ids_in_bucket(df, [], ch.flagged()).select(
            "bucket", F.lit(side).alias("side"), F.posexplode("ids").alias("pos", "_id"))
        ids = ids.select("bucket", "side", (F.col("pos") + 1).alias("rank"), "_id")
        out = ids if out is None else out.unionByName(ids)
    return out


DETAILS_SQL = MSG + IDS_SQL + f"""
SELECT a.bucket, (SELECT count(*) FROM td WHERE td.bucket = a.bucket) AS n_top,
  a.t_feature AS top_feature,
  (SELECT count(*) FROM ids WHERE ids.bucket = a.bucket AND side = 'system') AS n_sys_ids,
  (SELECT count(*) FROM ids WHERE ids.bucket = a.bucket AND side = 'llm') AS n_llm_ids,
  {R6(HE('x.n_sys_requests', 4), 'snap_n_sys_requests')},
  {R6(HE('x.total_llm_cost', 4), 'snap_total_llm_cost')}
FROM anom_r a LEFT JOIN features x USING (bucket)"""


@register("q_details_json", DETAILS_SQL)
def q_details_json(spark, sf_dir):
    """Details encoded to JSON and decoded back, fields compared."""
    rec = anomaly_records(spark, sf_dir, B)
    dec = rec.select("bucket_start", AU.decode_details(F.col("details_json")).alias("d"))
    return present(dec.select(
        F.col("bucket_start").alias("bucket"),
        F.size("d.top_deviations").cast("bigint").alias("n_top"),
        F.get(F.col("d.top_deviations"), 0)["feature"].alias("top_feature"),
        F.size("d.sys_log_ids").cast("bigint").alias("n_sys_ids"),
        F.size("d.llm_log_ids").cast("bigint").alias("n_llm_ids"),
        F.col("d.feature_snapshot")["n_sys_requests"].alias("snap_n_sys_requests"),
        F.col("d.feature_snapshot")["total_llm_cost"].alias("snap_total_llm_cost")))


RECORDS_SQL = MSG + f"""
SELECT sha256(CAST(bucket AS VARCHAR)) AS anomaly_id, bucket + INTERVAL 60 MINUTE AS detected_at,
  bucket AS bucket_start, anomaly_type, severity, {R6('anomaly_score', 'anomaly_score')},
  CAST(n_req AS INTEGER) AS n_requests, CAST(coalesce(x.n_unique_ips, 0) AS INTEGER) AS n_unique_ips,
  {R6('err', 'error_rate')}, tip AS top_ip, substr(reason, 1, 500) AS reason,
  substr(attack_category, 1, 100) AS attack_category, false AS hst_confirmed
FROM msgs LEFT JOIN features x USING (bucket)"""


@register("q_anomaly_records", RECORDS_SQL)
def q_anomaly_records(spark, sf_dir):
    """K6, P25: the ANOMALIES rows (deterministic ids, evidence, nested details)."""
    rec = anomaly_records(spark, sf_dir, B)
    return present(rec.select(
        "anomaly_id", "detected_at", "bucket_start", "anomaly_type", "severity", "anomaly_score",
        "n_requests", "n_unique_ips", "error_rate",
        F.coalesce("top_ip", F.lit("N/A")).alias("top_ip"), "reason", "attack_category",
        "hst_confirmed"))


@register("q_anomaly_summary", CHAIN + "SELECT anomaly_type, severity, count(*) AS count "
          "FROM anom GROUP BY ALL")
def q_anomaly_summary(spark, sf_dir):
    """Anomalies per (type, severity)."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    return AU.summary_counts(ch.anomalies())


WORST_SQL = CHAIN + f""",
w AS (SELECT a.*, a.bucket + INTERVAL 60 MINUTE AS detected_at FROM anom a),
w2 AS (SELECT * FROM w WHERE detected_at >= TIMESTAMP '{FIXED_NOW}' - INTERVAL 720 HOUR
       ORDER BY anomaly_score, bucket LIMIT 10)
SELECT bucket AS bucket_start, {R6('anomaly_score', 'anomaly_score')}, severity,
  CASE severity WHEN 'HIGH' THEN '!!!!' WHEN 'MEDIUM' THEN '!! ' WHEN 'LOW' THEN '!  ' ELSE '   ' END AS mark,
  repeat('█', CAST(trunc(abs(t_z) / 5.0 * 20) AS INTEGER)) ||
  repeat('░', 20 - CAST(trunc(abs(t_z) / 5.0 * 20) AS INTEGER)) AS top_bar
FROM w2"""


@register("q_worst_anomalies", WORST_SQL)
def q_worst_anomalies(spark, sf_dir):
    """The 10 worst anomalies of the last 30 days (a top-N report)."""
    rec = anomaly_records(spark, sf_dir, B)
    recent = TB.scan_recent_anomalies(rec, FIXED_NOW, 720)
    top = AU.worst(recent, 10)
    z1 = F.get(F.col("top_deviations"), 0)["z_score"]
    return present(top.select("bucket_start", "anomaly_score", "severity",
                              AU.severity_mark(F.col("severity")).alias("mark"),
                              AU.bar(F.abs(z1)).alias("top_bar")))


AUDIT_SQL = MSG + IDS_SQL + """,
shown AS (SELECT bucket, side, _id FROM ids WHERE rank <= 30)"""


@register("q_anomaly_logs", AUDIT_SQL + """
SELECT s.bucket AS bucket_start, y._id, y."timestamp", y.logtype, y.http_status_code,
  CASE WHEN y.is_security_event THEN 1 ELSE 0 END AS is_security_event
FROM shown s JOIN sys y ON y._id = s._id WHERE s.side = 'system'""")
def q_anomaly_logs(spark, sf_dir):
    """The stored system logs behind each anomaly (first 30 ids)."""
    rec = anomaly_records(spark, sf_dir, B)
    system, _ = logs(spark, sf_dir)
    table = align_to(system, schemas.SYSTEM_LOGS)
    out = AU.logs_of_anomalies(rec.select("anomaly_id", "bucket_start",
                                          F.col("details.sys_log_ids").alias("ids")), table, "ids")
    return present(out.select("bucket_start", "_id", "timestamp", "logtype",
                              F.col("http_status_code").cast("double").alias("http_status_code"),
                              "is_security_event").orderBy("timestamp"))


@register("q_log_value_counts", AUDIT_SQL + """,
sl AS (SELECT s.bucket, y.* FROM shown s JOIN sys y ON y._id = s._id WHERE s.side = 'system'),
ll AS (SELECT s.bucket, y.* FROM shown s JOIN llm y ON y._id = s._id WHERE s.side = 'llm'),
ltc AS (SELECT bucket, 'logtype' AS dim, logtype AS value, count(*) AS n FROM sl GROUP BY ALL),
hc AS (SELECT * FROM (SELECT bucket, 'http_status_code' AS dim, CAST(CAST(http_status_code AS BIGINT) AS VARCHAR) AS value,
         count(*) AS n FROM sl WHERE http_status_code IS NOT NULL GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY n DESC, value) <= 5),
fr AS (SELECT bucket, 'llm_finish_reason' AS dim, llm_finish_reason AS value, count(*) AS n FROM ll GROUP BY ALL)
SELECT * FROM ltc UNION ALL SELECT * FROM hc UNION ALL SELECT * FROM fr""")
def q_log_value_counts(spark, sf_dir):
    """Log type counts, top-5 HTTP codes and finish reasons of each anomaly's logs."""
    rec = anomaly_records(spark, sf_dir, B)
    system, llm = logs(spark, sf_dir)
    sl = AU.logs_of_anomalies(rec.select("anomaly_id", "bucket_start",
                                         F.col("details.sys_log_ids").alias("ids")), system, "ids")
    ll = AU.logs_of_anomalies(rec.select("anomaly_id", "bucket_start",
                                         F.col("details.llm_log_ids").alias("ids")), llm, "ids")
    sl = sl.withColumnRenamed("bucket_start", "bucket")
    ll = ll.withColumnRenamed("bucket_start", "bucket")
    lt = AU.value_counts(sl, ["bucket"], "logtype").select(
        "bucket", F.lit("logtype").alias("dim"), F.col("logtype").alias("value"), "n")
    sl2 = sl.withColumn("code", F.col("http_status_code").cast("bigint").cast("string"))
    hc = AU.value_counts(sl2, ["bucket"], "code", top_n=5).select(
        "bucket", F.lit("http_status_code").alias("dim"), F.col("code").alias("value"), "n")
    fr = AU.value_counts(ll, ["bucket"], "llm_finish_reason").select(
        "bucket", F.lit("llm_finish_reason").alias("dim"), F.col("llm_finish_reason").alias("value"), "n")
    return lt.unionByName(hc).unionByName(fr)


ALL_LOGS_SQL = MSG + """,
sl AS (SELECT y.* FROM flagged f JOIN sysc y USING (bucket)),
ll AS (SELECT y.* FROM flagged f JOIN llmc y USING (bucket))"""


def _logs_of_buckets(spark, sf_dir):
    rec = anomaly_records(spark, sf_dir, B)
    system, llm = cleaned(spark, sf_dir, B)
    return rec, AU.logs_in_anomalies(rec, system), AU.logs_in_anomalies(rec, llm)


@register("q_anomaly_value_counts", ALL_LOGS_SQL + """
SELECT bucket, 'logtype' AS dim, logtype AS value, count(*) AS n FROM sl GROUP BY ALL
UNION ALL SELECT * FROM (SELECT bucket, 'http_status_code', code, n FROM (
    SELECT bucket, CAST(CAST(http_status_code AS BIGINT) AS VARCHAR) AS code, count(*) AS n FROM sl WHERE http_status_code IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY n DESC, code) <= 5)
UNION ALL SELECT bucket, 'llm_finish_reason', llm_finish_reason, count(*) FROM ll WHERE llm_finish_reason IS NOT NULL GROUP BY ALL""")
def q_anomaly_value_counts(spark, sf_dir):
    """Log types, top-5 HTTP codes and finish reasons over all logs of each anomaly's bucket."""
    _, sl, ll = _logs_of_buckets(spark, sf_dir)
    sl = sl.withColumn("code", F.col("http_status_code").cast("bigint").cast("string"))
    out = None
    for rows, col, dim, top in ((sl, "logtype", "logtype", None), (sl, "code", "http_status_code", 5),
                                (ll, "llm_finish_reason", "llm_finish_reason", None)):
        part = AU.value_counts(rows, ["bucket"], col, top_n=top).select(
            "bucket", F.lit(dim).alias("dim"), F.col(col).alias("value"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@register("q_anomaly_totals", ALL_LOGS_SQL + """,
a AS (SELECT bucket, count(*) AS n_sys_logs, count_if(is_security_event) AS n_security FROM sl GROUP BY bucket),
b AS (SELECT bucket, count(*) AS n_llm_logs, CAST(sum(CAST(llm_cost_usd AS DECIMAL(28,10))) AS DOUBLE) AS cost FROM ll GROUP BY bucket)
SELECT f.bucket, CAST(coalesce(a.n_sys_logs, 0) AS BIGINT) AS n_sys_logs, CAST(coalesce(a.n_security, 0) AS BIGINT) AS n_security,
  CAST(coalesce(b.n_llm_logs, 0) AS BIGINT) AS n_llm_logs, """ + R6("coalesce(b.cost, 0.0)", "total_cost") + """
FROM flagged f LEFT JOIN a USING (bucket) LEFT JOIN b USING (bucket)""")
def q_anomaly_totals(spark, sf_dir):
    """Logs, security events and cost over all logs of each anomaly's bucket."""
    rec, sl, ll = _logs_of_buckets(spark, sf_dir)
    got = rec.select(F.col("bucket_start").alias("bucket")).join(AU.log_totals(sl, ll), "bucket", "left")
    return present(got.fillna(0).select("bucket", *[F.col(c).cast("long").alias(c) for c in (
        "n_sys_logs", "n_security", "n_llm_logs")], "total_cost"))


@register("q_anomaly_log_totals", AUDIT_SQL + """,
sl AS (SELECT s.bucket, y.* FROM shown s JOIN sys y ON y._id = s._id WHERE s.side = 'system'),
ll AS (SELECT s.bucket, y.* FROM shown s JOIN llm y ON y._id = s._id WHERE s.side = 'llm'),
a AS (SELECT bucket, count(*) AS n_sys_logs,
      count_if(lower(CAST(CASE WHEN is_security_event THEN 1 ELSE 0 END AS VARCHAR)) IN ('1', 'true')) AS n_security
      FROM sl GROUP BY bucket),
b AS (SELECT bucket, count(*) AS n_llm_logs, sum(llm_cost_usd) AS cost FROM ll GROUP BY bucket)
SELECT f.bucket, CAST(coalesce(a.n_sys_logs, 0) AS BIGINT) AS n_sys_logs,
  CAST(coalesce(a.n_security, 0) AS BIGINT) AS n_security, CAST(coalesce(b.n_llm_logs, 0) AS BIGINT) AS n_llm_logs,
  """ + R6("coalesce(b.cost, 0.0)", "total_cost") + """
FROM flagged f LEFT JOIN a USING (bucket) LEFT JOIN b USING (bucket)""")
def q_anomaly_log_totals(spark, sf_dir):
    """Security-event count and LLM cost over each anomaly's shown logs."""
    rec = anomaly_records(spark, sf_dir, B)
    system, llm = logs(spark, sf_dir)
    st = align_to(system, schemas.SYSTEM_LOGS)
    sl = AU.logs_of_anomalies(rec.select("anomaly_id", "bucket_start",
                                         F.col("details.sys_log_ids").alias("ids")), st, "ids")
    ll = AU.logs_of_anomalies(rec.select("anomaly_id", "bucket_start",
                                         F.col("details.llm_log_ids").alias("ids")), llm, "ids")
    a = sl.groupBy("bucket_start").agg(
        F.count(F.lit(1)).alias("n_sys_logs"),
        F.count_if(AU.truthy_any(F.col("is_security_event"))).alias("n_security"))
    b = ll.groupBy("bucket_start").agg(F.count(F.lit(1)).alias("n_llm_logs"),
                                       F.sum("llm_cost_usd").alias("total_cost"))
    out = (rec.select("bucket_start").join(a, "bucket_start", "left").join(b, "bucket_start", "left")
           .fillna(0, subset=["n_sys_logs", "n_security", "n_llm_logs"])
           .fillna(0.0, subset=["total_cost"]))
    return present(out.select(F.col("bucket_start").alias("bucket"), "n_sys_logs", "n_security",
                              "n_llm_logs", "total_cost"))


SHARE_SQL = CHAIN + """,
u AS (SELECT 'attack_category' AS dim, attack_category AS value FROM anom
      UNION ALL SELECT 'anomaly_type', anomaly_type FROM anom
      UNION ALL SELECT 'day', CAST(CAST(bucket AS DATE) AS VARCHAR) FROM anom),
c AS (SELECT dim, value, count(*) AS n FROM u GROUP BY ALL)
SELECT dim, value, n, """ + R6("CAST(n AS DOUBLE) / (SELECT count(*) FROM anom)", "share") + " FROM c"


@register("q_category_share", SHARE_SQL)
def q_category_share(spark, sf_dir):
    """Anomalies per category, per type and per day, with their share."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    a = ch.anomalies().withColumn("day", F.to_date("bucket").cast("string"))
    out = None
    for dim in ("attack_category", "anomaly_type", "day"):
        s = AU.category_share(a, dim)
        out = s if out is None else out.unionByName(s)
    return present(out)


# ---- liveness and retention ----------------------------------------------------
HB_NAMES = ["main_pipeline", "ml_pipeline", "export_pipeline"]


def heartbeats(spark, sf_dir):
    """Pulses derived from events: one per (pipeline, hour) at the hour's last event."""
    ev = read_table(spark, sf_dir, "events")
    pid = F.element_at(F.array(*[F.lit(n) for n in HB_NAMES]), (F.col("user_id") % 3 + 1).cast("int"))
    hb = (ev.select(pid.alias("pipeline_id"), F.col("ts"),
                    F.window("ts", "1 hour").start.alias("hour"))
          .groupBy("pipeline_id", "hour").agg(F.max("ts").alias("sent_at")))
    return hb.select("pipeline_id", "sent_at", F.lit("host-1").alias("pipeline_host"),
                     F.col("hour").cast("string").alias("last_window_start"))


HB_SQL = f"""WITH hb0 AS (SELECT CASE user_id % 3 WHEN 0 THEN 'main_pipeline' WHEN 1 THEN 'ml_pipeline'
  ELSE 'export_pipeline' END AS pipeline_id, ts, time_bucket(INTERVAL '1 hour', ts) AS hour FROM events),
hb AS (SELECT pipeline_id, hour, max(ts) AS sent_at FROM hb0 GROUP BY ALL),
last AS (SELECT pipeline_id, max(sent_at) AS sent_at FROM hb GROUP BY pipeline_id),
l2 AS (SELECT *, CAST(date_diff('microsecond', sent_at, TIMESTAMP '{FIXED_NOW}') AS DOUBLE) / 1e6 AS lag FROM last)
SELECT pipeline_id, sent_at, {R6('lag', 'lag_s')}, CASE WHEN sent_at IS NULL THEN 'none' WHEN lag > 180 THEN 'stale'
  ELSE 'fresh' END AS state, pipeline_id = 'main_pipeline' AS is_main FROM l2"""


@register("q_latest_heartbeat", HB_SQL)
def q_latest_heartbeat(spark, sf_dir):
    """Latest pulse per pipeline and its lag against a fixed now."""
    hb = heartbeats(spark, sf_dir)
    now = F.lit(FIXED_NOW).cast("timestamp_ntz")
    lv = LV.liveness(hb, now)
    main = TB.scan_pipeline(lv, C.PIPELINE_ID).select("pipeline_id", F.lit(True).alias("m"))
    out = lv.join(main, "pipeline_id", "left")
    return present(out.select("pipeline_id", "sent_at", "lag_s", "state",
                              F.coalesce("m", F.lit(False)).alias("is_main")))


def versions(spark, sf_dir):
    """One saved model per day with data: version = 'YYYYMMDD_000000'."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.date_format(F.to_date("ts"), "yyyyMMdd").alias("d")).distinct().select(
        F.concat("d", F.lit("_000000")).alias("version"))


VER_SQL = """WITH v AS (SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y%m%d') || '_000000' AS version FROM events)"""


@register("q_expired_versions", VER_SQL + """
SELECT version, row_number() OVER (ORDER BY version DESC) AS recency,
  row_number() OVER (ORDER BY version DESC) > 3 AS expired FROM v""")
def q_expired_versions(spark, sf_dir):
    """Model versions beyond the newest three."""
    return LV.expired_versions(versions(spark, sf_dir)).select("version", "recency", "expired")


@register("q_latest_version", VER_SQL + " SELECT max(version) AS latest_version FROM v")
def q_latest_version(spark, sf_dir):
    """T5: the newest model version."""
    return LV.latest_version(versions(spark, sf_dir))


CYCLES_SQL = O.with_(O.oracle_raw_logs_cte()) + """,
lim AS (SELECT time_bucket(INTERVAL '30 minute', min(event_ts)) AS lo, time_bucket(INTERVAL '30 minute', max(event_ts)) AS hi FROM raw_logs),
cyc AS (SELECT unnest(generate_series(lo, hi, INTERVAL '30 minute')) AS cycle FROM lim),
cnt AS (SELECT time_bucket(INTERVAL '30 minute', event_ts) AS cycle, count(*) AS n FROM raw_logs GROUP BY 1),
j AS (SELECT c.cycle, CAST(coalesce(n.n, 0) AS BIGINT) AS new_rows FROM cyc c LEFT JOIN cnt n USING (cycle)),
l AS (SELECT *, row_number() OVER (ORDER BY cycle) AS pos FROM j),
k AS (SELECT *, coalesce(max(CASE WHEN new_rows > 0 THEN pos END) OVER (ORDER BY cycle), 0) AS last_full FROM l)
SELECT cycle, new_rows, new_rows = 0 AND (pos - last_full) % 2 = 0 AS retention_due
FROM k"""


@register("q_empty_runs", CYCLES_SQL)
def q_empty_runs(spark, sf_dir):
    """Cycles (30 min) whose run of two empty cycles triggers local retention."""
    from ..sources.fixture import raw_logs
    raw = raw_logs(spark, sf_dir)
    c = raw.select(F.window("event_ts", "30 minutes").start.alias("cycle"))
    counts = c.groupBy("cycle").agg(F.count(F.lit(1)).alias("new_rows"))
    lim = c.agg(F.min("cycle").alias("lo"), F.max("cycle").alias("hi"))
    grid = lim.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 30 MINUTES"))).alias("cycle"))
    j = grid.join(counts, "cycle", "left").fillna(0, subset=["new_rows"])
    return LV.empty_cycle_runs(j).select("cycle", "new_rows", "retention_due")
