"""Registered queries, steps 5-6: forest, half-space trees, detector combination."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import baseline as BL
from ..operators import hst as HS
from ..operators import iforest as IF
from ..operators.combine import combine_flags
from . import detector_oracles as DO
from . import oracle as O
from .common import QUERY_BUCKET, present
from .detect import z_chain
from .detect_queries import CHAIN, THRESHOLD

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


def forest_scores(spark, sf_dir):
    """Fit on the baseline matrix (M1-scaled vectors), score every bucket."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    vec = BL.feature_vector(ch.features, ch.base)
    forest = IF.fit(vec)
    return IF.score(vec, forest)


@register("q_iforest_scores", DO.with_detectors(B, DO.forest_ctes()) + O.select_rounded(
    ["bucket", "anomaly_score"], {"anomaly_score"}, "ifs"))
def q_iforest_scores(spark, sf_dir):
    """M3, M4: isolation-forest score of every bucket."""
    return present(forest_scores(spark, sf_dir))


@register("q_iforest_flags", DO.with_detectors(B, DO.forest_ctes()) + O.select_rounded(
    ["bucket", "anomaly_score", "prediction"], {"anomaly_score"}, "ifp", "WHERE prediction = -1"))
def q_iforest_flags(spark, sf_dir):
    """M5: buckets scored below the 5 % quantile of the training scores."""
    sc = forest_scores(spark, sf_dir)
    pred = IF.predict(sc, IF.offset(sc))
    return present(pred.where(F.col("prediction") == -1).select("bucket", "anomaly_score",
                                                                 "prediction"))


@register("q_hst_scores", DO.with_detectors(B, DO.hst_ctes()) + O.select_rounded(
    ["bucket", "hst_score", "warm", "hst_flag"], {"hst_score"}, "hst"))
def q_hst_scores(spark, sf_dir):
    """Half-space-tree score per bucket, warm-up flag and HST flag."""
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    inputs = HS.scaled_inputs(ch.features, HS.baseline_minmax(ch.features))
    return present(HS.score_batch(inputs))


CONF_SQL = CHAIN + f""",
p AS (SELECT quantile_cont(n_sys_requests, 0.95) AS p95 FROM features),
ord AS (SELECT bucket, n_sys_requests, row_number() OVER (ORDER BY bucket) AS idx FROM features),
vol AS (SELECT bucket, n_sys_requests > p.p95 AND idx > {C.HST_WINDOW} AS flag FROM ord, p),
fl AS (SELECT coalesce(d.bucket, v.bucket) AS bucket, coalesce(d.is_anomaly, false) AS if_flag,
       coalesce(v.flag, false) AS hst_flag FROM det d FULL OUTER JOIN vol v USING (bucket))
SELECT bucket, if_flag, hst_flag, if_flag AND hst_flag AS hst_confirmed,
  CASE WHEN if_flag AND hst_flag THEN 'HIGH' WHEN if_flag THEN 'IFOREST_ONLY' ELSE 'HST_ONLY' END AS confidence
FROM fl WHERE if_flag OR hst_flag"""


@register("q_confidence", CONF_SQL)
def q_confidence(spark, sf_dir):
    """Two detectors combined (deterministic stand-ins).

    Forest side: the z detector; online side: volume above its p95, gated by
    the warm-up (the first window of buckets never flags).
    """
    ch = z_chain(spark, sf_dir, B, threshold=THRESHOLD)
    a = ch.detector.select("bucket", F.col("is_anomaly").alias("flag"))
    p95 = ch.features.agg(F.percentile("n_sys_requests", 0.95).alias("p95"))
    from ..operators.classify import join_per_key
    idx = F.row_number().over(Window.orderBy("bucket"))
    vol = join_per_key(ch.features.select("bucket", "n_sys_requests").withColumn("idx", idx), p95, [])
    b = vol.select("bucket", ((F.col("n_sys_requests") > F.col("p95")) &
                              (F.col("idx") > C.HST_WINDOW)).alias("flag"))
    return combine_flags(a, b, [])


def land_tables(spark, sf_dir, bucket_dir: str):
    """Derived logs upserted into keyed SYSTEM/LLM tables under a shared folder."""
    from .. import schemas
    from ..schemas import align_to
    from ..sinks.tables import merge_into
    from .common import logs
    system, llm = logs(spark, sf_dir)
    merge_into(spark, f"{bucket_dir}/system_logs", align_to(system, schemas.SYSTEM_LOGS))
    merge_into(spark, f"{bucket_dir}/llm_logs", align_to(llm, schemas.LLM_LOGS))


def _records_sql() -> str:
    """The records oracle with the forest's flags, and the online detector's confirmation."""
    from .store_queries import RECORDS_SQL
    sql = RECORDS_SQL.replace("WITH ", "WITH RECURSIVE ", 1)
    for old, new in (
            ("flagged AS (SELECT bucket, anomaly_score FROM det WHERE is_anomaly)", ",\n".join([
                DO.hst_ctes(), DO.forest_ctes(), "flagged AS (SELECT bucket, anomaly_score FROM ifp WHERE prediction = -1)"])),
            (" bucket + INTERVAL 60 MINUTE AS detected_at,", ""),
            ("false AS hst_confirmed", "coalesce(h.hst_flag AND h.warm, false) AS hst_confirmed"),
            ("FROM msgs LEFT JOIN features x USING (bucket)", "FROM msgs LEFT JOIN features x USING (bucket) LEFT JOIN hst h USING (bucket)")):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


def _record_columns(records):
    return records.select(
        "anomaly_id", "bucket_start", "anomaly_type", "severity", "anomaly_score", "n_requests",
        "n_unique_ips", "error_rate", F.coalesce("top_ip", F.lit("N/A")).alias("top_ip"), "reason",
        "attack_category", "hst_confirmed")


@register("q_detect_cycle", _records_sql())
def q_detect_cycle(spark, sf_dir):
    """End-to-end cycle on the keyed tables: forest + HST, records, outbox."""
    import uuid
    from ..session import shared_dir
    from ..sources.fixture import FIXED_NOW
    from .cycle import detect_cycle
    base = shared_dir(spark, f"cycle/{uuid.uuid4().hex}")
    land_tables(spark, sf_dir, f"{base}/tables")
    res = detect_cycle(spark, f"{base}/tables", f"{base}/models", FIXED_NOW, cycle=1, bucket=B,
                       training_hours=24 * 31, fresh_since="2024-01-01 00:00:00")
    return present(_record_columns(res.records))


def landed(spark, sf_dir, path: str):
    """The derived logs as landed pages of 100 events."""
    from ..sinks.files import land_pages
    from ..sources.fixture import raw_logs
    raw = raw_logs(spark, sf_dir).withColumnRenamed("event_ts", "@timestamp")
    page = (F.floor(F.split("_id", "-").getItem(1).cast("bigint") / 100) + 1).cast("int")
    land_pages(raw.withColumn("page", page), path)


@register("q_stream_anomalies", _records_sql())
def q_stream_anomalies(spark, sf_dir):
    """Records that the stream upserts, judged by the model of a cycle; the
    first page is delivered once more at the end, as a batch of its own."""
    import uuid
    from ..session import shared_dir
    from ..sources.fixture import FIXED_NOW
    from ..sources.pages import page_texts
    from ..streaming.job import run_ingest
    from .cycle import detect_cycle
    base = shared_dir(spark, f"stream/{uuid.uuid4().hex}")
    land_tables(spark, sf_dir, f"{base}/trained")
    detect_cycle(spark, f"{base}/trained", f"{base}/models", FIXED_NOW, cycle=1, bucket=B,
                 training_hours=24 * 31, fresh_since="2024-01-01 00:00:00")
    landed(spark, sf_dir, f"{base}/landing")
    for again in (False, True):
        if again:
            # (repartition, not coalesce: that would read the whole landing directory in one task)
            (page_texts(spark, f"{base}/landing").where("page = 1").select("value").repartition(1)
             .write.mode("append").text(f"{base}/landing"))
        run_ingest(spark, f"{base}/landing", f"{base}/tables", f"{base}/cp", bucket=B,
                   models=f"{base}/models").awaitTermination()
    return present(_record_columns(spark.read.parquet(f"{base}/tables/anomalies")))


def outcomes(box):
    """What a consumer of the outbox brings back: by the first digit of the id, sent, refused, or no answer yet."""
    first = F.substring("anomaly_id", 1, 1)
    code = F.when(first < "8", 200).when(first < "c", 503)
    return (box.where("status = 'QUEUED'").where(first < "e").select(
        "anomaly_id", code.alias("http_status"), F.lit("ok").alias("api_response"),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("sent_at")))


def _outbox_sql(select: str) -> str:
    sql = _records_sql().replace("SELECT sha256(CAST(bucket AS VARCHAR)) AS anomaly_id",
                                 ",\nr AS (SELECT sha256(CAST(bucket AS VARCHAR)) AS anomaly_id", 1)
    categories = ", ".join("'" + c.replace("'", "''") + "'" for c in C.SECURITY_ALERT_CATEGORIES)
    return sql + f"""),
box AS (SELECT *, CASE WHEN severity <> 'LOW' AND attack_category IN ({categories}) THEN 'QUEUED' ELSE 'SKIPPED' END AS status FROM r)
{select}"""


@register("q_delivery_counters", _outbox_sql("""SELECT CASE WHEN status = 'SKIPPED' THEN 'SKIPPED'
  WHEN substr(anomaly_id, 1, 1) < '8' THEN 'SENT' WHEN substr(anomaly_id, 1, 1) < 'e' THEN 'FAILED' ELSE 'QUEUED' END AS status,
  count(*) AS n_alerts FROM box GROUP BY ALL"""))
def q_delivery_counters(spark, sf_dir):
    """Alerts sent, failed, queued and skipped, after a consumer has reported on the outbox."""
    import uuid
    from ..operators import alerts as AL
    from ..session import shared_dir
    from ..sinks.tables import merge_into
    from ..sources.fixture import FIXED_NOW
    from .cycle import detect_cycle
    base = shared_dir(spark, f"cycle/{uuid.uuid4().hex}")
    land_tables(spark, sf_dir, f"{base}/tables")
    res = detect_cycle(spark, f"{base}/tables", f"{base}/models", FIXED_NOW, cycle=1, bucket=B,
                       training_hours=24 * 31, fresh_since="2024-01-01 00:00:00")
    box = spark.read.parquet(f"{base}/tables/outbox")
    merge_into(spark, f"{base}/tables/alert_log", AL.delivered(res.outbox, outcomes(box)), key="alert_id",
               ts_col="bucket_start")
    return AL.delivery_counters(spark.read.parquet(f"{base}/tables/alert_log"), box)


@register("q_alert_outbox", _outbox_sql(
    "SELECT severity, attack_category, status, count(*) AS n FROM box GROUP BY ALL"))
def q_alert_outbox(spark, sf_dir):
    """K8: the outbox table of a cycle, by severity, category and status."""
    import uuid
    from ..session import shared_dir
    from ..sources.fixture import FIXED_NOW
    from .cycle import detect_cycle
    base = shared_dir(spark, f"cycle/{uuid.uuid4().hex}")
    land_tables(spark, sf_dir, f"{base}/tables")
    detect_cycle(spark, f"{base}/tables", f"{base}/models", FIXED_NOW, cycle=1, bucket=B,
                 training_hours=24 * 31, fresh_since="2024-01-01 00:00:00")
    return (spark.read.parquet(f"{base}/tables/outbox").groupBy("severity", "attack_category", "status")
            .agg(F.count(F.lit(1)).alias("n")))


@register("q_stream_features", O.base_ctes(B) + O.select_rounded(
    ["bucket", *C.FEATURE_COLS], set(C.FEATURE_COLS), "features"))
def q_stream_features(spark, sf_dir):
    """The streaming ingest (availableNow over landed pages):
    keyed upserts per micro-batch, then the features of the touched buckets
    recomputed from the keyed tables."""
    import uuid
    from pyspark.sql import functions as F2
    from ..session import shared_dir
    from ..sinks.files import land_pages
    from ..sources.fixture import raw_logs
    from ..streaming.job import latest_features, run_ingest
    base = shared_dir(spark, f"stream/{uuid.uuid4().hex}")
    raw = raw_logs(spark, sf_dir).withColumnRenamed("event_ts", "@timestamp")
    page = (F2.floor(F2.split("_id", "-").getItem(1).cast("bigint") / 100) + 1).cast("int")
    land_pages(raw.withColumn("page", page), f"{base}/landing")
    q = run_ingest(spark, f"{base}/landing", f"{base}/tables", f"{base}/cp", bucket=B)
    q.awaitTermination()
    return present(latest_features(spark, f"{base}/tables").select("bucket", *C.FEATURE_COLS))


@register("q_stream_windows", O.base_ctes(B) + """,
line AS (SELECT max(ts) - INTERVAL 30 MINUTE AS wm FROM (
  SELECT "timestamp" AS ts FROM sys UNION ALL SELECT "timestamp" FROM llm)) """ + O.select_rounded(
    ["bucket", *C.FEATURE_COLS], set(C.FEATURE_COLS), "features",
    "WHERE bucket + INTERVAL 1 HOUR <= (SELECT wm FROM line)"))
def q_stream_windows(spark, sf_dir):
    """All window features by chained stateful aggregations, of the buckets that the watermark has closed."""
    import uuid
    from ..session import shared_dir
    from ..sinks.files import land_pages
    from ..sources.fixture import raw_logs
    from ..sources.pages import stream_pages
    from ..streaming.windows import stream_features
    base = shared_dir(spark, f"stream/{uuid.uuid4().hex}")
    raw = raw_logs(spark, sf_dir).withColumnRenamed("event_ts", "@timestamp")
    page = (F.floor(F.split("_id", "-").getItem(1).cast("bigint") / 100) + 1).cast("int")
    land_pages(raw.withColumn("page", page), f"{base}/landing")
    feats = stream_features(stream_pages(spark, f"{base}/landing"), B, "30 minutes")
    (feats.writeStream.format("parquet").option("path", f"{base}/features").option("checkpointLocation", f"{base}/cp")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return present(spark.read.parquet(f"{base}/features"))
