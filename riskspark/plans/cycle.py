"""One detection cycle over the keyed tables (the batch job behind each trigger),
and its second half, which the stream uses too.

gate (F13) -> train window (S6) / fresh window or catch-up (S7, F15) ->
features (A1-A21) -> baseline (A26) -> fit or reuse the forest (W7, M3, K13,
M13) -> score + predict (M4, M5) -> half-space trees (M10) -> combine (M12)
-> explain and classify (M6-M9) -> anomaly records (K6) -> outbox (K8, K7)
-> progress (K14) -> model retention (W6).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..operators import alerts as AL
from ..operators import baseline as BL
from ..operators import classify as CL
from ..operators import hst as HS
from ..operators import iforest as IF
from ..operators.combine import combine_flags
from ..operators.features import build_features
from ..operators.liveness import expired_versions
from ..operators.prepare import clean_llm, clean_system
from ..operators.spans import catchup_gap, data_span, zone_span
from ..operators.util import materialize, same_keys
from ..sinks import keyindex
from ..sinks import tables as ST
from ..sinks.published import current
from ..sources import tables as TB
from .detect import run_gap_minutes
from .records import build_records


#: Fresh logs of the first cycle: one ingest interval.
FRESH_MINUTES = 30


@dataclass
class CycleResult:
    ready: bool
    retrained: bool
    version: str | None
    records: DataFrame | None
    outbox: DataFrame | None
    confidence: DataFrame | None


@dataclass
class Model:
    """What a trained version has: a row per node, per feature, and per key (twice)."""
    version: str
    forest: DataFrame
    base: DataFrame
    offset: DataFrame
    limits: DataFrame


def load_model(spark: SparkSession, models: str) -> Model | None:
    """The version that was published last."""
    latest = ST.load_latest_model(spark, models)
    if latest is None:
        return None
    version, forest, base = latest
    return Model(version, forest, base, *[ST.model_table(spark, models, t, version) for t in ("offset", "limits")])


@dataclass
class Judged:
    """Buckets judged by both detectors: all scores, what is flagged, records, alerts, the state after."""
    scores: DataFrame
    confidence: DataFrame
    records: DataFrame
    outbox: DataFrame
    hst_state: DataFrame


def judge(features: DataFrame, system: DataFrame, llm: DataFrame, model: Model, hst_state: DataFrame | None,
          bucket: str, keys: list[str] | None = None, judged_before: DataFrame | None = None) -> Judged:
    """Score feature rows against a model and explain what is flagged.

    ``system``, ``llm``: the logs of those buckets.  The online detector goes on
    from ``hst_state`` and learns the buckets that come after what it has learned;
    the others keep what it said of them when it learned them (``judged_before``:
    keys, bucket, hst_score, warm, hst_flag).
    """
    spark, keys = features.sparkSession, list(keys or [])
    k = [*keys, "bucket"]
    scores = IF.score(BL.feature_vector(features, model.base, keys), model.forest, keys=keys)
    pred = materialize(IF.predict(scores, model.offset, keys))
    hst, state = HS.learn_and_score(HS.scaled_inputs(features, model.limits, keys), hst_state, keys)
    hst = materialize(hst)
    if judged_before is not None:
        old = same_keys(judged_before, features.select(*k), k, "left_semi")
        hst = hst.unionByName(same_keys(old, hst.select(*k), k, "left_anti").select(*hst.columns))
    conf = combine_flags(pred.select(*k, (F.col("prediction") == -1).alias("flag")),
                         hst.select(*k, (F.col("hst_flag") & F.col("warm")).alias("flag")), keys)
    flagged = pred.where(F.col("prediction") == -1).select(*k, "anomaly_score")
    top = BL.top_deviations(BL.zscore_arrays(features, model.base, keys), keys)
    anoms = CL.classify(flagged, features, top, BL.train_stats(model.base, keys), CL.rules_frame(spark),
                        keys, run_gap_minutes(bucket))
    records = build_records(anoms, features, clean_system(system, bucket), clean_llm(llm, bucket), keys, bucket,
                            hst_flags=conf.select(*k, F.col("hst_confirmed").alias("hst_flag")))
    box = AL.outbox(records.withColumnRenamed("bucket_start", "bucket")
                    .withColumn("n_requests", F.col("n_requests").cast("double")))
    every = same_keys(pred, hst.select(*k, "hst_score", "warm", "hst_flag"), k, "left")
    return Judged(every.withColumn("model_version", F.lit(model.version)), conf, records, box, materialize(state))


def publish_alerts(spark: SparkSession, tables: str, judged: Judged, keys: list[str] | None = None) -> None:
    """K6-K8: records, the outbox and the alert log, keyed, so that a retry meets its own rows."""
    ST.merge_into(spark, f"{tables}/anomalies", judged.records.drop("details", "top_deviations"),
                  key="anomaly_id", ts_col="bucket_start")
    box = judged.outbox.select(*(keys or []), "anomaly_id", "bucket", "anomaly_type", "attack_category",
                               "severity", "message", "status")
    ST.merge_into(spark, f"{tables}/outbox", box, key="anomaly_id", ts_col="bucket")
    ST.merge_into(spark, f"{tables}/alert_log", AL.alert_log_rows(judged.outbox, keys=keys), key="alert_id",
                  ts_col="bucket_start")


def should_retrain(cycle: int, has_model: bool, every: int = C.RETRAIN_EVERY) -> bool:
    """No model yet, or every ``every``-th cycle (1, 3, 5, ... for 2)."""
    return (not has_model) or (cycle % every == 1)


def detect_cycle(spark: SparkSession, tables: str, models: str, now: str, cycle: int | None = None,
                 bucket: str = C.BUCKET, training_hours: float = C.TRAINING_HOURS,
                 fresh_since: str | None = None, last_scored_until: str | None = None,
                 min_training_hours: float = C.MIN_TRAINING_HOURS,
                 keys: list[str] | None = None) -> CycleResult:
    """One cycle; ``keys`` (e.g. environment) gives one model and series per key.

    What is not given comes from the stored progress: the cycle is the next one,
    and fresh logs are those since the last scored bucket (before the first cycle,
    those of the last ``FRESH_MINUTES``).  A cycle without fresh logs changes
    no record, alert or progress.
    """
    keys = list(keys or [])
    done, scored = ST.load_progress(spark, f"{tables}/progress")
    cycle = done + 1 if cycle is None else cycle
    last_scored_until = last_scored_until or scored
    fresh_since = fresh_since or last_scored_until or TB.hours_before(now, FRESH_MINUTES / 60)
    st = ST.read_table(spark, f"{tables}/system_logs", schemas.SYSTEM_LOGS)
    lt = ST.read_table(spark, f"{tables}/llm_logs", schemas.LLM_LOGS)
    zones = keyindex.zones(spark, f"{tables}/system_logs")     # (no row is read where the upsert has kept them)
    span = (data_span(st, min_training_hours) if zones is None else zone_span(zones, min_training_hours)).first()
    if not span or not span["ready"]:
        return CycleResult(False, False, None, None, None, None)

    since = TB.hours_before(now, training_hours)
    train_sys = TB.scan_since(st, since, TB.SYSTEM_SCAN_COLS)
    train_llm = TB.scan_since(lt, since, TB.LLM_SCAN_COLS)
    fresh_sys = TB.scan_since(st, fresh_since, TB.SYSTEM_SCAN_COLS)
    fresh_llm = TB.scan_since(lt, fresh_since, TB.LLM_SCAN_COLS)
    if last_scored_until:
        gap = catchup_gap(fresh_sys, fresh_llm, last_scored_until).first()
        if gap and gap["catch_up"]:
            fresh_sys = TB.scan_after(st, last_scored_until, TB.SYSTEM_SCAN_COLS)
            fresh_llm = TB.scan_after(lt, last_scored_until, TB.LLM_SCAN_COLS)

    f_train = materialize(build_features(train_sys, train_llm, bucket, keys))
    f_score = materialize(build_features(fresh_sys, fresh_llm, bucket, keys))
    if f_train.count() < 5:                               # F14
        return CycleResult(True, False, None, None, None, None)

    model = load_model(spark, models)
    version = now.replace("-", "").replace(":", "").replace(" ", "_")
    retrain = should_retrain(cycle, model is not None)
    if retrain and (model is None or model.version != version):  # (a retried cycle finds its model published)
        base = materialize(BL.baseline(f_train, keys))
        vectors = BL.feature_vector(f_train, base, keys)
        forest = materialize(IF.fit(vectors, keys=keys))
        off = materialize(IF.offset(IF.score(vectors, forest, keys=keys), keys=keys))
        ST.save_model(spark, models, version, forest, base,
                      {"training_hours": training_hours, "bucket": bucket, "n_features": len(C.FEATURE_COLS)},
                      offset=off, limits=HS.baseline_minmax(f_train, keys))
        vers = spark.read.parquet(f"{models}/meta").select(F.col("version").cast("string")).distinct()
        old = [r[0] for r in expired_versions(vers).where("expired").select("version").collect()]
        ST.drop_versions(spark, models, [v for v in old if v != version])       # W6 (a handful of names)
        model = load_model(spark, models)
    if f_score.isEmpty():
        return CycleResult(True, retrain, model.version, None, None, None)
    state = current(spark, f"{tables}/progress", "hst_state")
    judged = judge(f_score, fresh_sys, fresh_llm, model, state, bucket, keys)
    publish_alerts(spark, tables, judged, keys)
    last = f_score.agg(F.max("bucket")).first()[0]
    ST.save_progress(spark, f"{tables}/progress", cycle, last, hst_state=judged.hst_state)
    return CycleResult(True, retrain, model.version, judged.records, judged.outbox, judged.confidence)
