"""Structured Streaming job.

landed pages (file stream) -> flatten -> foreachBatch {
    malformed pages to a side table, split + flag, latest-wins upsert into the
    keyed SYSTEM/LLM tables (K1), recompute features of the touched buckets from
    the tables (late rows included), judge them by the published model and the
    online detector (plans.cycle.judge), upsert records, outbox and alert log } ;
the checkpoint makes the file offsets and every batch replayable, and the
keyed upserts make a replayed batch change nothing (X5).

A pure streaming variant of the features (X3), which drops rows after the
watermark instead of computing their buckets again, is ``streaming.windows``.
Half-space-tree state per (keys, tree) lives in ``applyInPandasWithState``
(X6, X7).
"""
from __future__ import annotations

import json
import socket
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import constants as C
from ..operators import hst as HS
from ..operators.features import build_features
from ..operators.prepare import flag_security, flatten, split_by_type
from ..operators.util import broadcast_if_small, materialize
from .. import schemas
from ..schemas import align_to
from ..plans.cycle import judge, load_model, publish_alerts
from ..sinks.published import history, publish
from ..sinks.tables import exists, merge_into, read_table, write_batch
from ..sources.pages import CORRUPT, FILE, POSITION, bad_documents, records_of, stream_documents


def pulse(spark: SparkSession, batch_id: int, status: str, last_window, table: str, started: float) -> None:
    """K9: the heartbeat of the pipeline, one row (S10, A24 read it)."""
    row = [(C.PIPELINE_ID, socket.gethostname(), int(batch_id), status, None if last_window is None else str(last_window),
            (time.time() - started) / 60)]
    beat = (spark.createDataFrame(row, "pipeline_id string, pipeline_host string, cycle int, status string, "
                                  "last_window_start string, uptime_min double")
            .withColumn("sent_at", F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                                                      F.current_timestamp().cast("timestamp_ntz"))))
    merge_into(spark, table, align_to(beat, schemas.HEARTBEAT), key="pipeline_id", ts_col="sent_at")


def state_before(spark: SparkSession, base: str, batch_id: int) -> DataFrame | None:
    """The online detector's state that earlier batches left: a retried batch starts where it started."""
    for version in history(spark, base):
        state = spark.read.parquet(f"{base}/{version}/hst_state")
        if spark.read.parquet(f"{base}/{version}/batch").first()["batch_id"] < batch_id:
            return state
    return None


def quality(batch: DataFrame, batch_id: int) -> DataFrame:
    """Rows per split and security events marked, one row per micro-batch."""
    lt = F.col("logtype")
    sec = (lt == "SECURITY") | ((lt == "ERROR") & F.coalesce(F.col("http_status_code") >= 400,
                                                            F.lit(False)))
    return batch.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lt.isin(*C.SYSTEM_LOG_TYPES)).alias("n_system"),
        F.count_if(lt.isin(*C.LLM_LOG_TYPES)).alias("n_llm"),
        F.count_if(lt.isin(*C.SYSTEM_LOG_TYPES) & sec).alias("n_security")
    ).withColumn("batch_id", F.lit(batch_id))


def hst_before(spark: SparkSession, path: str, feats: DataFrame, keys: list[str], batch_id: int) -> DataFrame | None:
    """What the online detector said of buckets in earlier batches (the latest of each)."""
    if not exists(spark, path):
        return None
    first = feats.select(F.min("bucket")).scalar()
    rows = spark.read.parquet(path).where((F.col("batch_id") < batch_id) & (F.col("bucket") >= first) & F.col("hst_score").isNotNull())
    said = F.max_by(F.struct("hst_score", "warm", "hst_flag"), "batch_id")
    return rows.groupBy(*keys, "bucket").agg(said.alias("s")).select(*keys, "bucket", "s.*")


def latest_features(spark: SparkSession, tables: str) -> DataFrame:
    """The features of every bucket as the last batch that touched it left them.

    A bucket that its last record has left has no row.
    """
    last = (spark.read.parquet(f"{tables}/touched_by_batch").where("bucket IS NOT NULL")
            .groupBy("bucket").agg(F.max("batch_id").alias("batch_id")))
    return spark.read.parquet(f"{tables}/features_by_batch").join(last, ["bucket", "batch_id"]).drop("batch_id")


def run_ingest(spark: SparkSession, landing: str, tables: str, checkpoint: str,
               bucket: str = C.BUCKET, available_now: bool = True,
               interval: str = "30 minutes", models: str | None = None, keys: list[str] | None = None,
               archive_dir: str | None = None, max_files_per_trigger: int | None = None):
    """Start the ingest, feature and detection stream; returns the StreamingQuery.

    With ``models`` the touched buckets are judged as a cycle judges its fresh ones,
    with the model that is published when the batch runs.  ``archive_dir``: where
    page files go once their batch is committed.
    """
    keys, started = list(keys or []), time.time()
    # Flattened on the stream, so that a batch keeps each row once, as the tables take it.
    documents = flatten(stream_documents(spark, landing, max_files_per_trigger, archive_dir), "@timestamp",
                        keep=(*POSITION, FILE, CORRUPT))

    def per_batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        batch, bad = records_of(rows), bad_documents(rows)
        write_batch(bad, f"{tables}/bad_pages", batch_id)
        system, llm = split_by_type(batch)
        system = flag_security(system)
        counts = quality(batch, batch_id).withColumn("n_bad_pages", bad.select(F.count(F.lit(1))).scalar())
        write_batch(counts, f"{tables}/batch_quality", batch_id)
        for name, rows, schema in (("system_logs", system, schemas.SYSTEM_LOGS),
                                   ("llm_logs", llm, schemas.LLM_LOGS)):
            merge_into(spark, f"{tables}/{name}", align_to(rows, schema, keep=POSITION), order=POSITION,
                       left_behind=f"{tables}/left_behind/batch={batch_id}")
        # Touched buckets, recomputed from the keyed tables: those of the batch's records (late rows
        # included), and those that a record sent again has left.
        stamps = batch.select("timestamp")
        if exists(spark, f"{tables}/left_behind/batch={batch_id}"):
            stamps = stamps.unionByName(spark.read.schema("timestamp timestamp_ntz").parquet(
                f"{tables}/left_behind/batch={batch_id}"))
        touched = materialize(stamps.select(F.window("timestamp", bucket).start.alias("bucket")).distinct())
        write_batch(touched, f"{tables}/touched_by_batch", batch_id)
        # Only the touched days are read, and only the touched buckets aggregated (their list is sent to
        # the rows where it is short: rows are not dealt by bucket).
        last = touched.agg(F.max("bucket")).first()[0]
        if last is not None:
            days = [r[0] for r in touched.where("bucket IS NOT NULL").select(F.explode(F.sequence(
                F.to_date("bucket"), F.to_date(F.col("bucket") + F.expr(f"INTERVAL {bucket}"))))
                .alias("dt")).distinct().collect()]
            wanted = broadcast_if_small(touched.withColumnRenamed("bucket", "__bucket"))

            def again(name: str, schema) -> DataFrame:
                rows = read_table(spark, f"{tables}/{name}", schema).where(F.col("dt").isin(days))
                return (rows.withColumn("__bucket", F.window("timestamp", bucket).start)
                        .join(wanted, "__bucket", "left_semi")
                        .drop("__bucket", "dt"))

            system, llm = again("system_logs", schemas.SYSTEM_LOGS), again("llm_logs", schemas.LLM_LOGS)
            write_batch(build_features(system, llm, bucket, keys), f"{tables}/features_by_batch", batch_id)
            model = load_model(spark, models) if models else None
            if model is not None:
                feats = materialize(spark.read.parquet(f"{tables}/features_by_batch").where(
                    F.col("batch_id") == batch_id).drop("batch_id"))
                state = f"{tables}/stream_state"
                scores = f"{tables}/scores_by_batch"
                judged = judge(feats, system, llm, model, state_before(spark, state, batch_id), bucket, keys,
                               hst_before(spark, scores, feats, keys, batch_id))
                write_batch(materialize(judged.scores), scores, batch_id)
                publish_alerts(spark, tables, judged, keys)
                publish(spark, state, {"hst_state": judged.hst_state, "batch": spark.createDataFrame(
                    [(batch_id,)], "batch_id long")})
        pulse(spark, batch_id, "OK", last, f"{tables}/heartbeat", started)
        rows.unpersist()

    w = documents.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


HST_STATE = "l string, r string, count int, first boolean, learned int"
HST_OUT = "tree_id int, bucket timestamp_ntz, mass double, scored boolean, warm boolean"


def hst_stateful(inputs: DataFrame, n_trees: int = C.HST_TREES, seed: int = 42) -> DataFrame:
    """X6 + X7: per-tree HST masses kept in streaming state keyed by tree_id.

    ``inputs``: (bucket, x, present) rows of a stream of bucket features.
    Output rows (tree_id, bucket, mass, scored, warm) are summed per bucket
    by ``hst.combine_trees`` inside foreachBatch.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id")
    per_tree = inputs.select("bucket", "x", "present", trees)

    def step(key, pdfs, state):
        tid = int(key[0])
        pdf = pd.concat(list(pdfs)).sort_values("bucket")
        prev = None
        if state.exists:
            l, r, count, first, learned = state.get
            prev = {"l": json.loads(l), "r": json.loads(r), "count": count, "first": first,
                    "learned": learned}
        X = np.array(pdf["x"].tolist(), dtype=float)
        P = np.array(pdf["present"].tolist(), dtype=bool)
        masses, scored, warm, st = HS.replay(tid, X, P, prev, seed=seed)
        state.update((json.dumps(st["l"]), json.dumps(st["r"]), st["count"], st["first"],
                      st["learned"]))
        yield pd.DataFrame({"tree_id": tid, "bucket": pdf["bucket"].values, "mass": masses,
                            "scored": scored, "warm": warm})

    return per_tree.groupBy("tree_id").applyInPandasWithState(
        step, HST_OUT, HST_STATE, "append", GroupStateTimeout.NoTimeout)
