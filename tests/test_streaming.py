"""Batch/stream equality: availableNow over landed pages equals the batch features."""
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskspark.operators.features import build_features
from riskspark.operators.prepare import prepared_logs
from riskspark.sinks.files import land_pages
from riskspark.sources.fixture import raw_logs
from riskspark.streaming.job import run_ingest


def test_stream_equals_batch_and_replay_is_idempotent(spark, scratch):
    raw = raw_logs(spark, SF_SMALL).withColumnRenamed("event_ts", "@timestamp")
    page = (F.floor(F.split("_id", "-").getItem(1).cast("bigint") / 100) + 1).cast("int")
    land_pages(raw.withColumn("page", page), os.path.join(scratch, "landing"))
    tables, cp = os.path.join(scratch, "tables"), os.path.join(scratch, "cp")
    q = run_ingest(spark, os.path.join(scratch, "landing"), tables, cp, bucket="1 hour")
    q.awaitTermination(600)
    system, llm = prepared_logs(raw, "@timestamp")
    batch = build_features(system, llm, "1 hour").toPandas().sort_values("bucket").reset_index(drop=True)
    st = spark.read.parquet(os.path.join(tables, "system_logs"))
    assert st.count() == system.count()
    streamed = (spark.read.parquet(os.path.join(tables, "features_by_batch")).drop("batch_id")
                .toPandas().sort_values("bucket").reset_index(drop=True))
    assert len(streamed) == len(batch)
    for c in ("n_sys_requests", "n_llm_requests", "error_rate", "p95_llm_latency"):
        assert (abs(streamed[c] - batch[c]) < 1e-9).all(), c
    # Replay: running again over the same checkpoint adds nothing.
    q2 = run_ingest(spark, os.path.join(scratch, "landing"), tables, cp, bucket="1 hour")
    q2.awaitTermination(600)
    assert spark.read.parquet(os.path.join(tables, "system_logs")).count() == system.count()


def test_malformed_page_is_dropped_or_fails(spark, scratch):
    import pytest
    from riskspark.sources.pages import read_pages
    d = os.path.join(scratch, "pages")
    os.makedirs(os.path.join(d, "page=1"))
    os.makedirs(os.path.join(d, "page=2"))
    with open(os.path.join(d, "page=1", "a.json"), "w") as f:
        f.write('{"data": [{"_id": "x1", "@timestamp": "2024-01-01T00:00:00Z"}]}\n')
    with open(os.path.join(d, "page=2", "b.json"), "w") as f:
        f.write('{"data": [ this is not json\n')
    rows = read_pages(spark, d, strict=False).collect()
    assert [r["_id"] for r in rows] == ["x1"]
    assert read_pages(spark, d, max_pages=1, strict=False).count() == 1
    with pytest.raises(Exception):
        read_pages(spark, d, strict=True).collect()


def test_three_way_export(spark, scratch):
    from riskspark.plans.common import flat_logs
    from riskspark.sinks.files import export_splits
    flat = flat_logs(spark, SF_SMALL)
    out = export_splits(flat, os.path.join(scratch, "exports"), "20240131_000000")
    n_all = spark.read.option("header", True).csv(out["all"]).count()
    n_llm = spark.read.option("header", True).csv(out["llm"]).count()
    n_sys = spark.read.option("header", True).csv(out["system"]).count()
    assert n_all == flat.count() == n_llm + n_sys


def test_cycle_then_stream_scoring(spark, scratch):
    """X8 + detection cycle: train on the keyed tables, then score a fresh stream."""
    from riskspark.plans.cycle import detect_cycle
    from riskspark.plans.ml_queries import land_tables
    tables, models = os.path.join(scratch, "t"), os.path.join(scratch, "m")
    land_tables(spark, SF_SMALL, tables)
    res = detect_cycle(spark, tables, models, "2024-01-31 00:00:00", cycle=1, bucket="1 hour",
                       training_hours=24 * 31, fresh_since="2024-01-01 00:00:00")
    assert res.ready and res.retrained and res.records.count() > 0
    assert set(r["status"] for r in res.outbox.select("status").distinct().collect()) <= {"QUEUED", "SKIPPED"}
    # Cycle 2 reuses the stored model (retrain every second cycle).
    res2 = detect_cycle(spark, tables, models, "2024-01-31 00:00:00", cycle=2, bucket="1 hour",
                        training_hours=24 * 31, fresh_since="2024-01-30 00:00:00")
    assert res2.ready and not res2.retrained
    raw = raw_logs(spark, SF_SMALL).withColumnRenamed("event_ts", "@timestamp")
    page = (F.floor(F.split("_id", "-").getItem(1).cast("bigint") / 100) + 1).cast("int")
    land_pages(raw.withColumn("page", page), os.path.join(scratch, "landing"))
    q = run_ingest(spark, os.path.join(scratch, "landing"), os.path.join(scratch, "s"),
                   os.path.join(scratch, "cp"), bucket="1 hour", models=models)
    q.awaitTermination(600)
    scored = spark.read.parquet(os.path.join(scratch, "s", "scores_by_batch"))
    assert scored.count() > 0 and scored.where("prediction = -1").count() > 0
    hb = spark.read.parquet(os.path.join(scratch, "s", "heartbeat"))
    assert hb.where("pipeline_id = 'main_pipeline'").count() >= 1


def test_embedded_batch_and_csv_replay(spark, scratch):
    """K10/S11 (batch kept as JSON text, read back) and K11 (CSV replay is idempotent)."""
    from riskspark import schemas
    from riskspark.plans.common import logs
    from riskspark.schemas import align_to
    from riskspark.sinks.files import export_csv
    from riskspark.sinks.tables import merge_into, replay_exports, write_embedded_batch
    from riskspark.sources.pages import read_embedded_records
    system, _ = logs(spark, SF_SMALL)
    table = align_to(system, schemas.SYSTEM_LOGS)
    write_embedded_batch(table, os.path.join(scratch, "pending"), 7)
    back = read_embedded_records(spark.read.parquet(os.path.join(scratch, "pending")), "records",
                                 schemas.SYSTEM_LOGS)
    assert back.count() == table.count()
    export_csv(table, os.path.join(scratch, "csv"))
    t = os.path.join(scratch, "tbl")
    merge_into(spark, t, table)
    replay_exports(spark, os.path.join(scratch, "csv"), schemas.SYSTEM_LOGS, t)
    assert spark.read.parquet(t).count() == table.count()


def test_keyed_cycle(spark, scratch):
    """The cycle with keys: one baseline, forest and HST series per environment."""
    from riskspark.plans.cycle import detect_cycle
    from riskspark.plans.ml_queries import land_tables
    tables, models = os.path.join(scratch, "t"), os.path.join(scratch, "m")
    land_tables(spark, SF_SMALL, tables)
    res = detect_cycle(spark, tables, models, "2024-01-31 00:00:00", cycle=1, bucket="1 hour",
                       training_hours=24 * 31, fresh_since="2024-01-01 00:00:00",
                       keys=["sap_app_env"])
    rec = res.records.toPandas()
    assert len(rec) > 0 and set(rec["sap_app_env"]) <= {"production", "staging", "dev"}
    assert rec["anomaly_id"].is_unique


def test_a_record_sent_again_leaves_its_bucket(spark, scratch):
    """The bucket that a moved record has left is computed again, and has no row once it is empty."""
    import json
    from riskspark.streaming.job import latest_features
    landing, tables, cp = [os.path.join(scratch, d) for d in ("landing", "tables", "cp")]

    def land(page, hours):
        os.makedirs(os.path.join(landing, f"page={page}"))
        rows = [{"_id": k, "@timestamp": f"2024-01-0{d}T{h:02d}:10:00Z", "sap_function_log_type": "ERROR"}
                for k, (d, h) in hours.items()]
        with open(os.path.join(landing, f"page={page}", "a.json"), "w") as f:
            f.write(json.dumps({"data": rows}) + "\n")
        run_ingest(spark, landing, tables, cp, bucket="1 hour").awaitTermination(600)

    land(1, {"a": (1, 1), "b": (1, 1), "c": (2, 2)})
    land(2, {"a": (1, 5), "c": (3, 5)})
    got = {(r["bucket"].day, r["bucket"].hour): r["n_sys_requests"] for r in latest_features(spark, tables).collect()}
    assert got == {(1, 1): 1.0, (1, 5): 1.0, (3, 5): 1.0}
