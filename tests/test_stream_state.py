"""Streaming state: HST masses in applyInPandasWithState equal the batch replay,
also across a restart from the checkpoint (X6, X7); windowed features (X3); model tables (K13)."""
import os

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskspark.operators import hst as HS
from riskspark.plans.detect import z_chain
from riskspark.streaming.job import hst_stateful


def _run_hst_stream(spark, src, cp, out, schema):
    # One micro-batch per run (file order within a batch does not matter: rows
    # are replayed in bucket order); the second run restores the state.
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    q = (hst_stateful(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", cp).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(600)


def test_hst_stream_matches_batch_with_restart(spark, scratch):
    ch = z_chain(spark, SF_SMALL, "1 hour")
    inputs = HS.scaled_inputs(ch.features, HS.baseline_minmax(ch.features)).orderBy("bucket")
    pdf = inputs.toPandas()
    src, cp, out = (os.path.join(scratch, n) for n in ("src", "cp", "out"))
    # Deliver the series in time-ordered files; the second run resumes from the checkpoint.
    cut = len(pdf) // 2
    parts = [pdf.iloc[i:min(i + 60, cut)] for i in range(0, cut, 60)]
    later = [pdf.iloc[i:i + 60] for i in range(cut, len(pdf), 60)]
    for i, p in enumerate(parts):
        spark.createDataFrame(p, inputs.schema).coalesce(1).write.parquet(f"{src}/f{i:04d}")
    _run_hst_stream(spark, src, cp, out, inputs.schema)
    for j, p in enumerate(later):
        spark.createDataFrame(p, inputs.schema).coalesce(1).write.parquet(f"{src}/f{len(parts) + j:04d}")
    _run_hst_stream(spark, src, cp, out, inputs.schema)
    streamed = HS.combine_trees(spark.read.parquet(out), []).toPandas().sort_values("bucket")
    batch = HS.score_batch(inputs).toPandas().sort_values("bucket")
    assert len(streamed) == len(batch)
    assert (abs(streamed["hst_score"].values - batch["hst_score"].values) < 1e-12).all()


def test_streamed_windows_equal_the_batch_matrix(spark, scratch):
    """All features per key, of every bucket that the watermark has closed; a later row is dropped."""
    import json
    from riskspark import constants as C
    from riskspark.operators.features import build_features
    from riskspark.operators.prepare import prepared_logs
    from riskspark.sinks.files import land_pages
    from riskspark.sources.fixture import raw_logs
    from riskspark.sources.pages import stream_pages
    from riskspark.streaming.windows import stream_features
    raw = raw_logs(spark, SF_SMALL).withColumnRenamed("event_ts", "@timestamp")
    page = (F.floor(F.split("_id", "-").getItem(1).cast("bigint") / 100) + 1).cast("int")
    landing, out, keys = os.path.join(scratch, "landing"), os.path.join(scratch, "out"), ["sap_app_env"]
    land_pages(raw.withColumn("page", page), landing)

    def run():
        feats = stream_features(stream_pages(spark, landing), "6 hours", "30 minutes", keys)
        (feats.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(scratch, "cp"))
         .outputMode("append").trigger(availableNow=True).start().awaitTermination(600))
        return spark.read.parquet(out).toPandas().sort_values([*keys, "bucket"]).reset_index(drop=True)

    first = run()
    os.makedirs(os.path.join(landing, "page=9999"))
    row = {"sap_function_log_type": "ERROR", "sap_app_env": "dev"}
    with open(os.path.join(landing, "page=9999", "late.json"), "w") as f:
        f.write(json.dumps({"data": [{**row, "_id": "late", "@timestamp": "2024-01-01T00:10:00Z"},
                                     {**row, "_id": "end", "@timestamp": "2024-03-01T00:00:00Z"}]}) + "\n")
    got = run()
    want = build_features(*prepared_logs(raw, "@timestamp"), "6 hours", keys).toPandas()
    want = want.sort_values([*keys, "bucket"]).reset_index(drop=True)
    assert 0 < len(first) < len(got) == len(want) > 100
    assert (got[[*keys, "bucket"]] == want[[*keys, "bucket"]]).all().all()
    for c in C.FEATURE_COLS:
        assert np.allclose(got[c], want[c], rtol=1e-9, atol=1e-9), c


def test_model_tables_roundtrip(spark, scratch):
    from riskspark.operators import baseline as BL
    from riskspark.operators import iforest as IF
    from riskspark.sinks.tables import drop_versions, load_latest_model, save_model
    ch = z_chain(spark, SF_SMALL, "1 hour")
    vec = BL.feature_vector(ch.features, ch.base)
    forest = IF.fit(vec, n_trees=5)
    base = os.path.join(scratch, "models")
    for v in ("20240101_000000", "20240102_000000"):
        save_model(spark, base, v, forest, ch.base, {"bucket": "1 hour"})
    version, f2, b2 = load_latest_model(spark, base)
    assert version == "20240102_000000" and f2.count() == forest.count()
    drop_versions(spark, base, ["20240101_000000"])
    assert spark.read.parquet(f"{base}/meta").select("version").distinct().count() == 1
