"""Published versions, models and progress; the online detector's state over cycles; malformed pages."""
from __future__ import annotations

import datetime as dt
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import hst as HS
from riskspark.operators.ranks import ranked
from riskspark.sinks import tables as ST
from riskspark.sinks.published import current, history, point, pointed, publish

START = dt.datetime(2024, 1, 1)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def failing(spark):
    return spark.range(1).select(F.raise_error(F.lit("ended midway")).cast("int").alias("v"))


def values(df):
    return sorted(r["v"] for r in df.collect())


def test_a_write_that_ends_midway_leaves_the_version_before(spark, tmp_path):
    base = str(tmp_path / "p")
    assert current(spark, base, "a") is None and history(spark, base) == []
    publish(spark, base, {"a": numbers(spark, 1), "b": numbers(spark, 2)})
    with pytest.raises(Exception, match="midway"):
        publish(spark, base, {"a": numbers(spark, 5), "b": failing(spark)})
    assert values(current(spark, base, "a")) == [1] and values(current(spark, base, "b")) == [2]
    for k in (6, 7, 8):  # a version may be computed from the one before
        publish(spark, base, {"a": current(spark, base, "a").union(numbers(spark, k)), "b": numbers(spark, k)})
    assert values(current(spark, base, "a")) == [1, 6, 7, 8]
    assert len(history(spark, base)) == 2 and all(os.path.isdir(f"{base}/{v}") for v in history(spark, base))
    assert values(spark.read.parquet(f"{base}/{history(spark, base)[1]}/a")) == [1, 6, 7]


def test_a_saved_model_has_its_rows_once(spark, tmp_path):
    base, one = str(tmp_path / "m"), numbers(spark, 1, 2)
    with pytest.raises(Exception, match="midway"):
        ST.save_model(spark, base, "v1", one, failing(spark), {})
    assert ST.load_latest_model(spark, base) is None
    for _ in range(2):  # the second one is a retry
        ST.save_model(spark, base, "v1", one, one, {"k": 1}, offset=one)
        version, forest, baseline = ST.load_latest_model(spark, base)
        assert version == "v1" and values(forest) == values(baseline) == [1, 2]
    with pytest.raises(Exception, match="midway"):
        ST.save_model(spark, base, "v2", numbers(spark, 3), failing(spark), {})
    assert ST.load_latest_model(spark, base)[0] == "v1"
    ST.save_model(spark, base, "v2", numbers(spark, 3), one, {})
    assert values(ST.load_latest_model(spark, base)[1]) == [3]


def test_progress_and_state_change_together(spark, tmp_path):
    path = str(tmp_path / "progress")
    ST.save_progress(spark, path, 1, START, hst_state=numbers(spark, 1))
    with pytest.raises(Exception, match="midway"):
        ST.save_progress(spark, path, 2, START, hst_state=failing(spark))
    assert ST.load_progress(spark, path)[0] == 1 and values(current(spark, path, "hst_state")) == [1]
    point(spark, path, pointed(spark, path))  # naming the same version again changes nothing
    assert ST.load_progress(spark, path)[0] == 1


def inputs(spark, n=18, keys=("a", "b", None)):
    rng = np.random.default_rng(4)
    rows = []
    for k in keys:
        for i in range(n):
            present = [bool(p) for p in rng.random(12) > 0.1] if i != 4 else [False] * 12
            rows.append((k, START + dt.timedelta(hours=5 * i), [float(v) for v in rng.random(12)], present))
    return spark.createDataFrame(rows, "env string, bucket timestamp_ntz, x array<double>, present array<boolean>")


def test_three_cycles_equal_one_run_for_every_key(spark, tmp_path):
    """Cycles of 6 buckets are shorter than the window of 8: the state must carry over."""
    df, base = inputs(spark), str(tmp_path / "s")
    whole = sorted(map(repr, HS.score_batch(df, ["env"]).collect()))
    got = []
    for c in range(3):
        lo, hi = (F.lit(START + dt.timedelta(hours=5 * 6 * x)) for x in (c, c + 1))
        part = df.where((F.col("bucket") >= lo) & (F.col("bucket") < hi))
        out, state = HS.learn_and_score(part, current(spark, base, "hst"), ["env"])
        rows = out.collect()
        publish(spark, base, {"hst": state})
        got += rows
        if c == 1:
            assert all(r["warm"] for r in rows if r["bucket"] > START + dt.timedelta(hours=5 * 9))
        again, _ = HS.learn_and_score(part, current(spark, base, "hst"), ["env"])
        assert again.count() == 0  # what is learned is not learned again
    assert sorted(map(repr, got)) == whole
    assert current(spark, base, "hst").groupBy("env").count().agg(F.max("count")).first()[0] <= 15


def test_window_counts_equal_a_replay(spark):
    df = inputs(spark, n=40, keys=("a",))
    rows = df.orderBy("bucket").collect()
    x, present = np.array([r["x"] for r in rows]), np.array([r["present"] for r in rows])
    mass, scored, warm = np.zeros(40), None, None
    for t in range(25):
        m, scored, warm, _ = HS.replay(t, x, present, None)
        mass += m
    got = HS.score_batch(df.drop("env")).orderBy("bucket").collect()
    for r, m, s, w in zip(got, mass, scored, warm, strict=True):
        assert r["hst_score"] == (1 - m / HS.max_mass() if s else 0.0) and r["warm"] == w


def test_ranks_without_one_window(spark):
    df = inputs(spark, n=30)
    for keys in (["env"], []):
        rows = ranked(df.dropDuplicates([*keys, "bucket"]), keys).collect()
        for k in {tuple(r[c] for c in keys) for r in rows}:
            own = sorted((r["rank"], r["bucket"]) for r in rows if tuple(r[c] for c in keys) == k)
            assert [n for n, _ in own] == list(range(1, 31)) and own == sorted(own, key=lambda z: z[1])
    plan = ranked(df, [])._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(__day" in plan


def test_malformed_pages_are_kept_and_counted(spark, tmp_path):
    from riskspark.sources.pages import bad_pages, read_pages
    from riskspark.streaming.job import run_ingest
    landing, tables = str(tmp_path / "landing"), str(tmp_path / "t")
    good = {"data": [{"_id": f"x{i}", "@timestamp": "2024-01-01T00:00:00Z", "sap_function_log_type": "INFO"} for i in range(3)]}
    for page, text in ((1, json.dumps(good)), (2, json.dumps(good)[:-9]), (3, json.dumps({"data": []})), (4, "[")):
        os.makedirs(f"{landing}/page={page}")
        with open(f"{landing}/page={page}/p.json", "w") as f:
            f.write(text + "\n")
    with pytest.raises(Exception):
        read_pages(spark, landing).collect()
    assert read_pages(spark, landing, strict=False).count() == 3
    assert {(r["page"], r["file"]): r["n_bytes"] for r in bad_pages(spark, landing).collect()} == {
        (2, "p.json"): len(json.dumps(good)) - 9, (4, "p.json"): 1}
    run_ingest(spark, landing, tables, str(tmp_path / "cp")).awaitTermination(300)
    assert sorted(r["page"] for r in spark.read.parquet(f"{tables}/bad_pages").collect()) == [2, 4]
    assert spark.read.parquet(f"{tables}/batch_quality").agg(F.sum("n_bad_pages"), F.sum("n_rows")).first()[:] == (2, 3)
    beat = spark.read.parquet(f"{tables}/heartbeat").collect()
    assert len(beat) == 1 and beat[0]["pipeline_host"] and beat[0]["uptime_min"] is not None
