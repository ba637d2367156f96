"""The key index and zones of a keyed table: what a merge reads, moved and null keys, growth, ended merges."""
from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators.spans import data_span, zone_span
from riskspark.sinks import keyindex as IX
from riskspark.sinks import tables as ST
from riskspark.sinks.tables import merge_into, read_table

DDL = "_id string, timestamp timestamp_ntz, v int"


def batch(spark, rows):
    return spark.createDataFrame([(k, d and dt.datetime(2024, 1, 1) + dt.timedelta(days=d - 1, hours=v % 24), v)
                                  for k, d, v in rows], DDL)


def entries(spark, t):
    n_bits = IX.bits(spark, t)
    root = f"{IX.base(t)}/bits={n_bits}"
    return spark.read.schema(IX.ENTRY).parquet(root)


def check(spark, t):
    """The index and the zones are those of the table as it is."""
    rows = read_table(spark, t)
    want = {(r["h"], r["dt"]) for r in IX.of_rows(rows, "_id").collect()}
    got = [(r["h"], r["dt"]) for r in entries(spark, t).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    z = sorted(map(str, IX.zones(spark, t).select("dt", "n_rows", "min_ts", "max_ts").collect()))
    assert z == sorted(map(str, IX.zones_of(rows, "timestamp").select("dt", "n_rows", "min_ts", "max_ts").collect()))
    assert zone_span(IX.zones(spark, t)).collect() == data_span(rows).collect()


def test_random_merges_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(IX, "BUCKET_ENTRIES", 24)
    t, model, rnd = str(tmp_path / "t"), {}, random.Random(5)
    for step in range(4):
        keys = rnd.sample([None, "", *[f"k{i}" for i in range(60)]], 12 if step else 40)
        rows = [(k, rnd.choice([None, 1, 2, 3, 4, 5]), step * 10 + i) for i, k in enumerate(keys)]
        merge_into(spark, t, batch(spark, rows))
        model.update({k: (d, v) for k, d, v in rows})
        got = {r["_id"]: (r["dt"] and r["dt"].day, r["v"]) for r in read_table(spark, t).collect()}
        assert got == model and read_table(spark, t).count() == len(model)
        check(spark, t)
    assert IX.bits(spark, t) > 0 and os.listdir(IX.base(t)).count(f"bits={IX.bits(spark, t)}") == 1


def test_a_merge_opens_only_its_buckets(spark, tmp_path, monkeypatch):
    """Ten times the table, the same number of entries read for a batch of three keys."""
    monkeypatch.setattr(IX, "BUCKET_ENTRIES", 50)
    read = {}
    for n in (300, 3_000):
        t = str(tmp_path / f"t{n}")
        merge_into(spark, t, spark.range(n).select(
            F.concat(F.lit("k"), "id").alias("_id"),
            (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 7).cast("int"))).alias("timestamp"),
            F.col("id").cast("int").alias("v")))
        some = batch(spark, [("k1", 3, 1), ("k2", 3, 1), ("new", 3, 1)])
        n_bits = IX.bits(spark, t)
        got = IX.entries(spark, t, n_bits, IX.buckets_of(some, "_id", n_bits))
        read[n] = got.count()
        assert {p.split("bucket=")[1].split("/")[0] for p in got.inputFiles()} == {
            str(b) for b in IX.buckets_of(some, "_id", n_bits)}
        merge_into(spark, t, some)
        assert read_table(spark, t).count() == n + 1
        check(spark, t)
    assert read[3_000] <= 3 * 2 * 50 < 3_000


def test_a_table_without_index_gets_one(spark, tmp_path):
    t = str(tmp_path / "t")
    rows = batch(spark, [("a", 1, 1), ("b", 2, 1), (None, 2, 3)]).withColumn("dt", F.to_date("timestamp"))
    rows.write.partitionBy("dt").parquet(t)
    assert IX.zones(spark, t) is None
    merge_into(spark, t, batch(spark, [("a", 4, 2), (None, 5, 4)]))
    assert sorted((r["_id"] or "", r["dt"].day) for r in read_table(spark, t).collect()) == [("", 5), ("a", 4), ("b", 2)]
    check(spark, t)


@pytest.mark.parametrize("at", ["first bucket", "pointer"])
def test_an_index_whose_write_ended_midway_is_finished(spark, tmp_path, monkeypatch, at):
    t = str(tmp_path / "t")
    merge_into(spark, t, batch(spark, [("a", 1, 1), ("b", 2, 1)]))

    def ended(*_, **__):
        raise RuntimeError("ended midway")

    with monkeypatch.context() as m:  # before the index's buckets, or after them
        if at == "first bucket":
            m.setattr(IX, "put", ended)
        else:
            m.setattr(IX, "bits", lambda *_: ended() if exists_gone(t) else 0)
        with pytest.raises(RuntimeError):
            merge_into(spark, t, batch(spark, [("a", 3, 2)]))
    merge_into(spark, t, batch(spark, [("c", 5, 1)]))
    assert sorted((r["_id"], r["dt"].day) for r in read_table(spark, t).collect()) == [("a", 3), ("b", 2), ("c", 5)]
    check(spark, t)


def exists_gone(t):
    base = t + "_staging"
    return os.path.isdir(base) and any(os.path.exists(f"{base}/{d}/gone/_SUCCESS") for d in os.listdir(base))


def test_instants_left_behind(spark, tmp_path):
    t, left = str(tmp_path / "t"), str(tmp_path / "left")
    merge_into(spark, t, batch(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]))
    for _ in range(2):  # a retry adds none and loses none
        merge_into(spark, t, batch(spark, [("a", 1, 2), ("b", 2, 1), ("d", 3, 1)]), left_behind=left)
    assert [r[0] for r in spark.read.parquet(left).collect()] == [dt.datetime(2024, 1, 1, 1)]
