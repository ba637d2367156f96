"""Keyed tables: empty batches, moved dates, ties, retries, pending batches; retention runs."""
from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql.types import StructType

from riskspark.operators.liveness import empty_cycle_runs
from riskspark.sinks.tables import drain_pending, load_progress, merge_into, read_table, save_progress, write_embedded_batch

DDL = "_id string, timestamp timestamp_ntz, v int"


def batch(spark, *rows, ddl=DDL):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, day), v, *r) for k, day, v, *r in rows], ddl)


def held(spark, path):
    return sorted((r["_id"], r["timestamp"].day, r["v"], r["dt"].day) for r in read_table(spark, path).collect())


def test_merge_moves_dates_and_survives_empty_batches_and_retries(spark, tmp_path):
    t, schema = str(tmp_path / "t"), StructType.fromDDL(DDL)
    assert read_table(spark, t, schema).count() == 0
    merge_into(spark, t, batch(spark))
    assert read_table(spark, t, schema).count() == 0
    merge_into(spark, t, batch(spark, ("a", 1, 1), ("b", 2, 1), ("c", 2, 1)))
    merge_into(spark, t, batch(spark))
    for _ in range(2):  # the second one is a retry
        merge_into(spark, t, batch(spark, ("a", 2, 5), ("d", 3, 1)))
        assert held(spark, t) == [("a", 2, 5, 2), ("b", 2, 1, 2), ("c", 2, 1, 2), ("d", 3, 1, 3)]
    assert not os.listdir(t + "_staging")


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_last_position_of_a_batch_wins(spark, tmp_path, parts):
    t = str(tmp_path / "t")
    rows = batch(spark, *[("a", 1, i, 49 - abs(i - 30)) for i in range(50)], ddl=DDL + ", place int")
    merge_into(spark, t, rows.repartition(parts), order=("place",))
    assert held(spark, t) == [("a", 1, 30, 1)]
    plain = str(tmp_path / "p")
    merge_into(spark, plain, rows.drop("place").repartition(parts))
    once = str(tmp_path / "o")
    merge_into(spark, once, rows.drop("place").coalesce(1))
    assert held(spark, plain) == held(spark, once)


def test_pending_batches_are_drained(spark, tmp_path):
    t, pending = str(tmp_path / "t"), str(tmp_path / "pending")
    for _ in range(2):  # a retried write replaces its own batch
        write_embedded_batch(batch(spark, ("a", 1, 1), ("b", 1, 1)), pending, 3)
    write_embedded_batch(batch(spark, ("a", 1, 2)), pending, 4)
    assert drain_pending(spark, pending, t, StructType.fromDDL(DDL)) == []
    assert held(spark, t) == [("a", 1, 2, 1), ("b", 1, 1, 1)]
    assert drain_pending(spark, pending, t, StructType.fromDDL(DDL)) == []


def test_progress(spark, tmp_path):
    path = str(tmp_path / "progress")
    assert load_progress(spark, path) == (0, None)
    save_progress(spark, path, 4, dt.datetime(2024, 1, 2))
    assert load_progress(spark, path) == (4, "2024-01-02 00:00:00")


def test_retention_starts_again_after_two_empty_cycles(spark):
    new = [5, 0, 0, 1, 0, 0, 0, 2, 0, 0, 0, 0, 3, 0]
    got = empty_cycle_runs(spark.createDataFrame(list(enumerate(new)), "cycle int, new_rows int"))
    assert [r["cycle"] for r in got.where("retention_due").orderBy("cycle").collect()] == [2, 5, 9, 11]


def test_a_merge_that_ends_midway_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    from riskspark.sinks import tables as ST
    t = str(tmp_path / "t")
    merge_into(spark, t, batch(spark, ("a", 1, 1), ("b", 2, 1)))

    def ended(*_):
        raise RuntimeError("ended midway")

    with monkeypatch.context() as m:
        m.setattr(ST, "_put", ended)
        with pytest.raises(RuntimeError):
            merge_into(spark, t, batch(spark, ("a", 3, 2)))
    assert len(os.listdir(t + "_staging")) == 1  # the only whole copy of the days
    merge_into(spark, t, batch(spark, ("c", 5, 1)))
    assert held(spark, t) == [("a", 3, 2, 3), ("b", 2, 1, 2), ("c", 5, 1, 5)]
    with monkeypatch.context() as m:  # before the merge is whole: nothing of it stays
        m.setattr(ST, "upsert", ended)
        with pytest.raises(RuntimeError):
            merge_into(spark, t, batch(spark, ("a", 4, 9)))
    assert not os.listdir(t + "_staging")
    assert held(spark, t) == [("a", 3, 2, 3), ("b", 2, 1, 2), ("c", 5, 1, 5)]


def test_a_merged_row_is_written_once(spark, tmp_path, monkeypatch):
    """K1: what is staged is moved into the table, and the first batch is staged as the table it makes."""
    from riskspark.sinks import tables as ST
    t, staged, put = str(tmp_path / "t"), [], ST._put

    def names(path):
        return {os.path.relpath(f"{d}/{f}", path) for d, _, found in os.walk(path) for f in found if f.endswith(".parquet")}

    def seen(spark, table, staging, *more):
        staged.append((names(f"{staging}/merged"), os.path.isdir(f"{staging}/batch")))
        put(spark, table, staging, *more)

    monkeypatch.setattr(ST, "_put", seen)
    merge_into(spark, t, batch(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 1)))
    assert staged[-1] == (names(t), False) and len(names(t)) == 3
    cached = spark.read.parquet(t).persist()
    assert cached.count() == 3
    merge_into(spark, t, batch(spark, ("a", 2, 2), ("d", 4, 1)))
    assert staged[-1][1] and staged[-1][0] <= names(t)
    assert held(spark, t) == [("a", 2, 2, 2), ("b", 2, 1, 2), ("c", 3, 1, 3), ("d", 4, 1, 4)]  # (not what was cached)
    cached.unpersist()
