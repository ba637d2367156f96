"""What grows with the rows of a stream or a landing: kept copies, the key index, dealt rows."""
import os

from pyspark.sql import functions as F

from riskspark.sinks import keyindex as IX
from riskspark.sinks import tables as ST
from riskspark.sinks.files import land_pages
from riskspark.sources.pages import page_texts
from riskspark.streaming import job


def records(spark, n):
    return spark.range(n, numPartitions=4).select(
        F.concat(F.lit("log-"), "id").alias("_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id, 0, 0)").alias("@timestamp"),
        F.when(F.col("id") % 5 == 0, "LLM_REQUEST").otherwise("INFO").alias("sap_function_log_type"),
        (F.floor(F.col("id") / 4) + 1).cast("int").alias("page"))


def test_a_batch_keeps_each_row_once_and_counts_bad_documents(spark, scratch, monkeypatch):
    landing, tables = os.path.join(scratch, "landing"), os.path.join(scratch, "t")
    land_pages(records(spark, 40), landing)
    spark.createDataFrame([('{"page":99,"data":[{"_i',), ('{"page":98,"data":[]}',)], "value string").coalesce(1).write.mode("append").text(landing)
    kept, frame = [], type(spark.range(1))
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or real(self, *a))
    job.run_ingest(spark, landing, tables, os.path.join(scratch, "cp"), bucket="1 hour").awaitTermination(300)
    assert len(kept) == 1
    assert spark.read.parquet(f"{tables}/system_logs").count() == 32 and spark.read.parquet(f"{tables}/llm_logs").count() == 8
    assert [r["page"] for r in spark.read.parquet(f"{tables}/bad_pages").collect()] == [99]
    counts = spark.read.parquet(f"{tables}/batch_quality").first()
    assert (counts["n_rows"], counts["n_system"], counts["n_llm"], counts["n_bad_pages"]) == (40, 32, 8, 1)
    assert sorted(r["n_sys_requests"] + r["n_llm_requests"] for r in job.latest_features(spark, tables).collect()) == [1.0] * 40


def test_an_index_bucket_is_copied_not_aggregated(spark, scratch):
    table = os.path.join(scratch, "t")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), (None, "2024-01-02"), ("c", None)], "_id string, d string")
    rows = rows.select("_id", F.col("d").cast("timestamp_ntz").alias("timestamp"))
    ST.merge_into(spark, table, rows)
    batch = spark.createDataFrame([("b", "2024-01-03"), ("d", None)], "_id string, d string")
    ST.merge_into(spark, table, batch.select("_id", F.col("d").cast("timestamp_ntz").alias("timestamp")))
    stored = spark.read.parquet(table)
    want = {(r["h"], r["dt"]) for r in IX.of_rows(stored, "_id").collect()}
    got = [(r["h"], r["dt"]) for r in IX.entries(spark, table, 0, [0]).collect()]
    assert len(got) == 5 and set(got) == want
    fresh = IX._fresh(stored, stored.where("_id = 'a'"), IX.entries(spark, table, 0, [0]), "_id", 0)
    assert "collect_set" not in fresh._jdf.queryExecution().toString()


def test_pages_are_dealt_before_they_are_collected(spark, scratch, monkeypatch):
    plans, writer = [], type(spark.range(1).write)
    real = writer.json
    monkeypatch.setattr(writer, "json", lambda self, path, *a, **b: plans.append(self._df._jdf.queryExecution().executedPlan().toString()) or real(self, path, *a, **b))
    land_pages(records(spark, 40), os.path.join(scratch, "landing"))
    assert plans[0].index("Exchange") > plans[0].rindex("collect_list")
    assert page_texts(spark, os.path.join(scratch, "landing")).count() == 10
