"""Page documents, many to a file: their numbers, the cap, malformed ones, and both forms in one directory."""
import json
import os

import pytest
from pyspark.sql import functions as F

from riskspark.sinks.files import land_pages
from riskspark.sources.pages import bad_pages, page_texts, read_pages
from riskspark.streaming.job import run_ingest


def records(spark, n):
    return spark.range(n, numPartitions=4).select(
        F.concat(F.lit("log-"), "id").alias("_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("@timestamp"),
        F.lit("INFO").alias("sap_function_log_type"), (F.floor(F.col("id") / 3) + 1).cast("int").alias("page"))


def files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_the_number_of_files_does_not_grow_with_the_pages(spark, scratch):
    path = os.path.join(scratch, "landing")
    land_pages(records(spark, 900), path)
    assert len(files(path)) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = read_pages(spark, path)
    assert got.schema["page"].dataType.simpleString() == "int"
    rows = sorted((int(r["_id"][4:]), r["page"]) for r in got.collect())
    assert rows == [(k, k // 3 + 1) for k in range(900)]
    assert {r["page"] for r in read_pages(spark, path, max_pages=7).collect()} == set(range(1, 8))


def test_malformed_documents_among_others_keep_their_numbers(spark, scratch):
    path, cut = os.path.join(scratch, "landing"), os.path.join(scratch, "cut")
    land_pages(records(spark, 60), path)
    short = F.expr("substring(value, 1, length(value) - 3)")
    (page_texts(spark, path).select(F.when(F.col("page").isin(5, 12), short).otherwise(F.col("value")).alias("value"))
     .unionByName(spark.createDataFrame([('{"pa',)], "value string")).coalesce(1).write.text(cut))
    assert len(files(cut)) == 1
    good = {r["page"] for r in read_pages(spark, cut, strict=False).collect()}
    assert good == set(range(1, 21)) - {5, 12}
    assert sorted((r["page"] or 0, r["n_bytes"] > 100) for r in bad_pages(spark, cut).collect()) == [(0, False), (5, True), (12, True)]
    assert read_pages(spark, cut, max_pages=4).count() == 12     # (those beyond the cap end nothing)
    with pytest.raises(Exception, match="malformed page document, page 5"):
        read_pages(spark, cut, max_pages=5).collect()
    # On the stream, with one in a folder of its own and one file delivered again.
    os.makedirs(os.path.join(cut, "page=99"))
    with open(os.path.join(cut, "page=99", "a.json"), "w") as f:
        f.write(json.dumps({"data": [{"_id": "own", "@timestamp": "2024-01-01T00:00:00Z", "sap_function_log_type": "INFO"}]}) + "\n")
    assert {r["page"] for r in read_pages(spark, cut, strict=False).collect()} == good | {99}
    tables = os.path.join(scratch, "t")
    for again in (False, True):
        if again:
            page_texts(spark, cut).where("page = 1").select("value").write.mode("append").text(cut)
        run_ingest(spark, cut, tables, os.path.join(scratch, "cp")).awaitTermination(300)
    assert spark.read.parquet(f"{tables}/system_logs").count() == 3 * 18 + 1
    assert sorted(r["page"] or 0 for r in spark.read.parquet(f"{tables}/bad_pages").collect()) == [0, 5, 12]
    counts = spark.read.parquet(f"{tables}/batch_quality").orderBy("batch_id")
    assert [tuple(r) for r in counts.select("n_rows", "n_bad_pages").collect()] == [(55, 3), (3, 0)]
