"""Stages of the pipeline."""
import random
import uuid

import corpus_pipeline
from riskspark.llm import pfair


def test_tokens_keep_the_order_of_the_mixture(spark, scratch):
    rng = random.Random(5)
    rows = [(k, "w" * rng.randrange(1, 4000), rng.choice("aaab")) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    plan = {r.doc_id: (r.slot, r.rank) for r in pfair.schedule(docs, block_chars=2000).collect()}
    path = f"{scratch}/{uuid.uuid4().hex}"
    # Several files a task, of different sizes: a reader takes the largest first.
    order = spark.createDataFrame([(i, *plan[i]) for i in plan], "doc_id long, slot long, rank long")
    (docs.join(order, "doc_id").repartitionByRange(3, "slot", "rank").sortWithinPartitions("slot", "rank")
     .drop("slot", "rank").write.option("maxRecordsPerFile", 60).parquet(path))
    made = corpus_pipeline.tokens(spark, spark.read.parquet(path), "")
    got = made.collect()
    assert len(got) == len(rows)
    want = sorted(plan, key=plan.get)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.place)] == want
    assert [r.doc_id for r in got] == want  # partitions are ranges, and in order
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_mixed_files_are_in_the_order_of_slots(spark, scratch):
    rows = [(k, f"{k:05d}" * (1 + k % 7), "ab"[k % 3 == 0]) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    path = f"{scratch}/{uuid.uuid4().hex}"
    pfair.mixed(docs, block_chars=100).write.parquet(path)
    plan = {r.doc_id: (r.slot, r.rank) for r in pfair.schedule(docs, block_chars=100).collect()}
    got = corpus_pipeline.tokens(spark, spark.read.parquet(path), "").collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.place)] == sorted(plan, key=plan.get)
