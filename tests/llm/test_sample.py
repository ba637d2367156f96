"""Samples chosen by a hash of the id."""
from pyspark.sql import functions as F

from riskspark.llm.common import sampled


def test_a_sample_of_any_share(spark):
    ids = spark.range(2_000_000)
    whole = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1_000_000)) == 0
    assert ids.where(sampled("id", 10, 20)).count() == 2_000_000
    assert 90_000 < ids.where(sampled("id", 2_000_000, 100_000)).count() < 110_000
    # Under a millionth: part of the first millionth, where whole millionths alone would give none.
    first = spark.range(200_000_000).where(whole)
    some, most = (first.where(sampled("id", n, 20_000)).count() for n in (40_000_000_000, 20_000_000_000))
    assert 60 < some < 140 and 150 < most < 260
