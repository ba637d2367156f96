"""Ranks over time without one task for all rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import same_keys


def ranked(rows: DataFrame, keys: list[str], ts: str = "bucket", out: str = "rank") -> DataFrame:
    """Rows with their number (from 1) within their keys in the order of ``ts``.

    Rows are numbered within (keys, day), and the days' counts summed up before
    that: the only window over more than a day has one row per key and day.
    """
    day = rows.withColumn("__day", F.to_date(ts))
    per = day.groupBy(*keys, "__day").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(*keys, "__day", F.coalesce(before, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*keys, "__day").orderBy(ts)).cast("long")
    return (same_keys(day.withColumn("__own", own), per, [*keys, "__day"])
            .withColumn(out, F.col("__own") + F.col("__before")).drop("__day", "__own", "__before"))
