"""Anomaly bucket -> raw log lookups."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .util import broadcast_if_small


def _restrict(logs: DataFrame, buckets: DataFrame | None, keys: list[str]) -> DataFrame:
    """Keep log rows of the given buckets: semi-join with the (checked-size) bucket list."""
    if buckets is None:
        return logs
    b = buckets.select(*keys, "bucket").distinct()
    return logs.join(broadcast_if_small(b), [*keys, "bucket"], "left_semi")


def top_value_per_bucket(logs: DataFrame, value_col: str, keys: list[str] | None = None,
                         buckets: DataFrame | None = None) -> DataFrame:
    """A32 + J3: most frequent value per bucket; ties -> smallest value.

    Counts are a partial-aggregated (bucket, value) group-by, so a hot
    (bucket, IP) pair is combined map-side; no group is collected.
    Output: keys, bucket, value.
    """
    keys = list(keys or [])
    df = _restrict(logs, buckets, keys).where(F.col(value_col).isNotNull())
    counts = df.groupBy(*keys, "bucket", value_col).agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(*keys, "bucket").agg(
        F.min_by(value_col, F.struct(-F.col("c"), F.col(value_col))).alias("value"))


def ids_in_bucket(logs: DataFrame, keys: list[str] | None = None,
                  buckets: DataFrame | None = None, max_ids: int = C.MAX_IDS_PER_BUCKET,
                  order_cols: tuple[str, ...] = ("timestamp", "_id")) -> DataFrame:
    """J4 + W3 + T6: the first ``max_ids`` log ids per bucket in (timestamp, _id) order.

    The cap is the feature (an evidence sample stored with each anomaly).
    ``row_number`` over a hot bucket would sort the whole bucket in one task,
    so each map partition first keeps only its own first ``max_ids`` rows per
    bucket (a per-partition top-k), and the final top-k runs over at most
    partitions x ``max_ids`` rows per bucket.
    Output: keys, bucket, ids array<string>.
    """
    keys = list(keys or [])
    df = _restrict(logs, buckets, keys).where(F.col("_id").isNotNull()).select(
        *keys, "bucket", *order_cols)
    order = [F.col(c) for c in order_cols]
    pid = F.spark_partition_id()
    local = df.withColumn("__p", pid).withColumn(
        "__r", F.row_number().over(Window.partitionBy("__p", *keys, "bucket").orderBy(*order)))
    local = local.where(F.col("__r") <= max_ids).drop("__r", "__p")
    w = Window.partitionBy(*keys, "bucket").orderBy(*order)
    ranked = local.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= max_ids)
    return ranked.groupBy(*keys, "bucket").agg(
        F.sort_array(F.collect_list(F.struct("__r", "_id"))).alias("__v")).select(
        *keys, "bucket", F.transform("__v", lambda e: e["_id"]).alias("ids"))
