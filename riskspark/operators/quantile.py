"""Exact, skew-proof per-group quantile (linear interpolation).

``percentile()`` keeps a value->count map per group and merges a group's maps
in one task, so a hot group (one bucket holding a third of all rows) lands in
one task.  This operator finds the two order statistics around the quantile
position with weighted ranks instead:

1. equal values of a group become one row with their count, before the shuffle
   (a value that most rows have is one row a task);
2. these rows are range-partitioned by (group, value): a hot group is split
   over many balanced partitions;
3. the counts summed up within a partition, and those of the partitions before
   it (a window over one row per partition and group), give each row the ranks
   that its value takes;
4. the rows whose ranks hold floor(pos) and ceil(pos) are interpolated.

The collapsed rows are checkpointed once: partition numbers must not change
between the sums and the pick.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import materialize, same_keys


def exact_quantile(df: DataFrame, group_cols: list[str], value: Column | str, q: float,
                   out: str, num_partitions: int | None = None) -> DataFrame:
    """One row per group that has a non-null value: group_cols + ``out`` (double)."""
    v = value if isinstance(value, Column) else F.col(value)
    vals = df.select(*group_cols, v.cast("double").alias("__v")).where(F.col("__v").isNotNull())
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = vals.groupBy(*group_cols, "__v").agg(F.count(F.lit(1)).alias("__c"))
    ranged = materialize(counted.repartitionByRange(n_parts, *group_cols, "__v")
                         .withColumn("__pid", F.spark_partition_id()))

    chunk = ["__pid", *group_cols]
    inside = F.sum("__c").over(Window.partitionBy(*chunk).orderBy("__v"))
    before = F.sum("__c").over(Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("__c").over(Window.partitionBy(*group_cols))
    chunks = (ranged.groupBy(*chunk).agg(F.sum("__c").alias("__c"))
              .select(*chunk, F.coalesce(before, F.lit(0)).alias("__before"),
                      ((total - 1).cast("double") * F.lit(float(q))).alias("__pos")))
    ranks = same_keys(ranged.withColumn("__up_to", inside), chunks, chunk)
    last = F.col("__before") + F.col("__up_to")  # the value takes the ranks last - c to last - 1

    def holds(rank: Column) -> Column:
        return (rank >= last - F.col("__c")) & (rank < last)

    lo, hi = F.floor("__pos"), F.ceil("__pos")
    res = ranks.where(holds(lo) | holds(hi)).groupBy(*group_cols).agg(
        F.first(F.col("__pos") - lo).alias("__frac"),
        F.max(F.when(holds(lo), F.col("__v"))).alias("__lo"),
        F.max(F.when(holds(hi), F.col("__v"))).alias("__hi"))
    return res.select(*group_cols, (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__frac")).alias(out))
