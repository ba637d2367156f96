"""Keyed merge, dedup and append accounting.

Every operator here is an aggregation keyed by the record key, never a
window or a join on it: ``max_by`` keeps the latest copy with partial
aggregation, so even a key holding a third of all rows (e.g. records
missing their id) is combined map-side and never sorted in one task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_keep_last(df: DataFrame, key: str = "_id",
                    order: list[str] | tuple[str, ...] = ("batch_seq",)) -> DataFrame:
    """One row per key, the latest by ``order`` (later batch, later position wins)."""
    cols = df.columns
    rank = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), rank)
                                .alias("__r"))
            .select("__r.*"))


def upsert(old: DataFrame, new: DataFrame, key: str = "_id", seq_col: str = "__seq") -> DataFrame:
    """K1 + J10: latest-wins merge of ``new`` into ``old`` (idempotent on replay).

    Equivalent to new UNION (old LEFT ANTI new) with latest-wins inside new,
    expressed as one keyed aggregation: old rows get sequence 0, new rows 1.
    """
    seq_old = old.withColumn(seq_col, F.lit(0))
    seq_new = new.withColumn(seq_col, F.lit(1) if seq_col not in new.columns else F.col(seq_col))
    both = seq_old.unionByName(seq_new, allowMissingColumns=True)
    return dedup_keep_last(both, key, (seq_col,)).drop(seq_col)


def new_row_count(existing: DataFrame, new: DataFrame, key: str = "_id") -> DataFrame:
    """K4: rows an append adds = distinct new keys not present before (one row: new_rows)."""
    e = existing.select(F.col(key).alias("k"), F.lit(1).alias("old"), F.lit(0).alias("new"))
    n = new.select(F.col(key).alias("k"), F.lit(0).alias("old"), F.lit(1).alias("new"))
    per_key = e.unionByName(n).groupBy("k").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return per_key.agg(F.count_if((F.col("new") == 1) & (F.col("old") == 0)).alias("new_rows"))


def anomaly_id(keys: list[Column], bucket: Column) -> Column:
    """P25: deterministic id of an anomaly (same bucket -> same id, so replays upsert)."""
    return F.sha2(F.concat_ws(":", *keys, bucket.cast("string")), 256)
