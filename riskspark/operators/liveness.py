"""Heartbeat liveness and model-version retention."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C


def seconds_since(t: Column, now: Column) -> Column:
    """Seconds from ``t`` to ``now``; null -> +infinity."""
    d = F.timestamp_diff("MICROSECOND", t, now).cast("double") / F.lit(1e6)
    return F.coalesce(d, F.lit(float("inf")))


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The latest row per key (max_by over a struct, partial-aggregated)."""
    cols = df.columns
    return (df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(ts))
                                .alias("__r")).select("__r.*"))


def liveness(heartbeats: DataFrame, now: Column, timeout_s: int = C.HEARTBEAT_TIMEOUT_SECONDS
             ) -> DataFrame:
    """Latest pulse per pipeline, lag in seconds and fresh/stale state."""
    last = latest_per_key(heartbeats, "pipeline_id", "sent_at")
    lag = seconds_since(F.col("sent_at"), now)
    return last.withColumn("lag_s", lag).withColumn(
        "state", F.when(F.col("sent_at").isNull(), "none")
        .when(F.col("lag_s") > F.lit(float(timeout_s)), "stale").otherwise("fresh"))


def expired_versions(versions: DataFrame, keep: int = C.KEEP_MODEL_VERSIONS,
                     col: str = "version") -> DataFrame:
    """Versions beyond the newest ``keep`` (the list to delete).

    Versions are one row per saved model (a handful), so a single ordered
    window is bounded.
    """
    w = Window.orderBy(F.col(col).desc())
    return versions.withColumn("recency", F.row_number().over(w)).withColumn(
        "expired", F.col("recency") > F.lit(keep))


def latest_version(versions: DataFrame, col: str = "version") -> DataFrame:
    """T5: the newest version."""
    return versions.agg(F.max(col).alias("latest_version"))


def empty_cycle_runs(cycles: DataFrame, n_empty: int = 2, order: str = "cycle",
                     count_col: str = "new_rows") -> DataFrame:
    """Every ``n_empty``-th cycle of a run of cycles without new rows; the count starts
    again after it, as local files are deleted then, and after a cycle with rows.

    Cycles are one row per trigger, never per record, so the ordered window is small.
    """
    empty = F.col(count_col) == 0
    run = F.sum(F.when(empty, 0).otherwise(1)).over(Window.orderBy(order))
    nth = F.sum(F.when(empty, 1).otherwise(0)).over(Window.partitionBy("__run").orderBy(order))
    return (cycles.withColumn("__run", run).withColumn(
        "retention_due", F.coalesce(empty & (nth % n_empty == 0), F.lit(False))).drop("__run"))
