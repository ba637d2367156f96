"""Global span and progress aggregates."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def span_hours(lo: F.Column, hi: F.Column) -> F.Column:
    """(hi - lo) in hours as double (timestamp_ntz, session-zone free)."""
    return F.timestamp_diff("MICROSECOND", lo, hi).cast("double") / F.lit(3.6e9)


def _gate(agg: DataFrame, required_hours: float) -> DataFrame:
    """Span, progress and training gate of one row (min_ts, max_ts, n_rows)."""
    span = span_hours(F.col("min_ts"), F.col("max_ts"))
    return agg.select(
        "min_ts", "max_ts", "n_rows",
        span.alias("span_hours"),
        F.least(span / F.lit(float(required_hours)) * 100, F.lit(100.0)).alias("pct_ready"),
        F.greatest(F.lit(float(required_hours)) - span, F.lit(0.0)).alias("hours_missing"),
        F.coalesce(span >= F.lit(float(required_hours)), F.lit(False)).alias("ready"),
    )


def data_span(table: DataFrame, required_hours: float = C.MIN_TRAINING_HOURS,
              ts_col: str = "timestamp") -> DataFrame:
    """A22 + F13 + P28: min, max, count, span in hours, progress, training gate."""
    return _gate(table.agg(F.min(ts_col).alias("min_ts"), F.max(ts_col).alias("max_ts"),
                           F.count(F.lit(1)).alias("n_rows")), required_hours)


def zone_span(zones: DataFrame, required_hours: float = C.MIN_TRAINING_HOURS) -> DataFrame:
    """The same from a table's zones (one row a day), without a scan of its rows."""
    return _gate(zones.agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"),
                           F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows")), required_hours)


def progress_mark(table: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """MAX(timestamp) as the progress mark."""
    return table.agg(F.max(ts_col).alias("progress_mark"))


def two_table_span(a: DataFrame, b: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """min/max/span over the union of two timestamp columns (nulls dropped)."""
    u = a.select(F.col(ts_col).alias("ts")).unionAll(b.select(F.col(ts_col).alias("ts")))
    u = u.where(F.col("ts").isNotNull())
    agg = u.agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"),
                F.count(F.lit(1)).alias("n_rows"))
    return agg.withColumn("span_hours", span_hours(F.col("min_ts"), F.col("max_ts")))


def catchup_gap(fresh_sys: DataFrame, fresh_llm: DataFrame, last_scored,
                threshold_hours: float = C.CATCHUP_GAP_HOURS, ts_col: str = "timestamp"
                ) -> DataFrame:
    """gap (hours) from the last scored instant to the first fresh row; catch-up flag."""
    last = F.lit(last_scored).cast("timestamp_ntz") if isinstance(last_scored, str) else last_scored
    first = two_table_span(fresh_sys, fresh_llm, ts_col).select("min_ts")
    gap = span_hours(last, F.col("min_ts"))
    return first.select(
        last.alias("last_scored_until"), F.col("min_ts").alias("fresh_min"),
        gap.alias("gap_hours"),
        F.coalesce(gap > F.lit(float(threshold_hours)), F.lit(False)).alias("catch_up"))
