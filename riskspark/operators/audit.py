"""Audit report as DataFrames."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, MapType, StringType, StructField,
                               StructType)

from .. import constants as C
from ..functions.columns import lookup
from .util import broadcast_if_small

DEVIATION = StructType([StructField("feature", StringType()), StructField("label", StringType()),
                        StructField("value", DoubleType()), StructField("baseline", DoubleType()),
                        StructField("z_score", DoubleType()), StructField("direction", StringType())])
DETAILS = StructType([
    StructField("top_deviations", ArrayType(DEVIATION)),
    StructField("sys_log_ids", ArrayType(StringType())),
    StructField("llm_log_ids", ArrayType(StringType())),
    StructField("feature_snapshot", MapType(StringType(), DoubleType())),
])


def feature_snapshot(features: DataFrame, cols: list[str] = C.FEATURE_COLS) -> Column:
    """Feature -> value (4 dp) map of a feature row."""
    from ..functions.columns import half_even
    return F.create_map(*[x for c in cols for x in (F.lit(c), half_even(F.col(c), 4))])


def details_struct(top: Column, sys_ids: Column, llm_ids: Column, snapshot: Column) -> Column:
    empty = F.array().cast(ArrayType(StringType()))
    return F.struct(top.alias("top_deviations"), F.coalesce(sys_ids, empty).alias("sys_log_ids"),
                    F.coalesce(llm_ids, empty).alias("llm_log_ids"),
                    snapshot.alias("feature_snapshot"))


def encode_details(details: Column) -> Column:
    """Details as JSON text."""
    return F.to_json(details)


def decode_details(text: Column) -> Column:
    """P23 + S11: null-safe JSON decode of details."""
    return F.from_json(F.coalesce(text, F.lit("{}")), DETAILS)


def summary_counts(anomalies: DataFrame) -> DataFrame:
    """Anomalies per (type, severity)."""
    return anomalies.groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("count"))


def bar(value: Column, max_val: float = 5.0, width: int = C.BAR_WIDTH) -> Column:
    """Text bar; filled = int(value / max * width) (truncated)."""
    filled = (value / F.lit(max_val) * F.lit(width)).cast("int") if max_val else F.lit(0)
    return F.concat(F.repeat(F.lit("█"), filled),
                    F.repeat(F.lit("░"), F.lit(width) - filled))


def severity_mark(sev: Column) -> Column:
    """Severity mark with a default."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in C.SEVERITY_MARKS.items()
                                                      for x in kv]), sev),
                      F.lit(C.SEVERITY_MARK_DEFAULT))


def worst(anomalies: DataFrame, top_n: int = 10) -> DataFrame:
    """The N most anomalous (lowest score first; bucket breaks ties)."""
    return anomalies.orderBy(F.col("anomaly_score").asc(), F.col("bucket_start").asc()).limit(top_n)


def logs_of_anomalies(anomalies: DataFrame, logs: DataFrame, ids_col: str,
                      max_ids: int = C.MAX_IDS_PER_LOOKUP) -> DataFrame:
    """S9 + J9 + T3: the stored logs of each anomaly's first ``max_ids`` ids, by time.

    The id lists are exploded (<= 30 per anomaly) and equi-joined on _id.
    """
    ids = anomalies.select("anomaly_id", "bucket_start",
                           F.explode(F.slice(F.col(ids_col), 1, max_ids)).alias("_id"))
    return ids.join(logs, "_id")


def logs_in_anomalies(anomalies: DataFrame, logs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every log of the anomalies' buckets (``logs`` has its ``bucket``), not only those shown."""
    k = [*(keys or []), "bucket"]
    which = anomalies.select(*(keys or []), F.col("bucket_start").alias("bucket")).distinct()
    return logs.join(broadcast_if_small(which), k, "left_semi")


def log_totals(system: DataFrame, llm: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per bucket logs, security events, and the exact sum of the cost."""
    k = [*(keys or []), "bucket"]
    a = system.groupBy(*k).agg(F.count(F.lit(1)).alias("n_sys_logs"),
                               F.count_if(truthy_any(F.col("is_security_event"))).alias("n_security"))
    b = llm.groupBy(*k).agg(F.count(F.lit(1)).alias("n_llm_logs"),
                            F.sum(F.col("llm_cost_usd").cast("decimal(28,10)")).cast("double").alias("total_cost"))
    return a.join(b, k, "full")


def value_counts(logs: DataFrame, group: list[str], col: str, top_n: int | None = None
                 ) -> DataFrame:
    """Value counts per group, most frequent first (ties by value); optional top-n."""
    c = logs.where(F.col(col).isNotNull()).groupBy(*group, col).agg(F.count(F.lit(1)).alias("n"))
    if top_n is None:
        return c
    w = Window.partitionBy(*group).orderBy(F.col("n").desc(), F.col(col).asc())
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def truthy_any(c: Column) -> Column:
    """membership in [1, True, 'true', 'True']."""
    return F.lower(c.cast("string")).isin("1", "true")


def category_share(anomalies: DataFrame, dim: str) -> DataFrame:
    """Count per value of ``dim`` and its share of all anomalies."""
    c = anomalies.groupBy(dim).agg(F.count(F.lit(1)).alias("n"))
    total = anomalies.agg(F.count(F.lit(1)).alias("total"))
    from .classify import join_per_key
    return join_per_key(c, total, []).select(
        F.lit(dim).alias("dim"), F.col(dim).cast("string").alias("value"), "n",
        (F.col("n") / F.col("total")).alias("share"))
