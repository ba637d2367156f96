"""Anomaly records as stored (K6): explained anomalies + bucket context + evidence."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import audit as AU
from ..operators.logsets import ids_in_bucket, top_value_per_bucket
from ..operators.merge import anomaly_id
from ..operators.prepare import clean_llm, clean_system
from ..operators.util import materialize
from .common import QUERY_BUCKET, logs
from .detect import Chain, bucket_minutes, with_bucket_context, z_chain


def build_records(anoms: DataFrame, features: DataFrame, sysb: DataFrame, llmb: DataFrame,
                  keys: list, bucket: str, hst_flags: DataFrame | None = None) -> DataFrame:
    """K6 rows from classified anomalies.

    ``sysb``/``llmb``: cleaned logs with their ``bucket`` column.  Evidence
    (top IP, first ids) is looked up only in the anomalous buckets.
    """
    k = [*keys, "bucket"]
    anoms = with_bucket_context(anoms, features, keys)
    which = anoms.select(*k)
    tip = top_value_per_bucket(sysb, "sourceip", keys, which).withColumnRenamed("value", "top_ip")
    sids = ids_in_bucket(sysb, keys, which).withColumnRenamed("ids", "sys_log_ids")
    lids = ids_in_bucket(llmb, keys, which).withColumnRenamed("ids", "llm_log_ids")
    snap = features.select(*k, AU.feature_snapshot(features).alias("feature_snapshot"))
    j = (anoms.join(tip, k, "left").join(sids, k, "left").join(lids, k, "left")
         .join(snap, k, "left"))
    if hst_flags is not None:
        j = j.join(hst_flags.select(*k, F.col("hst_flag").alias("hst_confirmed")), k, "left")
    else:
        j = j.withColumn("hst_confirmed", F.lit(False))
    details = AU.details_struct(F.col("top_deviations"), F.col("sys_log_ids"),
                                F.col("llm_log_ids"), F.col("feature_snapshot"))
    minutes = bucket_minutes(bucket)
    return materialize(j.select(
        *keys,
        anomaly_id([F.col(c) for c in keys], F.col("bucket")).alias("anomaly_id"),
        (F.col("bucket") + F.expr(f"INTERVAL {minutes} MINUTES")).alias("detected_at"),
        F.col("bucket").alias("bucket_start"),
        "anomaly_type", "severity", "anomaly_score",
        F.col("n_requests").cast("int").alias("n_requests"),
        F.col("n_unique_ips").cast("int").alias("n_unique_ips"),
        "error_rate", "top_ip",
        F.substring("reason", 1, 500).alias("reason"),
        details.alias("details"),
        AU.encode_details(details).alias("details_json"),
        F.substring("attack_category", 1, 100).alias("attack_category"),
        F.coalesce(F.col("hst_confirmed"), F.lit(False)).alias("hst_confirmed"),
        F.col("top_deviations"),
    ))


def anomaly_records(spark: SparkSession, sf_dir: str, bucket: str = QUERY_BUCKET,
                    chain: Chain | None = None, hst_flags: DataFrame | None = None) -> DataFrame:
    """Records of the deterministic chain over the derived logs."""
    ch = chain or z_chain(spark, sf_dir, bucket)
    system, llm = logs(spark, sf_dir)
    return build_records(ch.anomalies(), ch.features, clean_system(system, bucket),
                         clean_llm(llm, bucket), ch.keys, bucket, hst_flags)


__all__ = ["anomaly_records", "build_records", "C"]
