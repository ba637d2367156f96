"""The explained detection chain as reusable plan pieces.

features -> baseline -> z-scores -> top deviations -> detector flags ->
runs / type / severity / category / reason.  Every table after the feature
matrix is bucket-sized (rows grow with time span and keys, not with log
volume).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import baseline as BL
from ..operators import classify as CL
from ..operators.features import build_features
from ..operators.util import materialize
from .common import QUERY_BUCKET, logs


def bucket_minutes(bucket: str) -> int:
    n, unit = bucket.split()
    return int(n) * {"minute": 1, "hour": 60, "day": 1440}[unit.rstrip("s")]


def run_gap_minutes(bucket: str) -> int:
    """W1 gap scaled to the bucket: 10 min for 5-minute buckets (two buckets)."""
    return C.MULTI_BUCKET_GAP_MINUTES * bucket_minutes(bucket) // 5


@dataclass
class Chain:
    features: DataFrame
    base: DataFrame
    z: DataFrame
    top: DataFrame
    detector: DataFrame
    stats: DataFrame
    rules: DataFrame
    keys: list
    bucket: str

    def flagged(self) -> DataFrame:
        return self.detector.where("is_anomaly").select(*self.keys, "bucket", "anomaly_score")

    _anoms: DataFrame | None = None

    def anomalies(self) -> DataFrame:
        """Classified anomalies, materialised once (they feed several outputs)."""
        if self._anoms is None:
            self._anoms = materialize(CL.classify(
                self.flagged(), self.features, self.top, self.stats, self.rules, self.keys,
                run_gap_minutes(self.bucket)))
        return self._anoms


def z_chain(spark: SparkSession, sf_dir: str, bucket: str = QUERY_BUCKET,
            keys: list | None = None, threshold: float = 5.0,
            features: DataFrame | None = None) -> Chain:
    """Baseline = the whole feature matrix (the fixtures' incidents lie inside it)."""
    keys = list(keys or [])
    if features is None:
        system, llm = logs(spark, sf_dir)
        features = materialize(build_features(system, llm, bucket, keys))
    base = materialize(BL.baseline(features, keys))
    arrays = materialize(BL.zscore_arrays(features, base, keys))
    top, det = BL.top_deviations(arrays, keys), BL.z_detector(arrays, keys, threshold)
    z = BL.zscores(arrays, keys)
    stats = BL.train_stats(base, keys)
    return Chain(features, base, z, top, det, stats, CL.rules_frame(spark), keys, bucket)


def with_bucket_context(anoms: DataFrame, features: DataFrame, keys: list) -> DataFrame:
    """n_requests, error_rate, n_unique_ips from the feature row (0 when absent)."""
    k = [*keys, "bucket"]
    f = features.select(*k, F.col("n_sys_requests").alias("n_requests"), "error_rate",
                        "n_unique_ips")
    j = anoms.join(f, k, "left")
    return j.fillna(0.0, subset=["n_requests", "error_rate", "n_unique_ips"])
