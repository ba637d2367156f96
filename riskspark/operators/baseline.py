"""Baseline statistics, scaling and z-score explanation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import half_even, lookup


def feature_ord(name: Column, features: list[str] = C.FEATURE_COLS) -> Column:
    return lookup({f: i for i, f in enumerate(features)}, name).cast("int")


def feature_label(name: Column) -> Column:
    """Label with fallback to the feature name."""
    return lookup(C.FEATURE_LABELS, name)


def unpivot_features(features: DataFrame, keys: list[str] | None = None,
                     cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """Wide feature matrix -> (keys, bucket, feature, value) with null -> 0 (M2)."""
    ids = [*(keys or []), "bucket"]
    filled = features.select(*ids, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                     for c in cols])
    return filled.unpivot(ids, cols, "feature", "value")


def baseline(features: DataFrame, keys: list[str] | None = None,
             cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """A26 (+M1 statistics): per (keys, feature) mean, sample std + 1e-6, population std.

    One hash aggregate over the unpivoted matrix; partial aggregation keeps
    the shuffle at (keys x features) rows per map task.
    """
    keys = list(keys or [])
    long = unpivot_features(features, keys, cols)
    return long.groupBy(*keys, "feature").agg(
        F.avg("value").alias("mean"),
        (F.stddev_samp("value") + F.lit(C.STD_EPSILON)).alias("std"),
        F.stddev_pop("value").alias("std_pop"),
        F.count(F.lit(1)).alias("n_buckets"),
    )


def with_baseline(features: DataFrame, base: DataFrame, keys: list[str],
                  cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """(keys, bucket, x, b): a bucket's values in feature order (null -> 0), and its key's baseline as an
    array of (feature_ord, feature, mean, std, std_pop), at most one a feature.

    A bucket stays one row: the baseline is a scalar where there are no keys, and else joined by them.
    """
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]).alias("x")
    rows = features.select(*keys, "bucket", x)
    stat = F.struct(feature_ord(F.col("feature"), cols).alias("feature_ord"), "feature", "mean", "std", "std_pop")
    packed = (base.where(F.col("feature").isin(cols)).groupBy(*keys)
              .agg(F.sort_array(F.collect_list(stat)).alias("b")))
    if keys:
        return rows.join(packed, keys)
    return rows.withColumn("b", packed.scalar()).where(F.size("b") > 0)


def train_stats(base: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Request mean/std, number of buckets, number of features per key."""
    keys = list(keys or [])
    return base.groupBy(*keys).agg(
        F.max(F.when(F.col("feature") == "n_sys_requests", F.col("mean"))).alias("n_requests_mean"),
        F.max(F.when(F.col("feature") == "n_sys_requests", F.col("std"))).alias("n_requests_std"),
        F.max("n_buckets").alias("n_buckets"),
        F.count(F.lit(1)).alias("used_features"),
    )


def scaled(features: DataFrame, base: DataFrame, keys: list[str] | None = None,
           cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """M1: (x - mean) / population std (zero std -> 1), long form."""
    keys = list(keys or [])
    parts = F.transform("b", lambda e: F.struct(e["feature"].alias("feature"), _scale(F.col("x"), e).alias("x")))
    return (with_baseline(features, base, keys, cols).select(*keys, "bucket", F.explode(parts).alias("e"))
            .select(*keys, "bucket", "e.*"))


def _scale(x: Column, stat: Column) -> Column:
    sd = F.when(F.coalesce(stat["std_pop"], F.lit(0.0)) == 0, F.lit(1.0)).otherwise(stat["std_pop"])
    return (F.get(x, stat["feature_ord"]) - stat["mean"]) / sd


def feature_vector(features: DataFrame, base: DataFrame | None = None,
                   keys: list[str] | None = None, cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """M2 (+M1): (keys, bucket, x array<double>) in feature order, null -> 0."""
    keys = list(keys or [])
    if base is None:
        return features.select(*keys, "bucket", F.array(*[
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]).alias("x"))
    return with_baseline(features, base, keys, cols).select(
        *keys, "bucket", F.transform("b", lambda e: _scale(F.col("x"), e)).alias("x"))


def zscore_arrays(features: DataFrame, base: DataFrame, keys: list[str] | None = None,
                  cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """J7 + P15 + P16: every feature of every bucket against its baseline: (keys, bucket, z).

    ``z`` has a struct for each feature, in their order: feature, feature_ord, label,
    value (4 dp), baseline (4 dp), z_raw, z_score (2 dp, half-even), direction.  z is
    null when the baseline has one bucket (sample std undefined).
    """
    keys = list(keys or [])

    def against(e: Column) -> Column:
        value = F.get(F.col("x"), e["feature_ord"])
        z = (value - e["mean"]) / e["std"]
        return F.struct(
            e["feature"].alias("feature"), e["feature_ord"].alias("feature_ord"),
            feature_label(e["feature"]).alias("label"),
            half_even(value, 4).alias("value"), half_even(e["mean"], 4).alias("baseline"),
            z.alias("z_raw"), half_even(z, 2).alias("z_score"),
            F.when(z > 0, F.lit(C.DIRECTION_UP)).otherwise(F.lit(C.DIRECTION_DOWN)).alias("direction"))

    return with_baseline(features, base, keys, cols).select(*keys, "bucket", F.transform("b", against).alias("z"))


def zscores(arrays: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The same as a row for each bucket and feature."""
    return arrays.select(*(keys or []), "bucket", F.explode("z").alias("e")).select(*(keys or []), "bucket", "e.*")


DEVIATION_FIELDS = ["feature", "label", "value", "baseline", "z_score", "direction"]


def top_deviations(arrays: DataFrame, keys: list[str] | None = None, top_n: int = C.TOP_DEVIATIONS
                   ) -> DataFrame:
    """M6 + W4: the top-n deviations per bucket by |rounded z|, ties in feature order.

    A sort within each bucket's array of features: no shuffle.  Buckets without any z are left out.
    Output: keys, bucket, top_deviations array<struct> (rank order).
    """
    scored = F.filter("z", lambda e: e["z_score"].isNotNull())
    order = F.sort_array(F.transform(scored, lambda e: F.struct(
        F.abs(e["z_score"]).alias("a"), (-e["feature_ord"]).alias("o"), e.alias("e"))), asc=False)
    devs = F.transform(F.slice(order, 1, top_n), lambda s: F.struct(
        *[s["e"][f].alias(f) for f in DEVIATION_FIELDS])).alias("top_deviations")
    return arrays.select(*(keys or []), "bucket", devs).where(F.size("top_deviations") > 0)


def z_detector(arrays: DataFrame, keys: list[str] | None = None, threshold: float = 5.0
               ) -> DataFrame:
    """Deterministic statistical detector: max |z| over features above a threshold.

    |z| is compared after round(., 6).  anomaly_score = -m / (m + threshold),
    in (-1, 0], lower is more anomalous (the same orientation as the forest).
    """
    keys = list(keys or [])
    top = F.array_max(F.transform("z", lambda e: F.abs(F.round(e["z_raw"], 6))))
    m = arrays.select(*keys, "bucket", top.alias("max_abs_z"))
    mz = F.coalesce(F.col("max_abs_z"), F.lit(0.0))
    return m.select(*keys, "bucket", mz.alias("max_abs_z"),
                    (-mz / (mz + F.lit(float(threshold)))).alias("anomaly_score"),
                    (mz > F.lit(float(threshold))).alias("is_anomaly"))
