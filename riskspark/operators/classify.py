"""Anomaly typing, grading and categorisation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import py_float_text, thousands_text
from .util import same_keys


def multi_bucket_runs(flagged: DataFrame, keys: list[str] | None = None,
                      gap_minutes: int = C.MULTI_BUCKET_GAP_MINUTES,
                      min_len: int = C.MULTI_BUCKET_N) -> DataFrame:
    """W1 gaps and islands over anomalous buckets.

    A new run starts where the gap to the previous anomalous bucket exceeds
    ``gap_minutes``; runs of at least ``min_len`` buckets are MULTI_BUCKET.
    Islands are found within (keys, day) and stitched over the days: the only window
    over more than a day has one row per key and day.
    Output: keys, bucket, run_id, run_len, in_multi_run.
    """
    keys = list(keys or [])

    def breaks(prev: Column, this: Column) -> Column:
        gap = F.timestamp_diff("SECOND", prev, this).cast("double") / F.lit(60.0)
        return (gap > F.lit(float(gap_minutes))).cast("int")

    day = Window.partitionBy(*keys, "__day").orderBy("bucket")
    rows = flagged.select(*keys, "bucket").withColumn("__day", F.to_date("bucket"))
    rows = rows.withColumn("__brk", F.coalesce(breaks(F.lag("bucket").over(day), F.col("bucket")), F.lit(0)))
    rows = rows.withColumn("__inside", F.sum("__brk").over(day.rowsBetween(Window.unboundedPreceding, 0)))
    days = rows.groupBy(*keys, "__day").agg(F.min("bucket").alias("__first"), F.max("bucket").alias("__last"),
                                            F.sum("__brk").alias("__n"))
    over_days = Window.partitionBy(*keys).orderBy("__day")
    new = F.coalesce(breaks(F.lag("__last").over(over_days), F.col("__first")), F.lit(1))
    days = days.withColumn("__new", new)
    before = F.coalesce(F.sum(F.col("__new") + F.col("__n")).over(over_days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.select(*keys, "__day", (before + F.col("__new")).alias("__before"))
    runs = same_keys(rows, days, [*keys, "__day"]).withColumn("run_id", F.col("__before") + F.col("__inside"))
    runs = runs.withColumn("run_len", F.count(F.lit(1)).over(Window.partitionBy(*keys, "run_id")))
    return runs.select(*keys, "bucket", "run_id", "run_len",
                       (F.col("run_len") >= min_len).alias("in_multi_run"))


def join_per_key(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Attach a one-row-per-key table (train statistics, totals).

    Keyed: equi-join on the keys (one row per key, whose number has no bound,
    so Spark chooses by its size).  Unkeyed: the single row is a scalar subquery (evaluated once),
    so no join at all.
    """
    if keys:
        return df.join(per_key, keys, "left")
    cols = [c for c in per_key.columns if c not in df.columns]
    one = per_key.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__s")).scalar()
    return df.withColumn("__s", one).select("*", *[F.col(f"__s.`{c}`").alias(c) for c in cols]) \
        .drop("__s")


def severity(score: Column, high_below: float = C.SEVERITY_HIGH_BELOW,
             medium_below: float = C.SEVERITY_MEDIUM_BELOW) -> Column:
    """M8: strict comparisons; thresholds are parameters."""
    return (F.when(score < F.lit(high_below), "HIGH")
            .when(score < F.lit(medium_below), "MEDIUM").otherwise("LOW"))


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    """Rule table (rule_ord, category, feature, weight) as a DataFrame."""
    rows = C.rules_rows() if rules is None else [
        (i, name, f, float(w)) for i, (name, ws) in enumerate(rules) for f, w in ws.items()]
    return spark.createDataFrame(rows, "rule_ord int, category string, feature string, weight double")


def attack_category(top_devs: DataFrame, rules: DataFrame, keys: list[str] | None = None,
                    min_score: float = C.ATTACK_MIN_SCORE,
                    default: str = C.DEFAULT_CATEGORY) -> DataFrame:
    """M9 + J8 + W5: sum weight x rounded z over the top deviations per rule.

    The best rule needs a score strictly above ``min_score``; among equal
    scores the earlier rule wins.  Sums are exact decimals (z has 2 dp).
    The rule table is a fixed, small constant, so it is broadcast.
    Output: keys, bucket, attack_category, category_score.
    """
    keys = list(keys or [])
    devs = top_devs.select(*keys, "bucket", F.explode("top_deviations").alias("d")).select(
        *keys, "bucket", F.col("d.feature").alias("feature"),
        F.col("d.z_score").cast("decimal(12,2)").alias("z"))
    scored = (devs.join(F.broadcast(rules), "feature")
              .groupBy(*keys, "bucket", "rule_ord", "category")
              .agg(F.sum(F.col("z") * F.col("weight").cast("decimal(6,0)")).alias("score")))
    best = scored.groupBy(*keys, "bucket").agg(
        F.max_by("category", F.struct(F.col("score"), -F.col("rule_ord"))).alias("cat"),
        F.max("score").alias("best"))
    base = top_devs.select(*keys, "bucket")
    j = base.join(best, [*keys, "bucket"], "left")
    ok = F.coalesce(F.col("best") > F.lit(min_score), F.lit(False))
    return j.select(*keys, "bucket",
                    F.when(ok, F.col("cat")).otherwise(F.lit(default)).alias("attack_category"),
                    F.when(ok, F.col("best").cast("double")).otherwise(F.lit(float(min_score)))
                    .alias("category_score"))


def anomaly_type(in_multi_run: Column, n_sys_requests: Column, spike_threshold: Column) -> Column:
    """M7: MULTI_BUCKET, else SPIKE above mean + 2.5 std, else CATEGORIZATION."""
    return (F.when(F.coalesce(in_multi_run, F.lit(False)), "MULTI_BUCKET")
            .when(n_sys_requests > spike_threshold, "SPIKE").otherwise("CATEGORIZATION"))


def spike_threshold(stats: DataFrame, sigma: float = C.SPIKE_SIGMA) -> Column:
    return F.col("n_requests_mean") + F.lit(sigma) * F.col("n_requests_std")


def reason(a_type: Column, top: Column, n_sys_requests: Column, threshold: Column) -> Column:
    """Reason text by type, from the first (strongest) deviation.

    Numbers print the way the original formats them: value and baseline
    rounded to 4 dp and z to 2 dp in shortest positional form, request
    counts and the spike threshold with thousands separators.
    """
    return reason_from_text(a_type, top, py_float_text(top["value"], 4),
                            py_float_text(top["z_score"], 2), py_float_text(top["baseline"], 4),
                            thousands_text(F.floor(n_sys_requests)), thousands_text(threshold))


def reason_from_text(a_type: Column, top: Column, value: Column, z: Column, base: Column,
                     n_text: Column, thr_text: Column) -> Column:
    label = top["label"]
    spike = F.concat(F.lit("Pico de tráfico: "), n_text,
                     F.lit(" requests en 5 min (umbral: "), thr_text,
                     F.lit("). Feature más desviada: "), label, F.lit(" = "), value,
                     F.lit(" (z="), z, F.lit(")."))
    multi = F.concat(F.lit("Patrón sostenido en múltiples ventanas. Feature dominante: "),
                     label, F.lit(" = "), value, F.lit(" (z="), z, F.lit(", baseline="),
                     base, F.lit(")."))
    other = F.concat(F.lit("Combinación inusual de patrones. Top feature: "), label,
                     F.lit(" = "), value, F.lit(" ("), top["direction"], F.lit(", z="), z,
                     F.lit(", baseline="), base, F.lit(")."))
    return (F.when(top.isNull(), F.lit(C.REASON_NO_DEVIATION))
            .when(a_type == "SPIKE", spike).when(a_type == "MULTI_BUCKET", multi)
            .otherwise(other))


def classify(flagged: DataFrame, features: DataFrame, top_devs: DataFrame,
             stats: DataFrame, rules: DataFrame, keys: list[str] | None = None,
             gap_minutes: int = C.MULTI_BUCKET_GAP_MINUTES) -> DataFrame:
    """Classify flagged buckets: type, severity, top deviations, reason, category.

    ``flagged``: keys, bucket, anomaly_score (flagged buckets only).
    ``stats``: train statistics per key (A27).  All inputs are bucket-level
    tables; joins are on (keys, bucket) or keys.
    """
    keys = list(keys or [])
    k = [*keys, "bucket"]
    runs = multi_bucket_runs(flagged, keys, gap_minutes)
    cat = attack_category(top_devs, rules, keys)
    thr = stats.select(*keys, spike_threshold(stats).alias("spike_threshold"))
    j = (flagged.join(runs.select(*k, "in_multi_run"), k, "left")
         .join(features.select(*k, "n_sys_requests"), k, "left")
         .join(top_devs, k, "left")
         .join(cat, k, "left"))
    j = join_per_key(j, thr, keys)
    n_req = F.coalesce(F.col("n_sys_requests"), F.lit(0.0))
    a_type = anomaly_type(F.col("in_multi_run"), n_req, F.col("spike_threshold"))
    devs = F.coalesce(F.col("top_deviations"), F.array().cast(top_devs.schema["top_deviations"].dataType))
    typed = j.select(
        *k, a_type.alias("anomaly_type"), severity(F.col("anomaly_score")).alias("severity"),
        "anomaly_score", devs.alias("top_deviations"),
        F.coalesce(F.col("attack_category"), F.lit(C.DEFAULT_CATEGORY)).alias("attack_category"),
        n_req.alias("__n"), F.col("spike_threshold").alias("__thr"))
    # Number texts first, in their own projection, so the reason expression stays small.
    top = F.get(F.col("top_deviations"), 0)
    texts = typed.select(
        "*", py_float_text(top["value"], 4).alias("__v"), py_float_text(top["z_score"], 2).alias("__z"),
        py_float_text(top["baseline"], 4).alias("__b"),
        thousands_text(F.floor(F.col("__n"))).alias("__nt"), thousands_text(F.col("__thr")).alias("__tt"))
    out = texts.withColumn("reason", reason_from_text(
        F.col("anomaly_type"), top, F.col("__v"), F.col("__z"), F.col("__b"), F.col("__nt"),
        F.col("__tt")))
    return out.select(*k, "anomaly_type", "severity", "anomaly_score", "top_deviations", "reason",
                      "attack_category")
