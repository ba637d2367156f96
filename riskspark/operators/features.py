"""Per-bucket feature matrix.

Plan shape per side: one wide hash aggregate (counts, rates, sums, avg, min,
max: partial + final, so a hot bucket is combined map-side) plus one long-form
pre-aggregate of (bucket, dimension, value) counts for the distinct-value,
top-share and entropy features.  The long form replaces several
``count_distinct`` in one aggregate (which would Expand every row once per
distinct column into the shuffle) by an explode that is collapsed by the
partial aggregate in the same stage.  Both results are keyed by
(keys, bucket) and joined; the two sides are then full-outer joined (J1).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import bucket_start, safe_rate
from .prepare import clean_llm, clean_system
from .quantile import exact_quantile


def _rate(cond: Column) -> Column:
    return safe_rate(F.count_if(cond), F.count(F.lit(1)))


def exact_avg(c: Column, scale: int = 10) -> Column:
    """Mean of decimal-valued measures (scores, money, ms) summed exactly.

    The stored columns are DECIMAL; summing them as decimals keeps the mean
    independent of partitioning and summation order.
    """
    n = F.count(c)
    return F.when(n > 0, F.sum(c.cast(f"decimal(28,{scale})")).cast("double") / n)


def exact_sum(c: Column, scale: int = 10) -> Column:
    return F.sum(c.cast(f"decimal(28,{scale})")).cast("double")


def _value_stats(df: DataFrame, group: list[str], dims: dict[str, Column],
                 entropy_dims: tuple[str, ...] = ()) -> DataFrame:
    """Distinct count, top count (and entropy) per group for several dimensions.

    One explode of (dimension, value) per row, collapsed by a partial
    aggregate in the scan stage; the shuffle carries only distinct
    (group, dimension, value) counts, and one more aggregate finishes every
    dimension at once (no window, no second scan).

    Entropy uses H = ln T - (1/T) sum c ln c - k * eps for value counts c
    (T their sum, k their number): the expansion of -sum p ln(p + eps) to
    first order in eps = 1e-10, whose remainder (below eps^2 T) is far under
    double precision of the result.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("d"), c.cast("string").alias("v"))
                        for name, c in dims.items()])
    long = (df.select(*group, F.explode(entries).alias("e"))
            .select(*group, F.col("e.d").alias("d"), F.col("e.v").alias("v"))
            .where(F.col("v").isNotNull())
            .groupBy(*group, "d", "v").agg(F.count(F.lit(1)).alias("cnt")))
    aggs = []
    for name in dims:
        is_d = F.col("d") == name
        aggs.append(F.count_if(is_d).alias(f"nd_{name}"))
        aggs.append(F.max(F.when(is_d, F.col("cnt"))).alias(f"top_{name}"))
    for name in entropy_dims:
        is_d = F.col("d") == name
        c = F.col("cnt").cast("double")
        aggs.append(F.sum(F.when(is_d, c)).alias(f"__t_{name}"))
        aggs.append(F.sum(F.when(is_d, c * F.log(c))).alias(f"__s_{name}"))
    stats = long.groupBy(*group).agg(*aggs)
    for name in entropy_dims:
        t, sc, k = F.col(f"__t_{name}"), F.col(f"__s_{name}"), F.col(f"nd_{name}")
        ent = F.log(t) - sc / t - k.cast("double") * F.lit(C.ENTROPY_EPSILON)
        stats = stats.withColumn(f"ent_{name}", ent).drop(f"__t_{name}", f"__s_{name}")
    return stats


def system_rates() -> dict[str, Column]:
    """Shares of a bucket's (cleaned) system rows, by the feature's name."""
    http, lt, method = F.col("http_status_code"), F.col("logtype"), F.col("headers_http_request_method")
    return {
        "error_rate": http >= 400,
        "client_error_rate": (http >= 400) & (http < 500),
        "server_error_rate": http >= 500,
        "rate_limit_rate": http == 429,
        "timeout_http_rate": http == 408,
        "pct_error_logtype": lt == "ERROR",
        "pct_warning_logtype": lt == "WARNING",
        "pct_security_logtype": lt == "SECURITY",
        "pct_audit_logtype": lt == "AUDIT",
        "security_event_rate": F.col("is_security_event") == 1,
        "pct_post": method == "POST",
        "pct_delete": method == "DELETE",
        "pct_low_score": F.col("_score") < C.LOW_SCORE_BELOW,
        "pct_production": F.col("sap_app_env") == "production",
    }


def system_dims() -> dict[str, Column]:
    """What the distinct counts, top shares and the entropy of system rows are taken of."""
    return {"ip": F.col("sourceip"), "lt": F.col("logtype"), "method": F.col("headers_http_request_method"),
            "svc": F.col("port_service"), "region": F.col("macro_region"), "env": F.col("sap_app_env")}


def llm_rates() -> dict[str, Column]:
    """Shares of a bucket's (cleaned) LLM rows."""
    return {
        "llm_error_rate": F.col("logtype") == "LLM_ERROR",
        "llm_timeout_rate": F.col("logtype") == "LLM_TIMEOUT",
        "pct_slow_llm": F.col("llm_response_time_ms") > C.SLOW_LLM_MS,
        "pct_content_filter": F.col("llm_finish_reason") == "content_filter",
    }


def system_features(system: DataFrame, bucket: str = C.BUCKET,
                    keys: list[str] | None = None, clean: bool = True) -> DataFrame:
    """26 system features per (keys, bucket)."""
    keys = list(keys or [])
    df = clean_system(system) if clean else system
    df = df.withColumn("bucket", bucket_start(F.col("timestamp"), bucket)).where(
        F.col("bucket").isNotNull())
    group = [*keys, "bucket"]
    n = F.count(F.lit(1))
    main = df.groupBy(*group).agg(
        n.cast("double").alias("n_sys_requests"),
        *[_rate(c).alias(name) for name, c in system_rates().items()],
        F.sum("is_security_event").cast("double").alias("n_security_events"),
        exact_avg(F.col("_score")).alias("avg_score"),
        F.min("_score").cast("double").alias("min_score"),
    )
    dstats = _value_stats(df, group, system_dims(), ("method",))
    j = main.join(dstats, group, "left")
    nn = F.col("n_sys_requests")
    ent = F.when(F.col("nd_method") > 1, F.coalesce(F.col("ent_method"), F.lit(0.0))).otherwise(
        F.lit(0.0))
    out = j.select(
        *group,
        "n_sys_requests",
        F.coalesce(F.col("nd_ip"), F.lit(0)).cast("double").alias("n_unique_ips"),
        safe_rate(F.coalesce(F.col("top_ip"), F.lit(0)), nn).alias("top_ip_share"),
        "error_rate", "client_error_rate", "server_error_rate", "rate_limit_rate",
        "timeout_http_rate", "pct_error_logtype", "pct_warning_logtype",
        "pct_security_logtype", "pct_audit_logtype",
        F.coalesce(F.col("nd_lt"), F.lit(0)).cast("double").alias("n_unique_logtypes"),
        "security_event_rate", "n_security_events",
        ent.alias("method_entropy"),
        "pct_post", "pct_delete", "avg_score", "min_score", "pct_low_score",
        F.coalesce(F.col("nd_svc"), F.lit(0)).cast("double").alias("n_unique_services"),
        F.coalesce(F.col("nd_region"), F.lit(0)).cast("double").alias("n_unique_regions"),
        safe_rate(F.coalesce(F.col("top_region"), F.lit(0)), nn).alias("top_region_share"),
        "pct_production",
        F.coalesce(F.col("nd_env"), F.lit(0)).cast("double").alias("n_unique_envs"),
    )
    return out


def llm_features(llm: DataFrame, bucket: str = C.BUCKET, keys: list[str] | None = None,
                 clean: bool = True, exact_p95: bool = True) -> DataFrame:
    """15 LLM features per (keys, bucket)."""
    keys = list(keys or [])
    df = clean_llm(llm) if clean else llm
    df = df.withColumn("bucket", bucket_start(F.col("timestamp"), bucket)).where(
        F.col("bucket").isNotNull())
    group = [*keys, "bucket"]
    lat, cost, tok = F.col("llm_response_time_ms"), F.col("llm_cost_usd"), F.col("llm_total_tokens")
    zero = F.lit(0.0)
    aggs = [
        F.count(F.lit(1)).cast("double").alias("n_llm_requests"),
        *[_rate(c).alias(name) for name, c in llm_rates().items()],
        F.coalesce(exact_avg(lat, 6), zero).alias("avg_llm_latency"),
        F.coalesce(F.max(lat), zero).alias("max_llm_latency"),
        F.coalesce(exact_avg(cost), zero).alias("avg_llm_cost"),
        F.coalesce(exact_sum(cost), zero).alias("total_llm_cost"),
        F.coalesce(F.max(cost), zero).alias("max_llm_cost"),
        F.coalesce(F.avg(tok), zero).alias("avg_tokens"),
        F.coalesce(F.max(tok), zero).alias("max_tokens"),
        exact_avg(F.col("_score")).alias("avg_llm_score"),
    ]
    if not exact_p95:
        aggs.append(F.coalesce(F.percentile_approx(lat, 0.95, 10000).cast("double"), zero)
                    .alias("p95_llm_latency"))
    main = df.groupBy(*group).agg(*aggs)
    models = _value_stats(df, group, {"model": F.col("llm_model_id")}).select(
        *group, F.col("nd_model").cast("double").alias("n_unique_models"))
    j = main.join(models, group, "left")
    if exact_p95:
        p95 = exact_quantile(df, group, lat, 0.95, "p95_llm_latency")
        j = j.join(p95, group, "left")
    return j.select(
        *group, "n_llm_requests", "llm_error_rate", "llm_timeout_rate", "avg_llm_latency",
        F.coalesce(F.col("p95_llm_latency"), zero).alias("p95_llm_latency"),
        "max_llm_latency", "pct_slow_llm", "avg_llm_cost", "total_llm_cost", "max_llm_cost",
        "avg_tokens", "max_tokens",
        F.coalesce(F.col("n_unique_models"), zero).alias("n_unique_models"),
        "pct_content_filter", "avg_llm_score")


def combine_features(sys_f: DataFrame, llm_f: DataFrame, keys: list[str] | None = None
                     ) -> DataFrame:
    """J1 + A21: full outer join on (keys, bucket), missing -> 0, ratio and total."""
    group = [*(keys or []), "bucket"]
    j = sys_f.join(llm_f, group, "full_outer")
    filled = [F.coalesce(F.col(c), F.lit(0.0)).alias(c)
              for c in C.SYSTEM_FEATURES + C.LLM_FEATURES]
    j = j.select(*group, *filled)
    n_sys, n_llm = F.col("n_sys_requests"), F.col("n_llm_requests")
    return j.withColumns({
        "llm_to_sys_ratio": n_llm / (n_sys + F.lit(1.0)),
        "total_requests": n_sys + n_llm,
    })


def build_features(system: DataFrame, llm: DataFrame, bucket: str = C.BUCKET,
                   keys: list[str] | None = None, exact_p95: bool = True) -> DataFrame:
    """Feature matrix: (keys, bucket) + the 43 features, all double."""
    return combine_features(system_features(system, bucket, keys),
                            llm_features(llm, bucket, keys, exact_p95=exact_p95), keys)
