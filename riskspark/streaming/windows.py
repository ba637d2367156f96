"""All 43 window features on the stream, by two chained aggregations under one watermark.

Every record becomes a row for the bucket itself and one for each of its values of
a dimension.  The first aggregation counts (bucket, side, dimension, value), so that
a hot bucket is combined map-side and spread over its values; the row of the bucket
itself holds the sums.  The second one folds these counts by bucket into distinct
counts, top shares, the entropy and the 95th percentile (over latencies and their counts).
Both keep state only until the watermark passes the bucket's end, and each bucket is
put out once (append mode); later rows are dropped.  The second aggregation's state of a bucket
holds its distinct latencies.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import safe_rate, to_double
from ..operators.features import llm_rates, system_dims, system_rates
from ..operators.prepare import flag_security, flatten, truthy_flag

SYS, LLM = "s", "l"
MONEY = "decimal(28,10)"
MILLIS = "decimal(28,6)"


def _typed(records: DataFrame) -> DataFrame:
    """Flattened rows of both sides, cleaned as P11 and P12 do, in one pass over the stream."""
    flat = flag_security(flatten(records, "@timestamp"))
    numbers = ["http_status_code", "llm_response_time_ms", "llm_cost_usd", "llm_total_tokens"]
    lt = F.col("logtype")
    return (flat.where(lt.isin(*C.SYSTEM_LOG_TYPES, *C.LLM_LOG_TYPES)).withColumns({
        **{c: to_double(F.col(c)) for c in numbers},
        "is_security_event": truthy_flag(flat, "is_security_event"),
        "_score": F.coalesce(to_double(F.col("_score")), F.lit(C.DEFAULT_SCORE)),
        "side": F.when(lt.isin(*C.SYSTEM_LOG_TYPES), SYS).otherwise(LLM)}))


def _entries() -> Column:
    """(dimension, value) pairs of a row; the one without a dimension stands for the row itself."""
    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("d"), value.cast("string").alias("v"))

    own = entry("", F.lit(""))
    system = F.array(own, *[entry(n, c) for n, c in system_dims().items()])
    llm = F.array(own, entry("model", F.col("llm_model_id")), entry("latency", F.col("llm_response_time_ms")))
    return F.filter(F.when(F.col("side") == SYS, system).otherwise(llm), lambda e: e["v"].isNotNull())


def _sums() -> dict[str, Column]:
    """What the first aggregation sums up for a bucket and side (rows without a dimension only)."""
    score, lat, cost, tok = [F.col(c) for c in ("_score", "llm_response_time_ms", "llm_cost_usd", "llm_total_tokens")]
    own = F.col("d") == ""
    out = {name: F.count_if(own & c) for name, c in {**system_rates(), **llm_rates()}.items()}
    for name, c, kind in (("score", score, MONEY), ("latency", lat, MILLIS), ("cost", cost, MONEY), ("tokens", tok, "double")):
        out |= {f"n_{name}": F.count(F.when(own, c)), f"sum_{name}": F.sum(F.when(own, c.cast(kind))),
                f"min_{name}": F.min(F.when(own, c)), f"max_{name}": F.max(F.when(own, c))}
    return {**out, "n_security": F.sum(F.when(own, F.col("is_security_event")))}


def stream_features(records: DataFrame, bucket: str = C.BUCKET, watermark: str = "30 minutes",
                    keys: list[str] | None = None) -> DataFrame:
    """A1-A21 of a stream of page records: (keys, bucket) and the 43 features, once per closed bucket.

    Equal to :func:`build_features` over the same rows, where none came after the
    watermark had passed its bucket.  Rows without a timestamp have no bucket.
    """
    keys = list(keys or [])
    # Watermarks need an instant type: UTC wall-clock (ntz) -> timestamp.
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("timestamp")).cast("timestamp")
    rows = _typed(records).withColumn("event_time", instant).withWatermark("event_time", watermark)
    counted = (rows.withColumn("e", F.explode(_entries())).withColumns({"d": F.col("e.d"), "v": F.col("e.v")})
               .groupBy(F.window("event_time", bucket).alias("w"), *keys, "side", "d", "v")
               .agg(F.count(F.lit(1)).alias("cnt"), *[c.alias(f"__{n}") for n, c in _sums().items()]))
    n = F.col("cnt")

    def of(name: str, side: str | None = None) -> Column:
        hit = F.col("d") == name
        return hit if side is None else hit & (F.col("side") == side)

    def total(name: str, side: str) -> Column:
        return F.sum(F.when(of("", side), F.col(f"__{name}")))

    def distinct(name: str) -> Column:
        return F.count_if(of(name))

    def top(name: str) -> Column:
        return F.coalesce(F.max(F.when(of(name), n)), F.lit(0))

    n_sys, n_llm = [F.coalesce(F.sum(F.when(of("", s), n)), F.lit(0)) for s in (SYS, LLM)]

    def mean(name: str, side: str) -> Column:
        return F.when(total(f"n_{name}", side) > 0, total(f"sum_{name}", side).cast("double") / total(f"n_{name}", side))

    many = n.cast("double")
    t = F.sum(F.when(of("method"), many))
    entropy = F.log(t) - F.sum(F.when(of("method"), many * F.log(many))) / t - distinct("method") * F.lit(C.ENTROPY_EPSILON)
    features = {
        "n_sys_requests": n_sys, "n_unique_ips": distinct("ip"), "top_ip_share": safe_rate(top("ip"), n_sys),
        **{name: safe_rate(total(name, SYS), n_sys) for name in system_rates()},
        "n_unique_logtypes": distinct("lt"), "n_security_events": total("n_security", SYS),
        "method_entropy": F.when(distinct("method") > 1, entropy),
        "avg_score": mean("score", SYS), "min_score": F.min(F.when(of("", SYS), F.col("__min_score"))),
        "n_unique_services": distinct("svc"), "n_unique_regions": distinct("region"),
        "top_region_share": safe_rate(top("region"), n_sys), "n_unique_envs": distinct("env"),
        "n_llm_requests": n_llm,
        **{name: safe_rate(total(name, LLM), n_llm) for name in llm_rates()},
        "avg_llm_latency": mean("latency", LLM),
        "p95_llm_latency": F.percentile(F.when(of("latency"), F.col("v").cast("double")), 0.95, n),
        "max_llm_latency": F.max(F.when(of("", LLM), F.col("__max_latency"))),
        "avg_llm_cost": mean("cost", LLM), "total_llm_cost": total("sum_cost", LLM),
        "max_llm_cost": F.max(F.when(of("", LLM), F.col("__max_cost"))),
        "avg_tokens": mean("tokens", LLM), "max_tokens": F.max(F.when(of("", LLM), F.col("__max_tokens"))),
        "n_unique_models": distinct("model"), "avg_llm_score": mean("score", LLM),
        "llm_to_sys_ratio": n_llm / (n_sys + F.lit(1.0)), "total_requests": n_sys + n_llm,
    }
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("w.start").cast("timestamp_ntz"))
    return (counted.groupBy("w", *keys)
            .agg(*[F.coalesce(features[c].cast("double"), F.lit(0.0)).alias(c) for c in C.FEATURE_COLS])
            .select(*keys, start.alias("bucket"), *C.FEATURE_COLS))
